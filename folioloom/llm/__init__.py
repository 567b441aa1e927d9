"""Training-data operators: filters, duplicate removal, mixing, sharding and token output."""
