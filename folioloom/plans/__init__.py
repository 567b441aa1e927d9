"""Model catalogue, declared checks, loads and the registered queries."""
