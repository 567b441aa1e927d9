"""Readers for landed files and the tables the checks run on."""
