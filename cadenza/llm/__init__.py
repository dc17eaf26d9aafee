"""Training-data operators: each takes and returns DataFrames; queries are in ``queries``."""
