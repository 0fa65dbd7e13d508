"""Training-data operators: dedup, filters, language, tokens, mixing, sharding."""
