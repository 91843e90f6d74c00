"""Training-data operators: packing, filters, search, tokens, archives, near-duplicates."""
