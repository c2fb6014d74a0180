"""Training-data operators: mixing, sharding, search, packing, token files, de-duplication."""
