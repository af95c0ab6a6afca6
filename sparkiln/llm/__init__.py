"""Training-data operators: dedup, filtering, classification, sharding, packing."""
