"""Training-data operators: filters, scoring, deduplication, masking, mixing, tokens and shards."""
