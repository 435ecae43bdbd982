"""Training-data operators: scoring, tokens, shards, deduplication and filters of documents."""
