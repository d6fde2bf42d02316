"""Training-data operators: formatting, filtering, deduplication, search, sharding and packing of text corpora."""
