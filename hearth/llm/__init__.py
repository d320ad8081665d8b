"""Training-data operators: deduplication, decontamination, mixing, formatting, search and filters."""
