"""Training-data operators: mixing, archives, quality, deduplication, decontamination, privacy."""
