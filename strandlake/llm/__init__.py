"""Training-data operators: quality, privacy, extraction, deduplication, decontamination, tokenisation."""
