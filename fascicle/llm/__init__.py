"""Training-data operators: scoring, mixing, extraction, decontamination, indexes, privacy, duplicates."""
