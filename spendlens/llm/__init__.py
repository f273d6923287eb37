"""Training-data operators: deduplication, decontamination, classifiers, tokens, extraction."""
