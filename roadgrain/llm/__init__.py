"""Training-data operators: filters, near-duplicates, language, mixing, privacy, fingerprints, tokens."""
