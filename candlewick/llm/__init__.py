"""Training-data operators: token counts, extraction, chat, near duplicates, mixing, classifiers, fingerprints."""
