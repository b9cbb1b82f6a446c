"""Training-data operators: quality, licences, decontamination, near-duplicates, archives, secrets, tokens, toxicity, mixing."""
