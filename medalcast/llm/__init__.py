"""Training-data operators: dedup, decontamination, quality, toxicity, tokenising, formatting, URL filters."""
