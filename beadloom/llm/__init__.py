"""Training-data operators: language, quality, toxicity, duplicates, mixing, packing, media, search and URL rules."""
