"""Training-data operators: quality, packing, chat, mixing, search, dedup, toxicity, licences, token files."""
