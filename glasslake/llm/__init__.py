"""Training-data operators: deduplication, classification, scanning, tokenising and packing of documents."""
