"""Training-data operators: encoding, deduplication, filters, scoring, packing."""
