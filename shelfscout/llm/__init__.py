"""Training-data operators: sharding, near-dedup, filters, mixing, scoring, extraction, decontamination, PII, search."""
