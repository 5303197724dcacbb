"""Training-data operators on Spark: search, classifiers, near-copies, PII,
URL filters, tokenisation, token files and packing."""
