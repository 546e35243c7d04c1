"""Operators for large-scale training-data preparation (deduplication, filtering,
scoring, auditing, tokenising, mixing).  Nothing else in the package imports this."""
