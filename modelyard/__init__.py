"""Model-lifecycle analytics on Spark: split, encode, fit, score, compare, watch."""
