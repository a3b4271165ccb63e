"""Operators for preparing training data at scale, each a Spark job over whole tables."""
