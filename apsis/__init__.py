"""Orbit analytics on Spark: histories of element sets, space weather, and the training table that joins them."""
