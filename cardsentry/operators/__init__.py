"""Transformations of the dataset graph, each ``DataFrame -> DataFrame``."""
