"""Wiring: runs of single datasets, the dataset graph, the query catalog."""
