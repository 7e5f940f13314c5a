"""Registered queries: each pairs a Spark plan on the given tables with its SQL twin."""
