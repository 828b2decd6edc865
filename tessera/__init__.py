"""Disclosure analytics over large collections of long reports, on Spark."""
