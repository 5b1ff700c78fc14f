"""Whole runs: the batch medallion and the catalogue of serving queries."""
