"""Whole jobs over the shared test tables."""
