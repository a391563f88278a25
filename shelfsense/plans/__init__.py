"""Whole jobs: collections in, collections out."""
