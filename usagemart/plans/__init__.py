"""Whole jobs: the nightly load and the refresh on demand."""
