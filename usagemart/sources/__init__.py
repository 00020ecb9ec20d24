"""Readers, the staging area, and the stored tables."""
