"""Readers and writers of the pipeline tables."""
