"""Operators for the preparation of training data, and the queries that apply them."""
