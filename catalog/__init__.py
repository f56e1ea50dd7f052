"""Checkable queries over the test tables: Spark side, and the same in SQL."""
