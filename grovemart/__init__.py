"""Delimited registry files to a star schema and its area cards, on Spark."""
