"""Operators for training-data pipelines over text and vector tables, and their registered queries."""
