"""Operators for large-scale training-data pipelines over web pages and documents."""
