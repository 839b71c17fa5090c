"""Readers and writers, and shaping of landed JSON and HTML documents."""
