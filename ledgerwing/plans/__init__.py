"""Composed models: staging, intermediate, marts, evaluation, serving, training."""
