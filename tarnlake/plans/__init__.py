"""Metric models and whole jobs assembled from the operators."""
