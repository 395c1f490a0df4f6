"""Multi-step flows assembled from the operators."""
