"""Rating jobs assembled from the operators, and the registered query catalogue."""
