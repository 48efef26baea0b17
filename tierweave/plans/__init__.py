"""Table declarations, quality suites, and the layer runs that combine the operators."""
