"""Column functions: time base, vectors, names, integration."""
