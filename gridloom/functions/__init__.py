"""Column expressions: names, paths, casts, entities."""
