"""Column-level helpers: missing-value rules, coordinates, text keys."""
