"""Column-level helpers: times and records."""
