"""The registered queries, their adapters to the given tables, and their oracle SQL."""
