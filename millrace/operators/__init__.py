"""Batch operators; the stateless ones serve streams as well."""
