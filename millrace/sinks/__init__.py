"""Writing topics, dimension tables and statistics."""
