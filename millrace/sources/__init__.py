"""Reading topics, change feeds and dimension tables."""
