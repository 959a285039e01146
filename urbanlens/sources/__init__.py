"""urbanlens.sources."""
