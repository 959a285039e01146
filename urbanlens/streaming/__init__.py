"""urbanlens.streaming."""
