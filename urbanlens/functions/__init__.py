"""urbanlens.functions."""
