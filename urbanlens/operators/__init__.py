"""urbanlens.operators."""
