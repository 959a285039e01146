"""urbanlens.plans."""
