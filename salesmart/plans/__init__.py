"""The warehouse models, layer by layer."""
