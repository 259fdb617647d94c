"""The reports of the order system and of the rental store."""
