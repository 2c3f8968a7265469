"""Column builders: scalar calculations, masks and deterministic draws."""
