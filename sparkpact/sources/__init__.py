"""Where contract documents and registries are read from."""
