"""DataFrame operators that the models are built from."""
