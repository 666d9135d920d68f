"""DataFrame operators of a load."""
