"""DataFrame → DataFrame operators of the catalogue analytics."""
