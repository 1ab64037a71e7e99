"""DataFrame operators of the publication pipeline."""
