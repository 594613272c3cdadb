"""DataFrame-to-DataFrame operators of the connectome."""
