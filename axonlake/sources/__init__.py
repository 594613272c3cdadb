"""Readers, writers and the projection of star-schema tables onto the connectome domain."""
