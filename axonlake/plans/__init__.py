"""Whole products, built lazily from the operators."""
