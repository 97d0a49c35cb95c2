"""Whole programs put together from the operators."""
