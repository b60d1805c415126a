"""Whole data flows made of operators."""
