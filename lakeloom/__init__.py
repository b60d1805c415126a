"""Catalogue and review analytics on Spark DataFrames."""

from lakeloom.session import get_session

__all__ = ["get_session"]
