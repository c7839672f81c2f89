"""Rillet: loading streams of tab-separated events into analytic tables with Spark."""

from rillet.session import configure

__all__ = ["configure"]
