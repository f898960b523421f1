"""Importing any plan registers the queries of all."""

from quire.plans import catalog, changes, corrections, review

__all__ = ["catalog", "changes", "corrections", "review"]
