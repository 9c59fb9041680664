"""Flight-delay analytics as plain PySpark DataFrame jobs."""

from tarmac.session import build_session, settle

__all__ = ["build_session", "settle"]
