"""Library reconciliation and analytics on Spark DataFrames."""

from shelfwise.session import local_session, tune

__all__ = ["local_session", "tune"]
