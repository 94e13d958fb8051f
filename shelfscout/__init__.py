"""Item discovery on Spark: ingest, features, segments and ranked recommendations as DataFrame jobs."""

from shelfscout.session import configure, local_session

__all__ = ["configure", "local_session"]
