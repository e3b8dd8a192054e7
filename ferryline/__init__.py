"""Land, normalise and replicate data feeds with Spark DataFrames."""

from ferryline.session import configure, local_session

__all__ = ["configure", "local_session"]
