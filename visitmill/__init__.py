"""visitmill: daily web-visit analytics written as PySpark DataFrame jobs."""

from visitmill.schema import INTENDED, REFERENCE

__all__ = ["INTENDED", "REFERENCE"]
