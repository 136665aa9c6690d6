"""Joins of a fact with a hot key to a side that is already arranged by that key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rekeyed(keys: DataFrame, *columns: str) -> DataFrame:
    """The same rows, with key columns that Spark takes for new values.

    Adaptive execution splits a hot key only in a join that lies directly on two
    shuffles.  A side that comes out of another join or aggregate on the same
    key is not shuffled again, and the hot key of the other side then stays
    whole.  Rebuilding the (few) keys makes their side be shuffled below the
    join; when it is small enough to be broadcast, this costs nothing.
    """
    return keys.withColumns({c: F.array_max(F.array(c)) for c in columns})
