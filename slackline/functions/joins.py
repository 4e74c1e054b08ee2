"""Joins of a large table to a lookup table of unknown size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART_BYTES = 256 << 20
MOST_SALTS = 10_000


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df``; no job is run."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame) -> bool:
    """True when the size estimate is within the session's broadcast limit."""
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    return estimated_bytes(df) <= conf.autoBroadcastJoinThreshold()


def splits_skew(df: DataFrame) -> bool:
    """True when the session splits skewed join partitions by itself."""
    switches = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    return all(df.sparkSession.conf.get(s).lower() == "true" for s in switches)


def salts_for(df: DataFrame, part_bytes: int = PART_BYTES) -> int:
    """Parts a key needs if all of ``df`` had that key and a part held ``part_bytes``."""
    return max(2, -(-estimated_bytes(df) // part_bytes))


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: list[str],
    how: str = "inner",
    spread_by: Column | None = None,
    salts: int | None = None,
) -> DataFrame:
    """Join ``fact`` to ``dim`` on ``on``; ``dim`` is broadcast only if it is small.

    Beyond the broadcast limit this is a shuffle join. A hot key is then split by
    adaptive execution; in a session without that, the rows of a key are spread over
    ``salts`` partitions by a hash of ``spread_by`` and ``dim`` is repeated per salt. By
    default there are as many as keep a key with every row within ``PART_BYTES`` a part.
    The salt is a hash of row values, so a recomputed task yields the same partitions.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"unsupported join type: {how}")
    if fits_broadcast(dim):
        return fact.join(F.broadcast(dim), on, how)
    if splits_skew(fact) or spread_by is None:
        return fact.join(dim, on, how)
    salts = min(MOST_SALTS, salts_for(fact)) if salts is None else salts
    salted = fact.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    copies = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")
