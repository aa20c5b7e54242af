"""Look-ups in tables too large to broadcast, where few keys own many of the rows that ask."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is heavy when more than one row in so many asks for it. There are fewer heavy keys than that, whatever the data.
HEAVY_SHARE = 256


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], tie: str, how: str = "left", share: int = HEAVY_SHARE) -> DataFrame:
    """``left`` joined with ``right`` on ``keys``, the rows of heavy keys dealt over several tasks by the hash of ``tie``.

    How often each key is asked for is measured first. Only heavy keys are salted, in proportion to their count, and only their rows of
    ``right`` are repeated. The table of heavy keys has fewer than ``share`` rows and is broadcast.
    """
    asked = left.groupBy(*keys).agg(F.count("*").alias("_n"))
    total = asked.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    heavy = asked.filter(F.col("_n") * share > total).select(*keys, F.ceil(F.col("_n") * share / F.lit(max(total, 1))).cast("int").alias("_salts"))
    salts = F.coalesce("_salts", F.lit(1))
    salted = left.join(F.broadcast(heavy), keys, "left").withColumn("_salt", F.pmod(F.xxhash64(tie), salts).cast("int")).drop("_salts")
    copies = right.join(F.broadcast(heavy), keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")
