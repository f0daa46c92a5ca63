"""Joins of a large table with a lookup table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
FAN = 64


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    uses: str,
    spread_by: str,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Inner join of ``rows`` with a unique-key ``lookup`` that counts each key's ``uses``.

    A lookup of at most ``broadcast_rows`` rows, of at most 64 MB with all its columns,
    is broadcast: both are counted first. Beyond that both sides are shuffled; a key used by more
    than 1/64 of all rows (there are at most 64 of those, and only they are
    broadcast) is cut over up to 64 partitions by ``spread_by``. ``lookup``
    should be stored, as it is read more than once.
    """
    width = sum((F.coalesce(F.octet_length(F.col(f"`{name}`").cast("string")), F.lit(0)) for name in lookup.columns), F.lit(0))
    total_bytes = F.coalesce(F.sum(width), F.lit(0))
    size = lookup.agg(
        F.count(F.lit(1)).alias("n"), F.sum(uses).alias("uses"), total_bytes.alias("bytes")
    ).first()
    if size["n"] <= broadcast_rows and size["bytes"] <= BROADCAST_BYTES:
        return rows.join(F.broadcast(lookup), key)
    share = F.col(uses) * FAN / size["uses"]
    hot = lookup.where(share > 1).select(key, F.ceil(share).cast("int").alias("__cuts"))
    cuts = F.coalesce("__cuts", F.lit(1))
    salted_rows = rows.join(F.broadcast(hot), key, "left").withColumn(
        "__salt", F.pmod(F.xxhash64(spread_by), cuts).cast("int")
    )
    salted_lookup = (
        lookup.join(F.broadcast(hot), key, "left")
        .withColumn("__salt", F.explode(F.sequence(F.lit(0), cuts - 1)))
        .drop("__cuts")
    )
    return salted_rows.drop("__cuts").join(salted_lookup, [key, "__salt"]).drop("__salt")
