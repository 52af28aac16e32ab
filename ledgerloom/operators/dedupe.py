"""Split rows into first occurrences and rejected repeats of a key."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.tables import stored

_EXPAND_BLOCK = 100_000


@dataclass(frozen=True)
class Split:
    kept: DataFrame
    rejected: DataFrame


def _repeat(rows: DataFrame, times: str) -> DataFrame:
    """Each row as often as its ``times`` column says; very many copies of one row are made by several tasks."""
    copies = F.col(times)
    few = rows.filter(copies <= _EXPAND_BLOCK).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), copies)))
    blocks = rows.filter(copies > _EXPAND_BLOCK).withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(`{times}` - 1) div {_EXPAND_BLOCK}")))
    )
    size = F.least(F.lit(_EXPAND_BLOCK).cast("long"), copies - F.col("_block") * _EXPAND_BLOCK)
    many = blocks.repartition(*[F.col(f"`{c}`") for c in blocks.columns]).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("long"), size))
    )
    return few.unionByName(many.drop("_block")).drop("_copy", times)


def split_duplicates(df: DataFrame, keys: list[str], order_by: list[str]) -> Split:
    """Keep the first row of each key by ``order_by`` and reject the others; NULL keys are equal.

    Same rows as ``row_number() over (partition by keys order by order_by)`` split at 1, with ties
    in ``order_by`` settled by the other columns. Exactly one row per key is kept, even where whole
    rows are repeated, so kept + rejected = input always holds.

    No key's rows are gathered in one task, however many there are. Hashes of keys are counted, which
    combines before its shuffle and moves one number per key; those that occur more than once are
    written, so the join on them is planned on their true size. One join marks the rows that have such
    a hash: while they are few they are broadcast by the planner and no row is shuffled, beyond its
    limit rows are shuffled once and adaptive execution splits a hot key. The marked rows are written,
    so that the input is read no further. Two keys of one hash do no harm: of the marked rows an
    aggregation takes the first per key, and the rejects are what is left when those are subtracted,
    counted row by row.
    """
    columns = df.columns
    by_key = [F.col(f"`{c}`") for c in keys]
    in_order = [F.col(f"`{c}`") for c in columns]
    payload = [*order_by, *[c for c in columns if c not in keys and c not in order_by]]
    hashes = df.groupBy(F.xxhash64(*by_key).alias("_hash")).agg(F.count(F.lit(1)).alias("_rows"))
    often = stored(hashes.filter("_rows > 1").select("_hash"), "repeated-keys")
    found = df.join(often, F.xxhash64(*by_key) == F.col("_hash"), "left")
    marked = stored(found.select(*in_order, F.col("_hash").isNotNull().alias("_marked")), "marked-rows")
    single = marked.filter(~F.col("_marked")).select(*in_order)
    repeated = marked.filter("_marked").select(*in_order)
    first = (
        repeated.groupBy(*by_key)
        .agg(F.min(F.struct(*[F.col(f"`{c}`") for c in payload])).alias("_row"))
        .select(*by_key, "_row.*")
        .select(*in_order)
    )
    left_over = (
        repeated.withColumn("_copies", F.lit(1).cast("long"))
        .unionByName(first.withColumn("_copies", F.lit(-1).cast("long")))
        .groupBy(*in_order)
        .agg(F.sum("_copies").alias("_copies"))
        .filter("_copies > 0")
    )
    return Split(kept=single.unionByName(first), rejected=_repeat(left_over, "_copies").select(*in_order))
