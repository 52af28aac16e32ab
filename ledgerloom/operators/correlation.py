"""Rank correlation with its two-sided p-value."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.ordering import average_ranks
from ledgerloom.sources.tables import stored

_STEPS = 1000


def student_t_two_sided(t: Column, df: Column) -> Column:
    """P(|T| > t) for Student's t, by Simpson's rule with a fixed number of steps.

    The tail from t on is mapped to s in [0, 1] by u = t + s / (1 - s). The density's constant is a
    ratio of gamma functions, taken from its asymptotic series twenty places further up.
    """
    t, half = F.abs(t), df / 2
    far = half + 20
    ratio = F.sqrt(far) * (1 - 1 / (8 * far) + 1 / (128 * far**2) + 5 / (1024 * far**3) - 21 / (32768 * far**4))
    for i in range(20):
        ratio = ratio * (half + i) / (half + i + 0.5)

    def add(total: Column, i: Column) -> Column:
        s = i / _STEPS
        u = t + s / (1 - s)
        inside = F.exp(-(df + 1) / 2 * F.log1p(u * u / df)) / ((1 - s) * (1 - s))
        return total + F.when(i == 0, 1).when(i % 2 == 1, 4).otherwise(2) * inside

    # At s = 1 nothing is left of the tail, but for the heaviest one, of one degree of freedom.
    last = F.when(df == 1, 1.0).otherwise(0.0)
    area = (F.aggregate(F.sequence(F.lit(0), F.lit(_STEPS - 1)), F.lit(0.0), add) + last) / (3 * _STEPS)
    return F.least(F.lit(1.0), 2 * ratio / F.sqrt(df * math.pi) * area)


def rank_correlation(df: DataFrame, metrics: list[str], target: str) -> DataFrame:
    """Spearman's rho of each metric with the target: rows (metric, pairs, rho, p_value).

    Ties get average ranks, a pair with a NULL is left out for that metric, a constant column or fewer
    than three pairs give NULL. Equal pairs are counted first, for all metrics in one scan; ranks are
    worked out on distinct values, and rho comes from sums weighted by the counts. So a value that
    most rows hold is one row, and nothing but columns leads to the result. The counted pairs and the
    ordered values are written, as global positions need that.
    """
    y = F.col(f"`{target}`").cast("double").alias("y")
    long = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"`{m}`").cast("double").alias("x"), y) for m in metrics]))
    pairs = df.select(long.alias("pair")).select("pair.*").where("x IS NOT NULL AND y IS NOT NULL")
    cells = stored(pairs.groupBy("metric", "x", "y").agg(F.count(F.lit(1)).alias("n")), "pairs")

    def ranks(value: str) -> DataFrame:
        counted = cells.groupBy("metric", value).agg(F.sum("n").alias("n"))
        return average_ranks(counted, "metric", value, "n").select("metric", value, F.col("rank").alias(f"rank_{value}"))

    totals = cells.groupBy("metric").agg(F.sum("n").alias("pairs"))
    ranked = cells.join(ranks("x"), ["metric", "x"]).join(ranks("y"), ["metric", "y"]).join(totals, "metric")
    a, b = (F.col(f"rank_{v}") - (F.col("pairs") + 1) / 2 for v in "xy")
    sums = ranked.groupBy("metric").agg(
        F.sum(F.col("n") * a * b).alias("ab"), F.sum(F.col("n") * a * a).alias("aa"), F.sum(F.col("n") * b * b).alias("bb")
    )
    every = df.sparkSession.createDataFrame([(m,) for m in metrics], "metric string")
    found = every.join(totals, "metric", "left").join(sums, "metric", "left")
    varies = (F.col("pairs") > 2) & (F.col("aa") > 0) & (F.col("bb") > 0)
    rho = F.when(varies, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("ab") / F.sqrt(F.col("aa") * F.col("bb")))))
    found = found.select("metric", F.coalesce("pairs", F.lit(0)).cast("long").alias("pairs"), rho.alias("rho"))
    freedom = (F.col("pairs") - 2).cast("double")
    apart = 1 - F.col("rho") * F.col("rho")
    t = F.col("rho") * F.sqrt(freedom / apart)
    return found.withColumn("p_value", F.when(apart > 1e-15, student_t_two_sided(t, freedom)).when(apart <= 1e-15, F.lit(0.0)))
