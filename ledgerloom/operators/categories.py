"""Best category per key by rank."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def best_category(category: Column, ranks: Mapping[str, int]) -> Column:
    """Aggregate: name of the highest-ranked category; an unlisted one counts as the lowest rank."""
    lowest = min(ranks.values())
    rank = F.lit(lowest)
    for name, value in ranks.items():
        rank = F.when(category == name, value).otherwise(rank)
    names = F.create_map(*[F.lit(x) for name, value in ranks.items() for x in (value, name)])
    return names[F.max(rank)]
