"""Connected components of links between ids, by alternating star contractions.

Every round hangs each id's larger neighbours, and then its smaller ones, below the
smallest id it knows. Minima combine before the shuffle and neighbour lists are never
gathered, so an id with very many links is only a hot join key. Each round is written to
the shared folder; the rounds end when the links no longer change (about the logarithm of
the longest chain).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import staged


def smallest_reachable(links: DataFrame) -> DataFrame:
    """From links ``a``, ``b``: each ``id`` that is not the smallest of its component, with
    the smallest as ``component``. Links to null or to itself are ignored."""
    stars = staged(
        links.filter("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(),
        "links",
    )
    seen = _state(stars)
    while True:
        stars = staged(_small_star(_large_star(stars)), "links")
        now = _state(stars)
        if now == seen:
            return stars.select(F.col("v").alias("id"), F.col("u").alias("component"))
        seen = now


def _state(stars: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(stars.agg(F.count("*"), F.sum(mixed), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first())


def _large_star(stars: DataFrame) -> DataFrame:
    """Larger neighbours of every id go below its smallest neighbour."""
    both = stars.select("v", "u").union(stars.select(F.col("u").alias("v"), F.col("v").alias("u")))
    least = both.groupBy("v").agg(F.least("v", F.min("u")).alias("m"))
    return (
        both.filter("u > v").join(least, "v").filter("u <> m")
        .select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
    )


def _small_star(stars: DataFrame) -> DataFrame:
    """Smaller neighbours of every id, and the id itself, go below the smallest of them."""
    least = stars.groupBy("v").agg(F.min("u").alias("m"))
    moved = stars.join(least, "v").filter("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
    return moved.union(least.select("v", F.col("m").alias("u"))).distinct()
