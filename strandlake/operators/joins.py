"""Joins in which no key is one task's work."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is heavy if it has more than one in SHARE of a side's rows, and more than LEAST.
SHARE, LEAST = 2048, 4096


def merged(left: DataFrame, right: DataFrame, on: str | list[str] | Column, how: str = "inner") -> DataFrame:
    """left.join(right, on, how), in which no side is broadcast. Spark guesses sizes from those of files and doesn't see how
    many rows explode or Python make of one, so it takes all windows of a genome for a small table and sends them through the
    driver."""
    return left.join(right.hint("merge"), on, how)


def beside(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """left and right joined on (gene_id, site_id), which right has as other_gene and other_site.

    Rows are dealt by gene and all but the last two characters of their id, not by the whole id: sites that lie side by side,
    which have most of their ids and bases in common, stay so, and take a fraction of the room when they are shuffled."""
    near = F.substring("site_id", F.lit(1), F.length("site_id") - 2)
    a, b = left.withColumn("near", near), right.withColumn("other_near", near).withColumnsRenamed({"gene_id": "other_gene", "site_id": "other_site"})
    # equal ids, in a form that isn't a key of the join
    same = (F.col("site_id") >= F.col("other_site")) & (F.col("site_id") <= F.col("other_site"))
    return merged(a, b, (F.col("gene_id") == F.col("other_gene")) & (F.col("near") == F.col("other_near")) & same, how).drop("near", "other_near")


def heavy_keys(df: DataFrame, on: list[str], share: int = SHARE, least: int = LEAST) -> tuple[dict[tuple, int], int]:
    """The heavy keys of a side with their rows, and how many rows a key may have: at most `share` keys come back."""
    counted = df.dropna(subset=on).groupBy(*on).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > least)
    found = counted.orderBy(F.desc("n")).limit(share).collect()
    if not found:
        return {}, least
    bound = max(least, df.count() // share)
    return {tuple(r[c] for c in on): r.n for r in found if r.n > bound}, bound


def split_join(left: DataFrame, right: DataFrame, on: list[str], share: int = SHARE, least: int = LEAST, left_even: bool = False) -> DataFrame:
    """left.join(right, on), in which heavy keys of either side are cut up: if a key has a and b times the rows that a key may
    have, its rows on the left are dealt into a parts and those on the right into b, and each of the a * b pairs of parts
    meets under a key of its own. All other rows move once, as in any join; a side's rows are read once more to be counted,
    by key, and once more if there are heavy keys. With left_even no key of the left is heavy, which then isn't counted.

    At most `share` keys of a side can be heavy, so what is sent around has a bound."""
    l_heavy, l_most = ({}, least) if left_even else heavy_keys(left, on, share, least)
    r_heavy, r_most = heavy_keys(right, on, share, least)
    if not l_heavy and not r_heavy:
        return merged(left, right, on)
    rows = [(*key, -(-l_heavy.get(key, 1) // l_most), -(-r_heavy.get(key, 1) // r_most)) for key in {**l_heavy, **r_heavy}]
    kinds = ", ".join(f"{c} {left.schema[c].dataType.simpleString()}" for c in on)
    parts = F.broadcast(left.sparkSession.createDataFrame(rows, f"{kinds}, l_parts long, r_parts long"))

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        """Each row in one part of its own side and in all of the other's."""
        marked = df.withColumn("nth", F.monotonically_increasing_id()).join(parts, on, "left")
        one = F.coalesce(F.pmod("nth", f"{own}_parts"), F.lit(0).cast("long"))
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col(f"{other}_parts"), F.lit(1).cast("long")) - 1))
        return marked.withColumn(f"{own}_part", one).withColumn(f"{other}_part", every).drop("nth", "l_parts", "r_parts")

    return merged(dealt(left, "l", "r"), dealt(right, "r", "l"), [*on, "l_part", "r_part"]).drop("l_part", "r_part")


def one_union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
