"""Analyses over sites: user functions by scope, and the join of their results."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import beside, merged

KEYS = ["gene_id", "site_id"]


def analyze_sites(sites: DataFrame, features: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """Site scope: each function takes the sequence column. Partitions are the parallelism."""
    return sites.select(*KEYS, *(f(F.col("sequence")).alias(name) for name, f in features.items()))


def analyze_sites_python(sites: DataFrame, function: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """Site scope for Python code, batch by batch."""
    return sites.mapInPandas(function, schema)


def analyze_targets(sites: DataFrame, genes: DataFrame, features: dict[str, Callable[[], Column]]) -> DataFrame:
    """Target scope: functions see a site's columns beside those of its gene (g_*)."""
    target = genes.select("gene_id", "gene_name", F.col("strand").alias("g_strand"), "g_start", "g_end")
    return merged(sites, target, "gene_id").select(*KEYS, *(f().alias(name) for name, f in features.items()))


def analyze_genome(sites: DataFrame, kmers: DataFrame) -> DataFrame:
    """Genome scope: how often the genome has each site's sequence, from a k-mer table."""
    counted = kmers.select(F.col("kmer").alias("sequence"), F.col("cnt").alias("genome_count"))
    return merged(sites.select(*KEYS, "sequence"), counted, "sequence", "left").select(*KEYS, F.coalesce("genome_count", F.lit(0)).cast("long").alias("genome_count"))


def gather(results: list[DataFrame]) -> DataFrame:
    """All analyses of the sites in one table; a site that an analysis lacks has nulls there."""

    def both(a: DataFrame, b: DataFrame) -> DataFrame:
        keys = (F.coalesce(x, y).alias(x) for x, y in zip(KEYS, ("other_gene", "other_site"), strict=True))
        return beside(a, b, "full").select(*keys, *(c for df in (a, b) for c in df.columns if c not in KEYS))

    return reduce(both, results)
