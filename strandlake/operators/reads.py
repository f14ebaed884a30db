"""Reads (read_id, sequence) against a k-mer table: filtering, trimming and masking.

What happens to a read depends on its sequence alone. So windows are looked up once for each different sequence, under a
hash of it (SHA-256), and reads find their result by that hash: reads that share an id (mates in two files) or have none
are told apart, equal ones cost no more than one, and row order or ids are never relied on. A null sequence has no window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.functions import codes
from strandlake.functions.sequence import two_bit

from .kmers import read_codes, read_kmers, reduce_counts

#: The column that reads meet their result by.
OF = "sequence_hash"


def _told_apart(reads: DataFrame) -> DataFrame:
    return reads.withColumn(OF, F.unhex(F.sha2("sequence", 256)))


def _hits(reads: DataFrame, table: DataFrame, k: int, ci: int, cx: int, both_strands: bool) -> DataFrame:
    """(sequence_hash, pos, hit) of every window of every different sequence."""
    valid = reduce_counts(table, ci, cx)
    each = _told_apart(reads.select("sequence")).dropDuplicates([OF])
    if k <= codes.MOST:
        rows, key = read_codes(each, k, both_strands, keep=(OF,)), two_bit(F.col("kmer"))
    else:
        rows, key = read_kmers(each, k, both_strands, keep=(OF,)).withColumnRenamed("kmer", "code"), F.col("kmer")
    found = rows.join(valid.select(key.alias("code"), F.lit(True).alias("hit")), "code", "left")
    return found.select(OF, "pos", F.coalesce("hit", F.lit(False)).alias("hit"))


def filter_reads(reads: DataFrame, table: DataFrame, k: int, read_ci: int | float = 2, read_cx: int | float = 1_000_000_000, ci: int = 1, cx: int = 1_000_000_000, both_strands: bool = True) -> DataFrame:
    """Reads whose number (int bounds) or share (float bounds) of valid k-mers is in read_ci..read_cx."""
    per_read = _hits(reads, table, k, ci, cx, both_strands).groupBy(OF).agg(F.count_if("hit").alias("valid"), F.count(F.lit(1)).alias("windows"))
    found = _told_apart(reads).join(per_read, OF, "left").na.fill(0, ["valid", "windows"])
    share = F.when(F.col("windows") > 0, F.col("valid") / F.col("windows")).otherwise(0.0)
    bound = lambda x: share if isinstance(x, float) else F.col("valid")
    return found.where((bound(read_ci) >= read_ci) & (bound(read_cx) <= read_cx)).select(*reads.columns)


def trim_reads(reads: DataFrame, table: DataFrame, k: int, ci: int = 1, cx: int = 1_000_000_000, both_strands: bool = True) -> DataFrame:
    """Reads cut before the last base of their first invalid k-mer; empty if that is the first one. Qualities (a column qual)
    are cut alike."""
    first = _hits(reads, table, k, ci, cx, both_strands).where("not hit").groupBy(OF).agg(F.min("pos").alias("at"))
    end = F.when(F.col("at") == 1, 0).otherwise(F.col("at") + k - 2).cast("int")
    cut = lambda c: F.when(F.col("at").isNull(), F.col(c)).otherwise(F.substring(c, F.lit(1), end)).alias(c)
    both = _told_apart(reads).join(first, OF, "left")
    return both.select(*(cut(c) if c in ("sequence", "qual") else c for c in reads.columns))


def filter_pairs(first: DataFrame, second: DataFrame, table: DataFrame, k: int, either: bool = False, **bounds: int | float | bool) -> tuple[DataFrame, DataFrame]:
    """Both files of paired reads (read_id names the pair) after filter_reads: pairs of which both mates (either: one) pass.
    Where reads of one file share an id, it passes if one of them does; reads without an id are no pair."""
    passed = [filter_reads(x, table, k, **bounds).select("read_id").distinct() for x in (first, second)]
    kept = passed[0].unionByName(passed[1]).distinct() if either else passed[0].intersect(passed[1])
    return first.join(kept, "read_id", "left_semi").select(*first.columns), second.join(kept, "read_id", "left_semi").select(*second.columns)


def mask_reads(reads: DataFrame, table: DataFrame, k: int, ci: int = 1, cx: int = 1_000_000_000, both_strands: bool = True) -> DataFrame:
    """Bases that no valid k-mer covers become N; reads without a window have none covered."""
    hits = _hits(reads, table, k, ci, cx, both_strands).where("hit").groupBy(OF).agg(F.sort_array(F.collect_list("pos")).alias("at"))
    joined = _told_apart(reads).join(hits, OF, "left").withColumn("at", F.coalesce("at", F.array().cast("array<bigint>")))
    # valid starts no more than k apart cover one run; a read is its runs with N between them, each base taken once
    at = lambda i: F.element_at("at", (i + 1).cast("int"))
    begins = F.filter("at", lambda x, i: (i == 0) | (x > at(F.greatest(i - 1, F.lit(0))) + k))
    ends = F.transform(F.filter("at", lambda x, i: (i == F.size("at") - 1) | (at(F.least(i + 1, F.size("at") - 1)) > x + k)), lambda x: x + k - 1)
    runs = joined.withColumn("runs", F.arrays_zip(begins.alias("b"), ends.alias("e"))).withColumn("bases", F.split("sequence", ""))
    unknown = lambda n: F.repeat(F.lit("N"), n.cast("int"))

    def piece(r, i):  # noqa: ANN001, ANN202
        gap = r["b"] - 1 - F.when(i == 0, F.lit(0).cast("long")).otherwise(F.element_at("runs", F.greatest(i, F.lit(1)))["e"])
        return F.concat(unknown(gap), F.array_join(F.slice("bases", r["b"].cast("int"), (r["e"] - r["b"] + 1).cast("int")), ""))

    last = F.coalesce(F.try_element_at("runs", F.lit(-1))["e"], F.lit(0).cast("long"))
    masked = F.concat(F.array_join(F.transform("runs", piece), ""), unknown(F.length("sequence") - last))
    return runs.withColumn("sequence", F.when(F.length("sequence") > 0, masked).otherwise(F.col("sequence"))).select(*reads.columns)


def as_fasta(reads: DataFrame) -> DataFrame:
    """value: a FASTA record of each read."""
    return reads.select(F.concat(F.lit(">"), F.col("read_id").cast("string"), F.lit("\n"), F.col("sequence")).alias("value"))


def as_fastq(reads: DataFrame, quality: str = "I") -> DataFrame:
    """value: a FASTQ record of each read, with its own qualities (column qual) or one for all."""
    qual = F.col("qual") if "qual" in reads.columns else F.rpad(F.lit(""), F.length("sequence"), F.lit(quality))
    return reads.select(F.concat(F.lit("@"), F.col("read_id").cast("string"), F.lit("\n"), F.col("sequence"), F.lit("\n+\n"), qual).alias("value"))
