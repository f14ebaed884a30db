"""Pieces that the training-data operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.sources.scratch import new_path

#: Words are maximal runs of characters outside U+0020 and U+0009..U+000D.
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: its lineage ends there and survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def restaged(df: DataFrame, name: str, before: str | None = None) -> tuple[DataFrame, str]:
    """staged for loops: the new table and its path; the one before, which nothing needs any more, is deleted."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    df.write.parquet(path)
    if before:
        old = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(before)
        old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)
    return spark.read.schema(df.schema).parquet(path), path


def in_slices(it: Iterator[pa.RecordBatch], rows: int = 512, size: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """The batches in slices of so many rows, or half as many as long as those have more bytes: Python then holds the objects
    of few texts at a time."""
    for batch in it:
        at = 0
        while at < batch.num_rows:
            n = min(rows, batch.num_rows - at)
            while n > 1 and batch.slice(at, n).nbytes > size:
                n //= 2
            yield batch.slice(at, n)
            at += n


def small(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """A written table of a few numbers a row, to be broadcast if it has so many rows or fewer; else joined as Spark likes."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def drop_rows(docs: DataFrame, gone: DataFrame, repeated: DataFrame) -> DataFrame:
    """docs without the rows that gone names by doc_id and h, the hash of the text, and with one each of those that repeated
    names (rows that are equal in both). Texts are only moved where these tables are too large to be sent around."""
    at = "drop_rows_h"  # beside whatever columns docs has
    key = ["doc_id", at]
    hashed = docs.withColumn(at, F.xxhash64("text"))
    named = lambda df: df.select("doc_id", F.col("h").alias(at))
    away = small(staged(named(gone).unionByName(named(repeated)).distinct(), "rows-away"))
    once = small(staged(named(repeated).distinct(), "rows-once"))
    return hashed.join(away, key, "left_anti").unionByName(hashed.join(once, key, "left_semi").dropDuplicates(key)).select(*docs.columns)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once for a row."""
    return F.transform(F.array(value), body)[0]


def whole_words(text: Column) -> Column:
    """array<string> of the words of a text; empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def running_totals(values: Column, block: int = 256) -> Column:
    """Inclusive running totals of an array<int>: by blocks, so that long arrays don't cost their square."""

    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0), lambda acc, x: acc + x)

    def of(a: Column) -> Column:
        n_blocks = F.floor((F.size(a) - 1) / block).cast("int")
        sums = F.transform(F.sequence(F.lit(0), n_blocks), lambda b: total(F.slice(a, b * block + 1, F.lit(block))))
        before = let(sums, lambda s: F.transform(s, lambda _, k: total(F.slice(s, F.lit(1), k))))
        return let(before, lambda base: F.transform(a, lambda _, i: let(F.floor(i / block).cast("int"), lambda b: F.element_at(base, b + 1) + total(F.slice(a, b * block + 1, i - b * block + 1)))))

    return F.when(F.size(values) == 0, F.array().cast("array<int>")).otherwise(let(values, of))


def located(text: Column, pattern: str) -> Column:
    """array<struct<start,end,match>>: leftmost non-overlapping matches by code points, end exclusive.

    What lies between the matches gives their places; a pattern must never match the empty string."""
    none = F.array().cast("array<struct<start:int,end:int,match:string>>")

    def places(m: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        steps = let(gaps, lambda g: F.transform(m, lambda _, i: F.length(F.element_at(g, i + 1)) + F.when(i > 0, F.length(F.element_at(m, i))).otherwise(0)))
        found = let(running_totals(steps), lambda s: F.transform(m, lambda x, i: F.struct(F.element_at(s, i + 1).alias("start"), (F.element_at(s, i + 1) + F.length(x)).alias("end"), x.alias("match"))))
        return F.when(F.size(m) == 0, none).otherwise(found)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), places)
