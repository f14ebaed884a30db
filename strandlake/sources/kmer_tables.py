"""K-mer tables at rest: bucketed by k-mer, sorted, and kept with the settings they were counted with.

A table is a folder: `kmers` holds Parquet files, one for each bucket; `settings` a line of JSON, written last, so that a
table without it is unfinished. Joins and aggregates on the k-mer over tables with the same number of buckets need no
exchange, and counter bounds reach the scan."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from hashlib import sha256

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from strandlake.operators.kmers import CI, CS, CX, count_kmers


@dataclass(frozen=True)
class Settings:
    """What decides which k-mers a table holds, and with which counters."""

    k: int = 25
    ci: int = CI
    cx: int = CX
    cs: int = CS
    both_strands: bool = True
    compress: bool = False


class OtherSettings(ValueError):
    """A table was counted with other settings than those asked for."""


def _delete(spark: SparkSession, path: str) -> None:
    old = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)


def _name(path: str) -> str:
    return f"kmers_{sha256(path.encode()).hexdigest()[:16]}"


def settings_of(spark: SparkSession, path: str) -> tuple[Settings, int] | None:
    """The settings of a finished table and its number of buckets, or None."""
    try:
        line = spark.read.text(f"{path}/settings").first()
    except AnalysisException:  # no such folder
        return None
    found = json.loads(line.value)
    return Settings(**found["settings"]), found["buckets"]


def save_kmer_table(table: DataFrame, path: str, settings: Settings, buckets: int) -> None:
    """Write (kmer, cnt) as a table, in place of one that is there."""
    spark = table.sparkSession
    _delete(spark, f"{path}/settings")
    spark.sql(f"drop table if exists {_name(path)}")
    _delete(spark, f"{path}/kmers")
    # dealt as buckets are, so each is one file
    dealt = table.select("kmer", "cnt").repartition(buckets, "kmer")
    dealt.write.bucketBy(buckets, "kmer").sortBy("kmer").option("path", f"{path}/kmers").format("parquet").mode("overwrite").saveAsTable(_name(path))
    note = json.dumps({"settings": asdict(settings), "buckets": buckets})
    spark.createDataFrame([(note,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/settings")


def open_kmer_table(spark: SparkSession, path: str) -> DataFrame:
    """A finished table; a session that doesn't know it yet is told of its buckets."""
    found = settings_of(spark, path)
    if found is None:
        raise FileNotFoundError(f"no finished k-mer table at {path}")
    if not spark.catalog.tableExists(_name(path)):
        spark.sql(f"create table {_name(path)} (kmer string, cnt bigint) using parquet clustered by (kmer) sorted by (kmer) into {found[1]} buckets location '{path}/kmers'")
    return spark.table(_name(path))


def counted_table(reads: DataFrame, path: str, settings: Settings, buckets: int | None = None, reuse: bool = True, rebuild: bool = False) -> DataFrame:
    """The table of the k-mers of reads at path. With reuse, a finished table of the same settings is taken as it is; one of
    other settings is an error, unless it may be rebuilt. Without reuse it is counted anew."""
    spark = reads.sparkSession
    found = settings_of(spark, path)
    if reuse and found and found[0] == settings:
        return open_kmer_table(spark, path)
    if reuse and found and not rebuild:
        raise OtherSettings(f"{path} holds {found[0]}, not {settings}")
    s = settings
    counted = count_kmers(reads, s.k, s.ci, s.cx, s.cs, s.both_strands, s.compress)
    save_kmer_table(counted, path, settings, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
    return open_kmer_table(spark, path)
