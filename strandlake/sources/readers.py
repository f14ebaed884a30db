"""Readers for sequence and annotation files. All go through Spark's own readers, so any store that Spark knows will do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TARGET = "id string, name string, chr string, start long, end long, strand string, sequence string, sites map<string, struct<chr:string, start:bigint, end:bigint, strand:string, sequence:string>>"


def read_fasta(spark: SparkSession, paths: str | list[str], upper: bool = True) -> DataFrame:
    """(name, description, sequence) of each record; several files, and gzip, as Spark reads them. A record begins with > at
    the beginning of a line only; the separator takes it away, but for a file's first record."""
    raw = spark.read.option("lineSep", "\n>").text(paths).select(F.regexp_replace("value", r"^\s*>", "").alias("value")).where(F.trim("value") != "")
    head = F.regexp_extract("value", r"^([^\r\n]*)", 1)
    seq = F.regexp_replace(F.regexp_replace("value", r"^[^\r\n]*", ""), r"\s", "")
    return raw.select(
        F.regexp_extract(head, r"^(\S+)", 1).alias("name"), F.trim(F.regexp_replace(head, r"^\S+", "")).alias("description"),
        (F.upper(seq) if upper else seq).alias("sequence"),
    )


def read_fasta_lines(spark: SparkSession, paths: str | list[str], upper: bool = True) -> DataFrame:
    """(file, record, name, description, at, sequence): the sequence lines of FASTA files, each with its record (the number of
    header lines up to it in its file) and its 0-based place there. A header without sequence has one empty line.

    A record is never one row, so one of any length is many tasks' work: lines are summed up within the blocks that Spark
    reads, and one row for each block carries name and length over to the next. What stands before the first header of a
    file is none of any record. A gzip file is one block, as it can't be split; a line is one row, however long it is."""
    where = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    lines = spark.read.text(paths).select(*where, F.monotonically_increasing_id().alias("id"), F.regexp_replace("value", r"\s+$", "").alias("value"))
    head = F.startswith("value", F.lit(">"))
    size = F.when(head, 0).otherwise(F.length(F.regexp_replace("value", r"\s", "")))
    own = Window.partitionBy("file", "block").orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = lines.select("file", "block", "id", "value", head.alias("head"), size.cast("long").alias("size"))
    lines = lines.withColumns({"nth": F.count_if("head").over(own), "stop": F.sum("size").over(own), "title": F.max(F.when(F.col("head"), F.struct("id", "value"))).over(own)["value"]})
    # where a record begins in its block, so that places count from there
    lines = lines.withColumn("since", F.max(F.when(F.col("head"), F.col("stop"))).over(own))
    last = lines.groupBy("file", "block").agg(F.max(F.struct("id", "nth", "title", (F.col("stop") - F.coalesce("since", F.lit(0))).alias("left"))).alias("last"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    headed = F.col("last.nth") > 0
    # blocks without a header go on with the record before them
    blocks = last.withColumns({"records": F.coalesce(F.sum("last.nth").over(before), F.lit(0)), "total": F.coalesce(F.sum("last.left").over(before), F.lit(0))})
    begun = F.max(F.when(headed, F.struct("block", F.col("last.title").alias("title"), F.col("total").alias("total")))).over(before)
    blocks = blocks.withColumn("begun", begun).select("file", "block", "records", F.col("begun.title").alias("inherited"), (F.col("total") - F.coalesce("begun.total", F.lit(0))).alias("carried"))
    found = lines.join(blocks, ["file", "block"]).where(F.col("records") + F.col("nth") > 0)
    title = F.substring(F.coalesce("title", "inherited"), F.lit(2), F.length(F.coalesce("title", "inherited")))
    place = F.col("stop") - F.col("size") - F.coalesce("since", F.lit(0)) + F.when(F.col("since").isNull(), F.col("carried")).otherwise(0)
    seq = F.when(F.col("head"), "").otherwise(F.regexp_replace("value", r"\s", ""))
    return found.where(F.col("head") | (F.col("size") > 0)).select(
        "file", (F.col("records") + F.col("nth")).alias("record"), F.regexp_extract(title, r"^\s*(\S*)", 1).alias("name"), F.trim(F.regexp_replace(title, r"^\s*\S*", "")).alias("description"),
        place.alias("at"), (F.upper(seq) if upper else seq).alias("sequence"),
    )


def fasta_index(lines: DataFrame) -> DataFrame:
    """(file, record, name, description, length) of each record of read_fasta_lines."""
    return lines.groupBy("file", "record", "name", "description").agg(F.max(F.col("at") + F.length("sequence")).alias("length"))


def _numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, n, value): the lines of each file with their 0-based numbers.

    Spark numbers rows within a task; a small table of where each file block begins turns that into numbers within a file."""
    block = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    lines = spark.read.text(path).select("value", *block, F.monotonically_increasing_id().alias("id"))
    blocks = lines.groupBy("file", "block").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return lines.join(blocks, ["file", "block"]).select("file", (F.col("before") + F.col("id") - F.col("first")).alias("n"), "value")


def read_fastq(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(read_id, sequence, qual) of four-line records. Records may cross file splits, so lines are numbered first: quality
    lines may begin with @, and no other sign tells where a record starts. Blank lines at the end of a file are dropped."""
    part = lambda k: F.max(F.when(F.col("n") % 4 == k, F.col("value")))
    whole = _numbered_lines(spark, path).groupBy("file", F.floor(F.col("n") / 4).alias("record")).agg(part(0).alias("head"), part(1).alias("sequence"), part(3).alias("qual"))
    return whole.where(F.trim("head") != "").select(F.regexp_extract("head", r"^@(\S+)", 1).alias("read_id"), "sequence", "qual")


def read_gtf(spark: SparkSession, path: str) -> DataFrame:
    """(chr, source, feature, start, end, strand, gene_id, gene_name, transcript_id, exon_number, tags) of each line."""
    columns = "chr string, source string, feature string, start long, end long, score string, strand string, frame string, attributes string"
    rows = spark.read.option("sep", "\t").option("comment", "#").option("quote", "").schema(columns).csv(path)
    value = lambda name: F.nullif(F.regexp_extract("attributes", rf'(?:^|;)\s*{name} "([^"]*)"', 1), F.lit(""))
    number = F.nullif(F.regexp_extract("attributes", r'exon_number "?(\d+)', 1), F.lit("")).cast("int")
    tags = F.regexp_extract_all("attributes", F.lit(r'(?:^|;)\s*tag "([^"]*)"'), F.lit(1))
    names = [value(x).alias(x) for x in ("gene_id", "gene_name", "transcript_id")]
    return rows.select("chr", "source", "feature", "start", "end", "strand", *names, number.alias("exon_number"), tags.alias("tags"))


def genes_of(gtf: DataFrame) -> DataFrame:
    return gtf.where("feature = 'gene'").select("gene_id", F.coalesce("gene_name", "gene_id").alias("gene_name"), "chr", F.col("start").alias("g_start"), F.col("end").alias("g_end"), "strand")


def exons_of(gtf: DataFrame) -> DataFrame:
    return gtf.where("feature = 'exon'").select("gene_id", "transcript_id", "chr", "strand", F.col("start").alias("e_start"), F.col("end").alias("e_end"))


def read_list(spark: SparkSession, path: str) -> list[str]:
    """The paths that a list file names, one a line (a short file of the user's)."""
    return [r.value.strip() for r in spark.read.text(path).where(F.trim("value") != "").collect()]


def read_target_json(spark: SparkSession, path: str) -> DataFrame:
    """A row for each site of targets written by write_target_json: target columns as g_*; unknown keys are ignored."""
    one = spark.read.schema(TARGET).json(path)
    head = [F.col("id").alias("gene_id"), F.col("name").alias("gene_name"), F.col("start").alias("g_start"), F.col("end").alias("g_end")]
    return one.select(*head, F.explode(F.map_entries("sites")).alias("e")).select("gene_id", "gene_name", "g_start", "g_end", F.col("e.key").alias("site_id"), "e.value.*")


def read_kmer_table(spark: SparkSession, path: str, ci: int = 1, cx: int = 1_000_000_000) -> DataFrame:
    """A k-mer table with counts in ci..cx; the bounds reach the Parquet scan."""
    return spark.read.parquet(path).where(F.col("cnt").between(ci, cx))
