"""A synthetic genome derived from the given tables: bases are md5 digits, so every engine derives the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.operators.genome import tile_genome
from strandlake.operators.joins import merged, one_union
from strandlake.sources.readers import read_fasta_lines
from strandlake.sources.scratch import new_path

HEX, BASES = "0123456789abcdef", "ACGTACGTACGTACGT"
#: Tile size for chromosomes of 1,024 bases: small, so that windows cross tiles.
TILE = 256


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chrom(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat(F.lit("chr"), F.col("s_suppkey").cast("string"))
    part = lambda i: F.translate(F.md5(F.concat(name, F.lit("-"), i.cast("string"))), HEX, BASES)
    return _table(spark, d, "supplier").select(name.alias("chr"), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(32)), part), "").alias("sequence"))


def tiles(spark: SparkSession, d: str) -> DataFrame:
    return tile_genome(chrom(spark, d), TILE)


def spans(spark: SparkSession, d: str) -> DataFrame:
    return chrom(spark, d).select("chr", F.length("sequence").alias("length"))


def _gene_id(key: str):  # noqa: ANN202
    return F.concat(F.lit("G"), F.lpad(F.col(key).cast("string"), 8, "0"))


def gene(spark: SparkSession, d: str) -> DataFrame:
    chromosomes = _table(spark, d, "supplier").count()
    key = F.col("p_partkey")
    shift = (key * 37 % 700).cast("long")
    return _table(spark, d, "part").select(
        _gene_id("p_partkey").alias("gene_id"), F.col("p_name").alias("gene_name"),
        F.concat(F.lit("chr"), (key % chromosomes).cast("string")).alias("chr"), (1 + shift).alias("g_start"), (200 + shift).alias("g_end"),
        F.when(key % 2 == 0, "+").otherwise("-").alias("strand"),
    )


def exon(spark: SparkSession, d: str) -> DataFrame:
    lines = _table(spark, d, "lineitem").select(_gene_id("l_partkey").alias("gene_id"), F.concat(F.lit("T"), F.col("l_orderkey").cast("string")).alias("transcript_id"), "l_linenumber", "l_quantity")
    first = F.col("g_start") + (F.col("l_linenumber") - 1) * 25
    return merged(lines, gene(spark, d), "gene_id").select("gene_id", "transcript_id", "chr", "strand", first.cast("long").alias("e_start"), (first + 19 + F.col("l_quantity").cast("long") % 7).cast("long").alias("e_end"))


def _md5_bases(prefix: str):  # noqa: ANN202
    return F.translate(F.md5(F.concat(F.lit(prefix), F.col("p_partkey").cast("string"))), HEX, BASES)


def seqs(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "part").select(F.col("p_partkey").alias("seq_id"), F.concat(_md5_bases("p"), _md5_bases("x")).alias("sequence"))


def reads(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "part").select(F.col("p_partkey").alias("read_id"), _md5_bases("r").alias("sequence"))


def mates(spark: SparkSession, d: str) -> DataFrame:
    """Second mates of reads: the same ids, other bases, and every third one the first mate's own sequence."""
    key = F.col("p_partkey")
    return _table(spark, d, "part").select(key.alias("read_id"), F.when(key % 3 == 0, _md5_bases("r")).otherwise(_md5_bases("m")).alias("sequence"))


def both_reads(spark: SparkSession, d: str) -> DataFrame:
    """(mate, read_id, sequence) of both files: an id is in each."""
    return one_union([x.withColumn("mate", F.lit(m)).select("mate", "read_id", "sequence") for m, x in ((1, reads(spark, d)), (2, mates(spark, d)))])


def fasta_lines(spark: SparkSession, d: str) -> DataFrame:
    """The chromosomes, read line by line from a FASTA file of 60 bases a line."""
    path = new_path(spark, "chromosomes")
    wrapped = F.regexp_replace("sequence", "(.{60})", "$1\n")
    chrom(spark, d).select(F.concat(F.lit(">"), "chr", F.lit(" derived\n"), wrapped).alias("value")).write.text(path)
    return read_fasta_lines(spark, path)


#: The same views in SQL for DuckDB; each may use those before it.
SQL = {
    "chrom": """select concat('chr', cast(s_suppkey as varchar)) chr, string_agg(translate(md5(concat('chr', cast(s_suppkey as varchar), '-', cast(i as varchar))),
      '0123456789abcdef', 'ACGTACGTACGTACGT'), '' order by i) as sequence from supplier, range(1, 33) t(i) group by s_suppkey""",
    "gene": """select concat('G', lpad(cast(p_partkey as varchar), 8, '0')) gene_id, p_name gene_name, concat('chr', cast(p_partkey % (select count(*) from supplier) as varchar)) chr,
      cast(1 + (p_partkey * 37) % 700 as bigint) g_start, cast(200 + (p_partkey * 37) % 700 as bigint) g_end, case when p_partkey % 2 = 0 then '+' else '-' end strand from part""",
    "exon": """select g.gene_id, concat('T', cast(l_orderkey as varchar)) transcript_id, g.chr, g.strand, cast(g_start + (l_linenumber - 1) * 25 as bigint) e_start,
      cast(g_start + (l_linenumber - 1) * 25 + 19 + cast(l_quantity as bigint) % 7 as bigint) e_end from lineitem join gene g on g.gene_id = concat('G', lpad(cast(l_partkey as varchar), 8, '0'))""",
    "seqs": """select p_partkey seq_id, translate(md5(concat('p', cast(p_partkey as varchar))) || md5(concat('x', cast(p_partkey as varchar))), '0123456789abcdef', 'ACGTACGTACGTACGT') as sequence from part""",
    "reads": """select p_partkey read_id, translate(md5(concat('r', cast(p_partkey as varchar))), '0123456789abcdef', 'ACGTACGTACGTACGT') as sequence from part""",
    "both_reads": """select cast(m as integer) mate, p_partkey read_id, translate(md5(concat(case when m = 1 or p_partkey % 3 = 0 then 'r' else 'm' end, cast(p_partkey as varchar))), '0123456789abcdef', 'ACGTACGTACGTACGT') as sequence
      from part, range(1, 3) t(m)""",
}


def sql(body: str, *views: str, **more: str) -> str:
    """One statement: the views asked for, further ones in their order, then the body."""
    return "with " + ", ".join(f"{name} as ({text})" for name, text in [*((v, SQL[v]) for v in views), *more.items()]) + " " + body
