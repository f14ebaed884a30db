"""Writers. reuse=True keeps a finished output as it is, reuse=False makes it anew."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.operators.joins import merged


def _mode(reuse: bool) -> str:
    return "ignore" if reuse else "overwrite"


def target_rows(sites: DataFrame, genes: DataFrame) -> DataFrame:
    """One row for each gene with its sites in a map by id (a gene's sites are one JSON object by the format)."""
    site = F.struct("site_id", F.struct(*(F.col(f"s.{c}").alias(c) for c in ("chr", "start", "end", "strand", "sequence"))).alias("v"))
    maps = sites.select("gene_id", "site_id", F.struct("chr", "start", "end", "strand", "sequence").alias("s")).groupBy("gene_id").agg(F.map_from_entries(F.sort_array(F.collect_list(site))).alias("sites"))
    return merged(genes, maps, "gene_id").select(F.col("gene_id").alias("id"), F.col("gene_name").alias("name"), "chr", F.col("g_start").alias("start"), F.col("g_end").alias("end"), "strand", "sites")


def write_target_json(sites: DataFrame, genes: DataFrame, path: str, reuse: bool = False) -> None:
    """Gzip files; readers tell them by their names."""
    target_rows(sites, genes).write.mode(_mode(reuse)).json(path, compression="gzip")


def write_analysis(results: DataFrame, path: str, assembly: str, target: str, k: int, region: str, kind: str = "parquet", reuse: bool = False) -> None:
    """Results under their metadata as partition columns."""
    marked = results.withColumns({"assembly": F.lit(assembly), "target": F.lit(target), "k": F.lit(k), "region": F.lit(region)})
    marked.write.mode(_mode(reuse)).partitionBy("assembly", "target", "k", "region").format(kind).save(path)


def write_tiles(tiles: DataFrame, path: str, reuse: bool = False) -> None:
    """Genome tiles, dealt out and sorted by place, so that a genome is cut once; spark.read.parquet reads them."""
    tiles.repartitionByRange("chr", "tile").sortWithinPartitions("chr", "tile").write.mode(_mode(reuse)).parquet(path)


def write_kmer_table(table: DataFrame, path: str, reuse: bool = False) -> None:
    table.write.mode(_mode(reuse)).parquet(path)


def dump_kmers(table: DataFrame, path: str, in_order: bool = False, reuse: bool = False) -> None:
    """kmer<TAB>count lines."""
    (table.orderBy("kmer") if in_order else table).select("kmer", "cnt").write.mode(_mode(reuse)).option("sep", "\t").csv(path)


def write_reads(records: DataFrame, path: str, reuse: bool = False) -> None:
    """Records of as_fasta or as_fastq as text files."""
    records.write.mode(_mode(reuse)).text(path)
