"""Target sites: windows of k bases of genes, exons or transcripts, with stable ids; many genes at once.

Genomic sites are 1-based and inclusive, transcript sites 0-based and half-open. (gene_id, site_id) is the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandlake.functions.sequence import numbered_id, site_id_stem, transcript_site_id, window_starts

from .genome import TILE, distinct_exons, windows_of
from .joins import beside, merged

REGIONS = {"exonic_only": "Exon", "pre-mrna": "Premrna", "transcriptomic": "Transcript"}
COLUMNS = ["gene_id", "site_id", "chr", "start", "end", "strand", "sequence"]


def _stem(region: str, prefix: str) -> Column:
    """What all site ids of a gene begin with, made before genes grow to windows."""
    return site_id_stem(F.lit(prefix), F.col("gene_name"), REGIONS[region]).alias("stem")


def _named(windows: DataFrame, ordinal: Column, first: int) -> DataFrame:
    numbered = windows.withColumn("site_id", numbered_id(F.col("stem"), ordinal + (first - 1)))
    return numbered.select("gene_id", "site_id", "chr", F.col("w_start").alias("start"), F.col("w_end").alias("end"), "strand", "sequence")


def pre_mrna_sites(genes: DataFrame, tiles: DataFrame, k: int, prefix: str = "SL", first: int = 1, size: int = TILE) -> DataFrame:
    """Every window over a gene's span; the ordinal is the offset, so nothing is sorted."""
    spans = genes.select("gene_id", _stem("pre-mrna", prefix), "chr", F.col("g_start").alias("start"), F.col("g_end").alias("end"), "strand")
    return _named(windows_of(spans, tiles, k, size), F.col("w_offset") + 1, first)


def exonic_sites(
    exons: DataFrame, genes: DataFrame, tiles: DataFrame, k: int, prefix: str = "SL", first: int = 1, size: int = TILE, distinct_sites: bool = False
) -> DataFrame:
    """Every window inside each distinct exon, numbered through the gene by (exon start, exon end, offset).

    A window in two overlapping exons comes twice under two ids, unless distinct_sites: then each exon begins with the
    first window that no exon before it has. Only exons are sorted, to sum how many windows come before each."""
    spans = distinct_exons(exons, genes)
    if distinct_sites:
        before = Window.partitionBy("gene_id", "chr", "strand").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
        spans = spans.withColumn("start", F.greatest(F.col("start"), F.coalesce(F.max(F.col("end") - k + 2).over(before), F.col("start"))))
    count = F.greatest(F.col("end") - F.col("start") - k + 2, F.lit(0))
    before = Window.partitionBy("gene_id").orderBy("start", "end", "chr", "strand").rowsBetween(Window.unboundedPreceding, -1)
    found = windows_of(spans.withColumn("n_before", F.coalesce(F.sum(count).over(before), F.lit(0))).withColumn("stem", _stem("exonic_only", prefix)), tiles, k, size)
    return _named(found, F.col("n_before") + F.col("w_offset") + 1, first)


def transcript_sites(transcripts: DataFrame, k: int) -> DataFrame:
    """(transcript_id, t_start, t_end, sequence) of every window of spliced transcripts (transcript_id, sequence)."""
    if k < 1:
        raise ValueError("k must be at least 1")
    at = transcripts.select("transcript_id", "sequence", F.explode(window_starts(F.length("sequence"), k)).alias("i"))
    return at.select("transcript_id", F.col("i").cast("long").alias("t_start"), (F.col("i") + k).cast("long").alias("t_end"), F.substring("sequence", F.col("i") + 1, F.lit(k)).alias("sequence"))


def to_genomic(sites: DataFrame, exons: DataFrame) -> DataFrame:
    """Genomic blocks (chr, start, end, strand, block) of transcript sites (transcript_id, t_start, t_end).

    Exons are ranked along the transcript and their lengths summed; a site overlaps each exon it touches."""
    rank = F.when(F.col("strand") == "-", -F.col("e_start")).otherwise(F.col("e_start"))
    along = Window.partitionBy("transcript_id").orderBy(rank, "e_end")
    size = F.col("e_end") - F.col("e_start") + 1
    laid = exons.select("transcript_id", "chr", "strand", "e_start", "e_end", F.sum(size).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("off_end"), F.row_number().over(along).alias("exon_rank"))
    laid = laid.withColumn("off_start", F.col("off_end") - size)
    hit = sites.join(laid, "transcript_id").where((F.col("t_start") < F.col("off_end")) & (F.col("off_start") < F.col("t_end")))
    a, b = F.greatest("t_start", "off_start") - F.col("off_start"), F.least("t_end", "off_end") - F.col("off_start")
    minus = F.col("strand") == "-"
    start = F.when(minus, F.col("e_end") - b + 1).otherwise(F.col("e_start") + a)
    end = F.when(minus, F.col("e_end") - a).otherwise(F.col("e_start") + b - 1)
    return hit.select(*sites.columns, "chr", start.alias("start"), end.alias("end"), "strand", F.col("exon_rank").cast("long").alias("exon_rank"))


def _chosen(genes: DataFrame, column: str, wanted: list[str] | DataFrame) -> DataFrame:
    """The genes named; a name that none has, or a gene name that several have, is an error. A frame of one column names any
    number of genes."""
    if isinstance(wanted, DataFrame):
        names = wanted.toDF(column).distinct()
        found = merged(genes, names, column, "left_semi").select(*genes.columns)
        missing = [r[0] for r in merged(names, genes, column, "left_anti").limit(10).collect()]
        several = found.groupBy(column).agg(F.countDistinct("gene_id").alias("n")).where("n > 1").limit(10)
        several = [r[0] for r in several.collect()]
    else:
        found = genes.where(F.col(column).isin(wanted))
        seen = {r[0]: r[1] for r in found.groupBy(column).agg(F.countDistinct("gene_id")).collect()}
        missing, several = sorted(set(wanted) - seen.keys()), sorted(x for x, n in seen.items() if n > 1)
    if missing:
        raise ValueError(f"no gene with {column} {missing}")
    if several:
        raise ValueError(f"more than one gene with {column} {several}")
    return found


def create_target(
    genes: DataFrame, exons: DataFrame, tiles: DataFrame, k: int, region: str, gene_ids: list[str] | DataFrame | None = None, gene_names: list[str] | DataFrame | None = None,
    prefix: str = "SL", size: int = TILE, transcripts: DataFrame | None = None,
) -> DataFrame:
    """Sites of the genes named by id or by name (exactly one of the two), in a region of REGIONS.

    transcriptomic takes spliced transcripts (transcript_id, sequence) and gives gene_id, site_id, transcript_id, t_start,
    t_end and sequence; the exons say which transcripts a gene has."""
    if region not in REGIONS:
        raise ValueError(f"region must be one of {sorted(REGIONS)}, not {region}")
    if (region == "transcriptomic") != (transcripts is not None):
        raise ValueError("transcripts go with the transcriptomic region")
    if (gene_ids is None) == (gene_names is None):
        raise ValueError("exactly one of gene_ids and gene_names")
    chosen = _chosen(genes, "gene_id", gene_ids) if gene_ids is not None else _chosen(genes, "gene_name", gene_names)
    if region == "pre-mrna":
        return pre_mrna_sites(chosen, tiles, k, prefix, size=size)
    if region == "exonic_only":
        return exonic_sites(exons, chosen, tiles, k, prefix, size=size)
    owners = merged(exons, chosen.select("gene_id"), "gene_id", "left_semi").select("gene_id", "transcript_id").distinct()
    found = merged(transcript_sites(merged(transcripts, owners.select("transcript_id").distinct(), "transcript_id", "left_semi"), k), owners, "transcript_id")
    named = found.withColumn("site_id", transcript_site_id(F.col("transcript_id"), F.col("t_start"), F.col("t_end")))
    return named.select("gene_id", "site_id", "transcript_id", "t_start", "t_end", "sequence")


def site_by_id(sites: DataFrame, wanted: str) -> DataFrame:
    found = sites.where(F.col("site_id") == wanted)
    if found.isEmpty():
        raise KeyError(wanted)
    return found


def add_sites(sites: DataFrame, more: DataFrame) -> DataFrame:
    """Both; an id that is there already is an error."""
    if not more.select("gene_id", "site_id").join(sites.select("gene_id", "site_id"), ["gene_id", "site_id"], "left_semi").isEmpty():
        raise ValueError("a site with this id exists")
    return sites.unionByName(more)


def remove_sites(sites: DataFrame, gone: DataFrame) -> DataFrame:
    """sites without those of gone (gene_id, site_id); an id that isn't there is an error of the job that reads the result, so
    that sites are evaluated once."""
    both = beside(sites.withColumn("here", F.lit(True)), gone.select("gene_id", "site_id"), "full")
    missing = F.col("here").isNull()
    return both.where(F.when(missing, F.raise_error(F.lit("no site with this id")).cast("boolean")).otherwise(F.col("other_site").isNull())).select(*sites.columns)


def list_sites(sites: DataFrame) -> DataFrame:
    """The sites with their ordinal, by gene and ordinal."""
    ordinal = F.regexp_extract("site_id", "([0-9]+)$", 1).cast("long").alias("ordinal")
    return sites.select(*COLUMNS, ordinal).orderBy("gene_id", "ordinal")


def distinct_transcript_sites(sites: DataFrame) -> DataFrame:
    """Sites are equal if id, transcript and both ends are."""
    return sites.dropDuplicates(["site_id", "transcript_id", "t_start", "t_end"])


def site_length(sites: DataFrame) -> Column:
    """end - start + 1 of genomic, t_end - t_start of transcript sites."""
    return F.col("t_end") - F.col("t_start") if "t_start" in sites.columns else F.col("end") - F.col("start") + 1
