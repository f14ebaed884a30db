"""Frames that grow to windows are never broadcast, however small the files look that they come from."""

import random

import pytest
from pyspark.sql import functions as F

from strandlake.functions import sequence as fs
from strandlake.operators import genome, sites
from strandlake.plans import derived, registry
from strandlake.sources import readers, writers

D = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "create_transcript_target", "pre_mrna_sites", "exonic_sites", "sequence_by_locus", "near_off_targets", "all_near_off_targets", "off_target_summary", "all_off_target_summary",
    "exact_off_targets", "filtered_off_targets", "gathered_analyses",
])
def test_windows_are_not_broadcast(spark, name):
    assert "Broadcast" not in plan(registry.QUERIES[name](spark, D))


def test_histogram_counts_kmers_of_any_counter(spark, monkeypatch):
    table = spark.createDataFrame([("AAAAAA", 20_000), ("CCCCCC", 60)], "kmer string, cnt long")
    monkeypatch.setattr(registry, "_a", lambda spark, d: table)
    assert [r.cnt for r in registry.written_outputs(spark, D).where("output = 'histogram'").collect()] == [2]


def test_removed_sites_are_looked_for_once(spark):
    own = registry.pre_mrna_sites(spark, D).where("gene_id = 'G00000003'")
    gone = own.select("gene_id", "site_id").where("site_id like '%1'")
    assert sites.remove_sites(own, gone.unionAll(gone)).count() == own.count() - gone.count()
    kept = sites.remove_sites(own, gone)
    assert plan(kept).count("Join") == 2 * plan(own).count("Join") + 1
    with pytest.raises(Exception, match="no site with this id"):
        sites.remove_sites(own, gone.withColumn("site_id", F.concat("site_id", F.lit("x")))).collect()


def test_removed_sites_are_dealt_with_their_neighbours(spark):
    own = registry.pre_mrna_sites(spark, D)
    last = [x for x in plan(registry.remove_sites(spark, D)).splitlines() if "Exchange hashpartitioning" in x and "gene_id" in x]
    assert len(last) == 1 and "site_id" not in last[0].split("hashpartitioning(")[1].split(")")[0]
    rows = spark.createDataFrame([("G", i) for i in ("", "a", "ab", "abc", "abd", "xbc", None)] + [(None, "abc"), ("H", "abc")], "gene_id string, site_id string")
    gone = rows.where("gene_id = 'G' and site_id in ('', 'ab', 'abc')")
    assert sorted(map(str, sites.remove_sites(rows, gone).collect())) == sorted(map(str, rows.subtract(gone).collect()))
    for bad in (rows.where("gene_id is null"), rows.where("site_id is null"), rows.where("gene_id = 'H'").selectExpr("'G' gene_id", "'abcd' site_id")):
        with pytest.raises(Exception, match="no site with this id"):
            sites.remove_sites(rows, bad).collect()
    assert own.columns == sites.remove_sites(own, own.select("gene_id", "site_id")).columns


def test_target_json_is_compressed(spark, tmp_path):
    genes = derived.gene(spark, D).where("gene_id = 'G00000003'")
    own = registry.pre_mrna_sites(spark, D).where("gene_id = 'G00000003'")
    writers.write_target_json(own, genes, str(tmp_path / "t"))
    assert {p.suffix for p in (tmp_path / "t").glob("part-*")} == {".gz"}
    back = readers.read_target_json(spark, str(tmp_path / "t")).select(*sites.COLUMNS)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, own.collect()))


def test_windows_turn_within_strips(spark):
    """Strips that end with the tile, the interval or the chromosome, on both strands."""
    bases = "".join(random.Random(5).choices("ACGTN", k=700))
    tiles = genome.tile_genome(spark.createDataFrame([("1", bases)], "chr string, sequence string"), 300)
    spans = spark.createDataFrame([(f"{a}{s}", "1", a, b, s) for a, b in ((1, 700), (3, 12), (120, 431), (690, 700)) for s in "+-"], "id string, chr string, start long, end long, strand string")
    got = {(r.id, r.w_start): r.sequence for r in genome.windows_of(spans, tiles, 9, 300).collect()}
    turned = str.maketrans("ACGT", "TGCA")
    want = {(r.id, w): bases[w - 1 : w + 8] if r.strand == "+" else bases[w - 1 : w + 8].translate(turned)[::-1] for r in spans.collect() for w in range(r.start, r.end - 7)}
    assert got == want


def test_site_ids_of_any_ordinal(spark):
    each = [0, 1, 42, 99_999, 100_000, 1_234_567]
    rows = spark.createDataFrame([(i, n) for i in each for n in ("a b", None)], "i long, name string")
    got = {(r.i, r.name): r.s for r in rows.select("i", "name", fs.site_id(F.lit("SL"), F.col("name"), "Premrna", F.col("i")).alias("s")).collect()}
    assert got == {(i, n): f"SL-{'a_b-' if n else ''}Premrna-S{i:05d}" for i in each for n in ("a b", None)}
