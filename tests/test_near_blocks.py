"""Off-targets in blocks equal those of the joins, however genomes are cut, and no hit is shuffled."""

import random
from collections import Counter

import pytest

from strandlake.operators import analysis, genome, near, offtargets, sites
from strandlake.plans import derived, registry

D = "/root/testdata/sf0.001"
GENES = "gene_id string, gene_name string, chr string, g_start long, g_end long, strand string"


def made(spark, k, letters="ACGT", seed=1):
    """Chromosomes with repeats, genes over one another and beyond tiles, some on a chromosome that has no tile."""
    rng = random.Random(seed)
    unit = "".join(rng.choices("ACGT", k=2 * k))
    piece = lambda n: "".join(rng.choices(letters, [12] * 4 + [1] * (len(letters) - 4), k=n))
    chroms = {"1": piece(150) + unit * 6 + piece(200) + "A" * 40, "10": unit + piece(70) + unit[::-1].translate(str.maketrans("ACGT", "TGCA")), "2": piece(300) + unit + "T" * 30, "3": "ACG"}
    genes = [(f"G{i}", f"g {i}", c, a, min(a + n, len(chroms[c])), s) for i, (c, a, n, s) in enumerate([("1", 140, 90, "+"), ("1", 145, 60, "-"), ("1", 1, 400, "+"), ("10", 1, 50, "-"), ("2", 280, 90, "+"), ("2", 1, 30, "+")])]
    spans = [*genes, ("G9", "elsewhere", "9", 5, 80, "+")]
    tiles = genome.tile_genome(spark.createDataFrame(list(chroms.items()), "chr string, sequence string"), 32, 40)
    own, frame = spark.createDataFrame(genes, GENES), spark.createDataFrame(spans, GENES)
    return sites.pre_mrna_sites(own, tiles, k, size=32), tiles, frame


def rows(df):
    return Counter(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


@pytest.mark.parametrize(("k", "d", "most", "letters"), [(8, 2, 64, "ACGTN"), (16, 2, 64, "ACGTN"), (5, 0, 200, "ACGT"), (7, 3, 1 << 20, "ACGTNa")])
def test_blocks_find_what_joins_find(spark, monkeypatch, k, d, most, letters):
    monkeypatch.setattr(near, "HITS", 64)
    own, tiles, genes = made(spark, k, letters)
    windows = genome.genome_codes(tiles, k, 32, unknown=d)
    want = offtargets.near_off_targets(own, windows, genes, k, d)
    assert sum(rows(want).values()) > 100
    plain, other, _ = offtargets._dealt_out(own, genes, k, d)
    assert (other is not None) == (len(letters) > 4)
    got = rows(near.in_blocks(plain, tiles, genes, k, d, 32, 3, count=False, most=most))
    assert got == rows(want.join(plain.select("gene_id", "site_id"), ["gene_id", "site_id"], "left_semi"))
    counts = offtargets.off_target_summary(want, d, genes, k).join(plain.select("gene_id", "site_id"), ["gene_id", "site_id"], "left_semi")
    assert rows(near.in_blocks(plain, tiles, genes, k, d, 32, 3, count=True, most=most)) == rows(counts)
    assert rows(offtargets.near_off_targets_in(own, tiles, genes, k, d, 32)) == rows(want)


def test_odd_genes_and_sites(spark):
    own, tiles, genes = made(spark, 8)
    windows = genome.genome_codes(tiles, 8, 32, unknown=1)
    twice = genes.unionAll(genes.where("gene_id = 'G2'").selectExpr("gene_id", "gene_name", "'2' chr", "g_start", "g_end", "strand"))
    for some in (genes.where("gene_id <> 'G1'"), twice, genes.limit(0)):
        hits = offtargets.near_off_targets(own, windows, some, 8, 1)
        assert rows(offtargets.near_off_targets_in(own, tiles, some, 8, 1, 32)) == rows(hits)
        assert rows(offtargets.off_target_summary_in(own, tiles, some, 8, 1, 32)) == rows(offtargets.off_target_summary(hits, 1, some, 8))
    assert offtargets.off_target_summary_in(own.limit(0), tiles, genes, 8, 1, 32).count() == 0
    bare = own.select("gene_id", "site_id", "sequence")
    assert rows(offtargets.near_off_targets_in(bare, tiles, genes, 8, 1, 32)) == rows(offtargets.near_off_targets(own, windows, genes, 8, 1))


def test_counts_of_sites_in_blocks(spark):
    for k, most, letters in ((6, 64, "ACGTN"), (20, 200, "ACGT")):
        own, tiles, _ = made(spark, k, letters)
        odd = own.limit(3).selectExpr("gene_id", "concat(site_id, 'x') site_id", "chr", "start", "end", "strand", "substring(sequence, 2) sequence")
        own = own.unionAll(odd).unionAll(odd.selectExpr("gene_id", "concat(site_id, 'y') site_id", "chr", "start", "end", "strand", "cast(null as string) sequence"))
        want = rows(analysis.analyze_genome(own, offtargets.genome_counts(own, tiles, k, 32)))
        assert rows(near.occurrences(own, tiles, k, 32, 3, most)) == rows(offtargets.site_counts_in(own, tiles, k, 32)) == want
        assert len({x[1] for x in want}) > 2


def test_gathered_sites_stay_with_their_neighbours(spark):
    """No row is dealt by the whole of its id, or by its sequence."""
    plan = registry.gathered_analyses(spark, D)._jdf.queryExecution().executedPlan().toString()
    keys = [x.split("hashpartitioning(")[1] for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert keys and not any("site_id" in x or "sequence" in x or "code" in x for x in keys)
    one = spark.createDataFrame([("G", "abc", 1), ("G", "abd", 2), ("G", None, 3), ("G", "a", 4)], "gene_id string, site_id string, a int")
    two = spark.createDataFrame([("G", "abd", 5), ("G", "abd", 6), ("G", None, 7), ("H", "abc", 8)], "gene_id string, site_id string, b int")
    assert rows(analysis.gather([one, two])) == rows(one.join(two, ["gene_id", "site_id"], "full"))


def test_differences(spark):
    for k, d in ((4, 2), (14, 2), (9, 0), (5, 4)):
        x, far = near.differences(k, d)
        assert len(set(x.tolist())) == len(x) == near.n_differences(k, d) and far.max() == d


@pytest.mark.parametrize("name", ["near_off_targets", "all_near_off_targets", "off_target_summary", "all_off_target_summary"])
def test_hits_are_not_shuffled(spark, name):
    """Above the search no row moves."""
    plan = registry.QUERIES[name](spark, D)._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Repartition")]
    assert "MapInArrow" in above and "Join" not in above and "Aggregate" not in above


def test_summary_takes_every_site(spark):
    numbers = registry.off_target_summary(spark, D).selectExpr("cast(regexp_extract(site_id, '([0-9]+)$', 1) as int) % 100 n").distinct()
    assert numbers.count() == 100
