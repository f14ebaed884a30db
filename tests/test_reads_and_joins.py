"""Reads without usable ids, intervals that don't fit, joins with heavy keys: against plain Python."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strandlake.operators import genome, offtargets, reads, sites
from strandlake.operators.joins import split_join

GENES = "gene_id string, gene_name string, chr string, g_start long, g_end long, strand string"


def rc(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


@pytest.mark.parametrize("k", [4, 33])
def test_reads_that_share_ids_or_have_none(spark, k):
    rng = random.Random(k)
    seqs = ["".join(rng.choices("ACGT", k=rng.choice([k - 1, k, 60]))) for _ in range(30)] + ["ACGTACGTAA" * 4, "T" * 40, "", None, "ACNGT" * 9]
    rows = [(rng.choice(["r1", "r1", "r2", None]), s, "I" * len(s) if s is not None else None, i) for i, s in enumerate(seqs)]
    rows += rows[:5]
    valid = {s[i : i + k] for s in seqs[::2] if s for i in range(0, len(s) - k + 1, 2) if "N" not in s[i : i + k]}
    frame = spark.createDataFrame(rows, "read_id string, sequence string, qual string, pos long")
    table = spark.createDataFrame([(x, 1) for x in sorted(valid)], "kmer string, cnt long")
    hit = lambda s: [s[i : i + k] in valid for i in range(len(s or "") - k + 1)]
    kept = reads.filter_reads(frame, table, k, 2, 20, both_strands=False)
    assert kept.columns == frame.columns and Counter(map(tuple, kept.collect())) == Counter(r for r in rows if 2 <= sum(hit(r[1])) <= 20)

    def trimmed(s):
        return s if s is None or all(hit(s)) else s[: 0 if hit(s).index(False) == 0 else hit(s).index(False) + k - 1]

    got = Counter(map(tuple, reads.trim_reads(frame, table, k, both_strands=False).collect()))
    assert got == Counter((i, t := trimmed(s), q if t is None else q[: len(t)], p) for i, s, q, p in rows)

    def masked(s):
        cover = {i + j for i, h in enumerate(hit(s)) if h for j in range(k)}
        return s and "".join(c if i in cover else "N" for i, c in enumerate(s))

    got = Counter(map(tuple, reads.mask_reads(frame, table, k, both_strands=False).collect()))
    assert got == Counter((i, masked(s), q, p) for i, s, q, p in rows)


def test_pairs(spark):
    table = spark.createDataFrame([("ACG", 1), ("GGG", 1)], "kmer string, cnt long")
    frame = lambda rows: spark.createDataFrame(rows, "read_id string, sequence string")
    first = frame([("a", "ACGG"), ("b", "TTTT"), ("c", "GGGG"), (None, "ACG"), ("d", "ACG")])
    second = frame([("a", "GGGT"), ("b", "ACG"), ("c", "TTT"), (None, "ACG"), ("d", "TT")])
    names = lambda df: sorted(r.read_id for r in df.collect())
    both = reads.filter_pairs(first, second, table, 3, read_ci=1, both_strands=False)
    assert [names(x) for x in both] == [["a"], ["a"]] and both[1].first().sequence == "GGGT"
    assert [names(x) for x in reads.filter_pairs(first, second, table, 3, either=True, read_ci=1, both_strands=False)] == [list("abcd")] * 2


def test_intervals_never_vanish(spark):
    tiles = genome.tile_genome(spark.createDataFrame([("1", "ACGT" * 20)], "chr string, sequence string"), 32)
    spans = lambda *x: spark.createDataFrame(x, "chr string, start long, end long, strand string")
    for bad in (("9", 1, 40), ("1", 97, 130), ("1", 200, 240), ("1", 60, 90), ("1", 0, 20), (None, 1, 20)):
        with pytest.raises(Exception, match=genome.BEYOND):
            genome.windows_of(spans((*bad, "+"), ("1", 1, 20, "+")), tiles, 10, 32).collect()
    genes = spark.createDataFrame([("G1", "a", "1", 1, 40, "+"), ("G2", "b", "7", 1, 40, "-")], GENES)
    exons = spark.createDataFrame([("G2", "T1", "7", "-", 1, 20)], "gene_id string, transcript_id string, chr string, strand string, e_start long, e_end long")
    with pytest.raises(Exception, match=genome.BEYOND):
        sites.pre_mrna_sites(genes, tiles, 10, size=32).collect()
    with pytest.raises(Exception, match=genome.BEYOND):
        sites.exonic_sites(exons, genes, tiles, 10, size=32).collect()
    assert genome.windows_of(spans(("9", 1, 5, "+")), tiles, 10, 32).count() == 0  # no window of 10 in it


@pytest.mark.parametrize(("size", "k"), [(32, 10), (512, 140), (4096, 25), (4096, 256)])
def test_windows_of_tiles_of_any_size(spark, size, k):
    rng = random.Random(k)
    seq = "".join(rng.choices("ACGTN", k=9000))
    tiles = genome.tile_genome(spark.createDataFrame([("1", seq)], "chr string, sequence string"), size, 255)
    spans = [(1, 9000, "+"), (4000, 4500, "-"), (4097, 4097 + k - 1, "-"), (5, 4 + k, "+")]
    got = Counter((r.start, r.w_start, r.w_end, r.w_offset, r.sequence) for r in genome.windows_of(spark.createDataFrame([("1", *x) for x in spans], "chr string, start long, end long, strand string"), tiles, k, size).collect())
    turn = lambda s, strand: s if strand == "+" else s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    assert got == Counter((a, p, p + k - 1, p - a, turn(seq[p - 1 : p + k - 1], strand)) for a, b, strand in spans for p in range(a, b - k + 2))


def test_split_join_is_a_join(spark):
    rng = random.Random(1)
    left = [(rng.choice([1, 1, 1, 2, 3, None, *range(10, 60)]), rng.choice("ab"), i) for i in range(900)] + [(5, "a", 1000)] * 40
    right = [(rng.choice([1, 2, 2, 2, 3, None, *range(10, 60)]), rng.choice("ab"), i) for i in range(700)]
    a, b = spark.createDataFrame(left, "x int, y string, i int"), spark.createDataFrame(right, "x int, y string, j int")
    want = Counter((x, y, i, j) for x, y, i in left for u, v, j in right if (x, y) == (u, v) and x is not None)
    for share in (1, 8, 50, 2048):
        found = split_join(a, b, ["x", "y"], share, 1)
        assert found.columns == ["x", "y", "i", "j"] and Counter(map(tuple, found.collect())) == want
    assert split_join(a.limit(0), b, ["x", "y"]).count() == 0


def test_a_planted_repeat_is_many_tasks_work(spark):
    """100,000 copies of one window on one side, some hundreds of a site on the other."""
    repeat = spark.range(100_000).select(F.lit(7).cast("long").alias("code"), "id").unionByName(spark.range(20_000).select((F.col("id") + 100).alias("code"), "id"))
    ours = spark.range(40).select(F.lit(7).cast("long").alias("code"), F.col("id").alias("site")).unionByName(spark.range(500).select((F.col("id") + 100).alias("code"), F.col("id").alias("site")))
    for name, value in (("spark.sql.shuffle.partitions", "16"), ("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.enabled", "false")):
        spark.conf.set(name, value)
    try:
        held = Counter({r.p: r.n for r in split_join(ours, repeat, ["code"], 64).groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()})
    finally:
        for name, value in (("spark.sql.shuffle.partitions", "4"), ("spark.sql.adaptive.enabled", "true")):
            spark.conf.set(name, value)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(held.values()) == 40 * 100_000 + 500
    assert len(held) >= 12 and max(held.values()) < 0.25 * sum(held.values()), held


def test_off_targets_with_repeats_and_unknown_bases(spark):
    rng = random.Random(9)
    unit = "".join(rng.choices("ACGT", k=12))
    chroms = {"1": unit * 30 + "".join(rng.choices("ACGTN", (9, 9, 9, 9, 1), k=600)), "2": "A" * 90 + rc(unit) + "ACGNTTACG" * 5 + "N" * 40}
    tiles = genome.tile_genome(spark.createDataFrame(list(chroms.items()), "chr string, sequence string"), 64, 40)
    genes = [("G1", "a", "1", 1, 30, "+"), ("G2", "b", "2", 80, 110, "-"), ("G3", "c", "2", 90, 112, "+")]
    frame, k, d = spark.createDataFrame(genes, GENES), 12, 2
    own = sites.pre_mrna_sites(frame, tiles, k, size=64)
    listed = [(r.gene_id, r.site_id, r.sequence) for r in own.collect()]
    span = {g[0]: g[2:5] for g in genes}
    far = lambda a, b: sum(x != y for x, y in zip(a, b, strict=True))

    def hits(most, codes_only):
        out = Counter()
        for g, s, seq in listed:
            for strand, q in (("+", seq), ("-", rc(seq))):
                for c, whole in chroms.items():
                    for p in range(len(whole) - k + 1):
                        w = whole[p : p + k]
                        inside = c == span[g][0] and p + 1 >= span[g][1] and p + k <= span[g][2]
                        if far(q, w) <= most and not inside and not (codes_only and ("N" in q or "N" in w)):
                            out[g, s, c, p + 1, strand, far(q, w)] += 1
        return out

    exact = offtargets.exact_off_targets(own, genome.genome_codes(tiles, k, 64), frame, k)
    assert Counter((r.gene_id, r.site_id, r.chr, r.pos, r.hit_strand, 0) for r in exact.collect()) == hits(0, True)
    spans = spark.createDataFrame([(c, len(s)) for c, s in chroms.items()], "chr string, length long")
    by_strings = offtargets.near_off_targets(own, offtargets.genome_windows(spans, tiles, k, 64), frame, k, d)
    by_codes = offtargets.near_off_targets(own, genome.genome_codes(tiles, k, 64, unknown=d), frame, k, d)
    key = lambda df: Counter((r.gene_id, r.site_id, r.chr, r.pos, r.hit_strand, r.mismatches) for r in df.collect())
    want = hits(d, False)
    assert key(by_strings) == want
    # windows with more than d unknown bases can only match sites with the like
    assert key(by_codes) == Counter({x: n for x, n in want.items() if chroms[x[2]][x[3] - 1 : x[3] - 1 + k].count("N") <= d})


def test_repeats_once(spark):
    rows = [("G", f"s{i}", "1", i, "ACGT" if i % 2 else f"U{i}") for i in range(1, 40)] + [("H", "s", "1", 1, "ACGT")]
    frame = spark.createDataFrame(rows, "gene_id string, site_id string, chr string, start long, sequence string")
    (r,) = offtargets.repeat_groups(frame).collect()
    assert (r.gene_id, r.sequence, r.loci, r.starts) == ("G", "ACGT", 20, list(range(1, 40, 2)))


def test_targets_by_a_frame_of_names(spark):
    tiles = genome.tile_genome(spark.createDataFrame([("1", "ACGT" * 20)], "chr string, sequence string"), 32)
    genes = spark.createDataFrame([("G1", "a", "1", 1, 12, "+"), ("G3", "b", "1", 5, 20, "+"), ("G4", "b", "1", 5, 20, "+")], GENES)
    names = lambda *x: spark.createDataFrame([(n,) for n in x], "n string")
    one = sites.create_target(genes, None, tiles, 8, "pre-mrna", gene_names=names("a", "a"), size=32)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, sites.create_target(genes, None, tiles, 8, "pre-mrna", gene_names=["a"], size=32).collect()))
    for bad in ({"gene_names": names("a", "b")}, {"gene_names": names("zz")}, {"gene_ids": names("G1", "G9")}):
        with pytest.raises(ValueError):
            sites.create_target(genes, None, tiles, 8, "pre-mrna", size=32, **bad)


def test_codes_of_another_length_match_nothing(spark):
    tiles = genome.tile_genome(spark.createDataFrame([("1", "AAAAACCGT" * 5)], "chr string, sequence string"), 32)
    own = spark.createDataFrame([("G", "s", "ACC"), ("G", "t", "AACC")], "gene_id string, site_id string, sequence string")
    genes = spark.createDataFrame([("G", "g", "9", 1, 5, "+")], GENES)
    windows = genome.genome_codes(tiles, 4, 32)
    assert {r.site_id for r in offtargets.exact_off_targets(own, windows, genes, 4).collect()} == {"t"}
    assert {r.site_id for r in offtargets.exact_off_targets_in(own, tiles, genes, 4, 32).collect()} == {"t"}
    with pytest.raises(ValueError):
        offtargets.exact_off_targets(own, windows, genes)
