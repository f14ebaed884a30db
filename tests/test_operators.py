"""Operators on small inputs, held against plain Python."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strandlake.operators import analysis, genome, kmers, offtargets, reads, sites
from strandlake.sources import readers, writers

RC = str.maketrans("ACGT", "TGCA")


def rc(s):
    return s.translate(RC)[::-1]


@pytest.fixture(scope="module")
def world(spark):
    rng = random.Random(5)
    chroms = {c: "".join(rng.choice("ACGT") for _ in range(300)) for c in ("1", "X")}
    chrom = spark.createDataFrame(list(chroms.items()), "chr string, sequence string")
    genes = spark.createDataFrame([("G1", "g one", "1", 10, 120, "+"), ("G2", "g two", "X", 50, 90, "-")], "gene_id string, gene_name string, chr string, g_start long, g_end long, strand string")
    exons = spark.createDataFrame(
        [("G1", "T1", "1", "+", 10, 29), ("G1", "T1", "1", "+", 60, 69), ("G1", "T2", "1", "+", 10, 29), ("G1", "T2", "1", "+", 20, 40), ("G2", "T3", "X", "-", 50, 60), ("G2", "T3", "X", "-", 80, 90)],
        "gene_id string, transcript_id string, chr string, strand string, e_start long, e_end long",
    )
    return chroms, genome.tile_genome(chrom, 32, 40), genes, exons


def test_pre_mrna_sites(world):
    chroms, tiles, genes, _ = world
    got = sites.pre_mrna_sites(genes, tiles, 16, size=32).collect()
    assert len(got) == (111 - 15) + (41 - 15)
    for r in got:
        plain = chroms[r.chr][r.start - 1 : r.end]
        assert r.sequence == (rc(plain) if r.strand == "-" else plain) and len(plain) == 16
    assert {r.site_id for r in got if r.gene_id == "G2" and r.start == 50} == {"SL-g_two-Premrna-S00001"}


def test_exonic_sites_number_overlaps_apart(world):
    _, tiles, genes, exons = world
    got = sites.exonic_sites(exons, genes, tiles, 10, size=32).where("gene_id = 'G1'").orderBy("site_id").collect()
    assert [r.start for r in got] == [*range(10, 21), *range(20, 32), 60]
    once = sites.exonic_sites(exons, genes, tiles, 10, size=32, distinct_sites=True).where("gene_id = 'G1'").count()
    assert once == len({r.start for r in got})


def test_windows_longer_than_the_interval_and_bad_k(world):
    _, tiles, genes, _ = world
    assert sites.pre_mrna_sites(genes, tiles, 200, size=32).isEmpty()
    with pytest.raises(ValueError):
        sites.pre_mrna_sites(genes, tiles, 0, size=32)


def test_create_target_takes_exactly_one_key(world):
    _, tiles, genes, exons = world
    for bad in ({}, {"gene_ids": ["G1"], "gene_names": ["g one"]}):
        with pytest.raises(ValueError):
            sites.create_target(genes, exons, tiles, 16, "pre-mrna", size=32, **bad)
    with pytest.raises(ValueError):
        sites.create_target(genes, exons, tiles, 16, "introns", gene_ids=["G1"], size=32)
    assert sites.create_target(genes, exons, tiles, 16, "pre-mrna", gene_names=["g one"], size=32).count() == 96


def test_sequences_cross_tiles(world):
    chroms, tiles, genes, _ = world
    got = {r.gene_id: r.sequence for r in genome.gene_sequences(genes, tiles, 32).collect()}
    assert got == {"G1": chroms["1"][9:120], "G2": rc(chroms["X"][49:90])}


def test_gene_lookups(world):
    _, _, genes, _ = world
    assert genome.gene_by_id(genes, "G1").count() == 1
    for call in (lambda: genome.gene_by_id(genes, "no"), lambda: genome.gene_by_name(genes.unionAll(genes), "g one")):
        with pytest.raises(ValueError):
            call()


def test_invalid_strand_fails(spark, world):
    _, tiles, genes, _ = world
    with pytest.raises(Exception, match="strand"):
        sites.pre_mrna_sites(genes.withColumn("strand", F.lit("?")), tiles, 16, size=32).collect()


def test_transcript_to_genome(spark, world):
    _, _, _, exons = world
    t = spark.createDataFrame([("T1", 15, 25), ("T3", 8, 14)], "transcript_id string, t_start long, t_end long")
    got = {(r.transcript_id, r.start, r.end) for r in sites.to_genomic(t, exons).collect()}
    assert got == {("T1", 25, 29), ("T1", 60, 64), ("T3", 80, 82), ("T3", 58, 60)}


def test_adding_and_removing_sites(world):
    _, tiles, genes, _ = world
    s = sites.pre_mrna_sites(genes, tiles, 30, size=32)
    one = s.where("site_id like '%S00001'")
    with pytest.raises(ValueError):
        sites.add_sites(s, one)
    assert sites.remove_sites(s, one.select("gene_id", "site_id")).count() == s.count() - 2
    with pytest.raises(KeyError):
        sites.site_by_id(s, "none")


def test_windows_fit_the_overlap_of_tiles(spark):
    with pytest.raises(ValueError):
        genome.windows_of(spark.range(0).select(F.lit("1").alias("chr"), F.lit(1).alias("start"), F.lit(2).alias("end"), F.lit("+").alias("strand")), spark.range(0).select(F.lit("1").alias("chr"), F.col("id").alias("tile"), F.lit("").alias("sequence")), 257)


def test_counting(spark):
    seqs = ["ACGTACGTNACGT", "AAAAAA", "acgt", "", "AC", None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "read_id long, sequence string")
    c = Counter(s[i : i + 4] for s in seqs if s for i in range(len(s) - 3) if set(s[i : i + 4]) <= set("ACGT"))
    got = {r.kmer: r.cnt for r in kmers.count_kmers(df, 4, ci=1, both_strands=False).collect()}
    assert got == dict(c)
    both = Counter()
    for s, n in c.items():
        both[min(s, rc(s))] += n
    assert {r.kmer: r.cnt for r in kmers.count_kmers(df, 4, ci=2, cs=3).collect()} == {s: min(n, 3) for s, n in both.items() if n >= 2}


def test_set_algebra_identity(spark):
    a = spark.createDataFrame([("A", 5), ("C", 2), ("G", 1)], "kmer string, cnt long")
    b = spark.createDataFrame([("C", 3), ("G", 1), ("T", 9)], "kmer string, cnt long")
    as_dict = lambda df: {r.kmer: r.cnt for r in df.collect()}
    assert as_dict(kmers.union(a, b)) == {"A": 5, "C": 5, "G": 2, "T": 9}
    assert as_dict(kmers.intersect(a, b)) == {"C": 2, "G": 1}
    assert as_dict(kmers.subtract_counts(a, b)) == {"A": 5}
    assert as_dict(kmers.reverse_subtract_counts(a, b)) == {"C": 1, "T": 9}
    assert kmers.union(a, b).count() == a.count() + b.count() - kmers.intersect(a, b).count()


def test_reads(spark):
    df = spark.createDataFrame([(1, "ACGTAAAA"), (2, "TTTTTTTT"), (3, "AC"), (4, "")], "read_id long, sequence string")
    table = spark.createDataFrame([("ACGT", 3), ("CGTA", 2)], "kmer string, cnt long")
    how = {"k": 4, "both_strands": False}
    as_dict = lambda d: {r.read_id: r.sequence for r in d.collect()}
    assert as_dict(reads.trim_reads(df, table, **how)) == {1: "ACGTA", 2: "", 3: "AC", 4: ""}
    assert as_dict(reads.mask_reads(df, table, **how)) == {1: "ACGTANNN", 2: "NNNNNNNN", 3: "NN", 4: ""}
    assert set(as_dict(reads.filter_reads(df, table, read_ci=2, **how))) == {1}
    assert set(as_dict(reads.filter_reads(df, table, read_ci=0.5, read_cx=1.0, **how))) == set()


def test_pigeonhole_is_brute_force(spark):
    rng = random.Random(1)
    q = ["".join(rng.choice("ACGT") for _ in range(9)) for _ in range(60)]
    t = ["".join(rng.choice("ACGT") for _ in range(9)) for _ in range(400)]
    t += ["ACNTACGTA", q[0]]
    a, b = (spark.createDataFrame([(i, s) for i, s in enumerate(x)], f"{n}_id long, {name} string") for x, n, name in ((q, "q", "query"), (t, "t", "target")))
    got = sorted((r.q_id, r.t_id, r.mismatches) for r in offtargets.within_mismatches(a, b, 9, 2).collect())
    far = lambda x, y: sum(m != n for m, n in zip(x, y))
    assert got == sorted((i, j, far(x, y)) for i, x in enumerate(q) for j, y in enumerate(t) if far(x, y) <= 2)


def test_overlaps_over_bins(spark):
    hits = spark.createDataFrame([(1, "1", 5, 25), (2, "1", 40, 41), (3, "2", 1, 9)], "hit_id long, chr string, start long, end long")
    spans = spark.createDataFrame([("1", 1, 5), ("1", 20, 45), ("2", 10, 11)], "chr string, s_start long, s_end long")
    got = sorted((r.hit_id, r.s_start) for r in offtargets.overlapping(hits, spans, 8).collect())
    assert got == [(1, 1), (1, 20), (2, 20)]


def test_partitions_do_not_matter(world):
    _, tiles, genes, _ = world
    one = sites.pre_mrna_sites(genes.coalesce(1), tiles, 16, size=32)
    many = sites.pre_mrna_sites(genes.repartition(7), tiles.repartition(5), 16, size=32)
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()


def test_files(spark, world, tmp_path):
    _, tiles, genes, _ = world
    (tmp_path / "x.fa").write_text(">a first one\nAC\nGT\n\n>b\nacgn\n")
    assert {(r.name, r.sequence) for r in readers.read_fasta(spark, str(tmp_path / "x.fa")).collect()} == {("a", "ACGT"), ("b", "ACGN")}
    (tmp_path / "x.fq").write_text("@r1 x\nACGT\n+\n@@II\n@r2\nGG\n+\n@I\n")
    assert {tuple(r) for r in readers.read_fastq(spark, str(tmp_path / "x.fq")).collect()} == {("r1", "ACGT", "@@II"), ("r2", "GG", "@I")}
    (tmp_path / "list").write_text(f"{tmp_path}/x.fa\n\n")
    assert readers.read_list(spark, str(tmp_path / "list")) == [f"{tmp_path}/x.fa"]
    s = sites.pre_mrna_sites(genes, tiles, 30, size=32)
    writers.write_target_json(s, genes, str(tmp_path / "t"))
    assert readers.read_target_json(spark, str(tmp_path / "t")).select(*sites.COLUMNS).exceptAll(s).isEmpty()


def test_gather_keeps_all_sites(spark):
    a = spark.createDataFrame([("G", "1", 1.0)], "gene_id string, site_id string, x double")
    b = spark.createDataFrame([("G", "2", 2.0)], "gene_id string, site_id string, y double")
    assert {tuple(r) for r in analysis.gather([a, b]).collect()} == {("G", "1", 1.0, None), ("G", "2", None, 2.0)}
