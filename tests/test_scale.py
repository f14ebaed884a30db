"""What holds when records are long and tables small: tasks, strips, odd files, errors."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strandlake.operators import genome, kmers, offtargets, reads, sites
from strandlake.plans import derived, registry
from strandlake.sources import readers, writers

D = "/root/testdata/sf0.001"
GENES = "gene_id string, gene_name string, chr string, g_start long, g_end long, strand string"


def test_windows_are_dealt_to_more_tasks_than_chromosomes(spark):
    rng = random.Random(1)
    one = spark.createDataFrame([("1", "".join(rng.choices("ACGT", k=50_000)))], "chr string, sequence string").coalesce(1)
    spans = one.select("chr", F.length("sequence").alias("length"))
    windows = offtargets.genome_windows(spans, genome.tile_genome(one, 512), 20, 512)
    held = Counter(r.p for r in windows.select(F.spark_partition_id().alias("p")).collect())
    assert sum(held.values()) == 50_000 - 19 and len(held) > 1 and max(held.values()) < 0.6 * sum(held.values())


def test_tiles_are_written_once(spark, tmp_path):
    path = str(tmp_path / "tiles")
    writers.write_tiles(derived.tiles(spark, D), path)
    tiles = spark.read.parquet(path)
    assert sorted(map(tuple, tiles.collect())) == sorted(map(tuple, derived.tiles(spark, D).collect()))


@pytest.mark.parametrize("k", [1, 25, 31, 32, 200])
def test_long_records_count_like_short_ones(spark, k):
    rng = random.Random(k)
    seqs = ["".join(rng.choices("ACGTN", (30, 30, 30, 30, 0.1), k=n)) for n in (9000, 4096, 4097, 4096 + k - 1, 8192, k, k - 1, 0)] + ["ACGT" * 2500, None]
    table = spark.createDataFrame(list(enumerate(seqs)), "read_id int, sequence string")
    want = Counter(s[i : i + k] for s in seqs if s for i in range(len(s) - k + 1) if "N" not in s[i : i + k])
    got = {r.kmer: r.cnt for r in kmers.count_kmers(table, k, ci=1, cs=10**9, both_strands=False).collect()}
    assert got == dict(want)
    at = {(r.read_id, r.pos) for r in kmers.read_kmers(table, k, keep=("read_id",)).select("read_id", "pos").collect()}
    assert at == {(i, p + 1) for i, s in enumerate(seqs) if s for p in range(len(s) - k + 1)}


def test_masks_of_a_long_read(spark):
    rng, k = random.Random(2), 11
    seqs = ["".join(rng.choices("ACGT", k=n)) for n in (60_000, 40, k, 5, 0)] + [None]
    valid = {seqs[0][i : i + k] for i in rng.sample(range(59_000), 3000)} | {seqs[1][20 : 20 + k], seqs[2]}
    table = spark.createDataFrame([(x, 1) for x in sorted(valid)], "kmer string, cnt long")
    got = {r.read_id: r.sequence for r in reads.mask_reads(spark.createDataFrame(list(enumerate(seqs)), "read_id int, sequence string"), table, k, both_strands=False).collect()}
    for i, s in enumerate(seqs):
        cover = {p + j for p in range(len(s or "") - k + 1) if s[p : p + k] in valid for j in range(k)}
        assert got[i] == (None if s is None else "".join(c if p in cover else "N" for p, c in enumerate(s)))


def test_fasta_marks_begin_lines(spark, tmp_path):
    (tmp_path / "a.fa").write_text("\n>a some A->C change > here\nACG\nT\n\n>b\r\nGG\r\nTT\r\n>c\n")
    (tmp_path / "b.fa").write_text(">d x\nAA")
    got = {(r.name, r.description, r.sequence) for r in readers.read_fasta(spark, [str(tmp_path / "a.fa"), str(tmp_path / "b.fa")]).collect()}
    assert got == {("a", "some A->C change > here", "ACGT"), ("b", "", "GGTT"), ("c", "", ""), ("d", "x", "AA")}


def test_fastq_blank_tails_and_splits(spark, tmp_path):
    rng = random.Random(3)
    want = set()
    for f in range(3):
        rows = [(f"r{f}_{i}", "".join(rng.choices("ACGT", k=30)), "@" + "I" * 29) for i in range(400)]
        want |= set(rows)
        (tmp_path / f"{f}.fq").write_text("".join(f"@{a} more\n{b}\n+\n{c}\n" for a, b, c in rows) + "\n" * f)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert {tuple(r) for r in readers.read_fastq(spark, str(tmp_path)).collect()} == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_errors_of_loci_and_names(spark):
    tiles = genome.tile_genome(spark.createDataFrame([("1", "ACGT" * 20)], "chr string, sequence string"), 32)
    genes = spark.createDataFrame([("G1", "a", "1", 1, 40, "+"), ("G2", "b", "1", 60, 90, "+"), ("G3", "b", "2", 1, 20, "+")], GENES)
    exons = spark.createDataFrame([("G1", "T1", "1", "+", 1, 20)], "gene_id string, transcript_id string, chr string, strand string, e_start long, e_end long")
    for bad in ("gene_id = 'G2'", "gene_id = 'G3'"):
        with pytest.raises(Exception, match=genome.BEYOND):
            genome.gene_sequences(genes.where(bad), tiles, 32).collect()
    with pytest.raises(Exception, match=genome.BEYOND):
        sites.pre_mrna_sites(genes.where("gene_id = 'G2'"), tiles, 10, size=32).collect()
    for bad in ({"gene_ids": ["G1", "G9"]}, {"gene_names": ["b"]}, {"gene_names": ["zz"]}):
        with pytest.raises(ValueError):
            sites.create_target(genes, exons, tiles, 8, "pre-mrna", size=32, **bad)
    with pytest.raises(ValueError):
        sites.create_target(genes, exons, tiles, 8, "transcriptomic", gene_ids=["G1"], size=32)
    spliced = spark.createDataFrame([("T1", "ACGTACGTAC"), ("T2", "ACGTACGTAC")], "transcript_id string, sequence string")
    got = sites.create_target(genes, exons, tiles, 8, "transcriptomic", gene_ids=["G1"], size=32, transcripts=spliced).collect()
    assert sorted((r.gene_id, r.site_id, r.sequence) for r in got) == [("G1", f"T1:{i}-{i + 8}", "ACGTACGTAC"[i : i + 8]) for i in range(3)]


@pytest.mark.parametrize(("k", "d"), [(9, 2), (8, 0), (4, 3), (5, 3), (6, 1)])
def test_pigeonhole_finds_every_pair_once(spark, k, d):
    rng = random.Random(k)
    strings = lambda n: ["".join(rng.choices("ACGT", k=k)) for _ in range(n)]
    a, b = strings(60), strings(60)
    got = Counter((r.i, r.j, r.mismatches) for r in offtargets.within_mismatches(spark.createDataFrame(list(enumerate(a)), "i int, query string"), spark.createDataFrame(list(enumerate(b)), "j int, target string"), k, d).collect())
    far = lambda x, y: sum(p != q for p, q in zip(x, y, strict=True))
    assert got == Counter((i, j, far(x, y)) for i, x in enumerate(a) for j, y in enumerate(b) if far(x, y) <= d)


def test_kmer_orders(spark):
    assert [r.kmer for r in registry.sorted_kmers(spark, D).collect()] == sorted(r.kmer for r in registry.sorted_kmers(spark, D).collect())
    listed = [(r.gene_id, r.ordinal) for r in registry.list_sites(spark, D).collect()]
    assert listed == sorted(listed)
