"""FASTA by lines: places over block borders, tiles, the index, counts; against plain Python and the record reader."""

import gzip
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strandlake.operators import genome, kmers
from strandlake.sources import readers


def wrapped(rng, records, end="\n"):
    out = ["; what is none of a record", ""] if rng.random() < 0.5 else []
    for name, seq in records:
        out.append(f">{name} about {name} > x")
        at = 0
        while at < len(seq):
            n = rng.choice([0, 1, 7, 60, 61, 200])
            out.append(seq[at : at + n] + " " * (n == 7))
            at += n
    return end.join(out) + end * rng.randrange(3)


def made(rng, prefix):
    sizes = [0, 1, 5, 59, 60, 61, 500, 4000, 20_000]
    rng.shuffle(sizes)
    return [(f"{prefix}{i}", "".join(rng.choices("ACGTNacgt", k=n))) for i, n in enumerate(sizes)]


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    rng, folder, records = random.Random(7), tmp_path_factory.mktemp("fasta"), {}
    for f, end in (("a", "\n"), ("b", "\r\n"), ("c", "\n")):
        own = made(rng, f)
        records |= dict(own)
        text = wrapped(rng, own, end).encode()
        (folder / f"{f}.fa").write_bytes(text) if f != "c" else (folder / "c.fa.gz").write_bytes(gzip.compress(text))
    return str(folder), records


@pytest.mark.parametrize("split", ["128m", "1000", "97"])
def test_lines_and_tiles(spark, files, split):
    folder, records = files
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        lines = readers.read_fasta_lines(spark, folder).cache()
        held = {}
        for r in sorted(lines.collect(), key=lambda r: (r.name, r.at, len(r.sequence))):
            assert len(held.setdefault(r.name, "")) == r.at and len(r.sequence) <= 200 and r.description == f"about {r.name} > x"
            held[r.name] += r.sequence
        assert held == {n: s.upper() for n, s in records.items()}
        assert {r.name: r.length for r in readers.fasta_index(lines).collect()} == {n: len(s) for n, s in records.items()}
        for size, overlap in ((64, 20), (4096, 255)):
            got = {(r.chr, r.tile): r.sequence for r in genome.tiles_of_lines(lines, size, overlap).collect()}
            whole = spark.createDataFrame([(n, s.upper()) for n, s in records.items()], "chr string, sequence string")
            assert got == {(r.chr, r.tile): r.sequence for r in genome.tile_genome(whole, size, overlap).collect()}
        lines.unpersist()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_line_longer_than_tiles(spark, tmp_path):
    seq = "".join(random.Random(1).choices("ACGT", k=5000))
    (tmp_path / "x.fa").write_text(f">x\n{seq[:1000]}\n{seq[1000:]}\n")
    got = {r.tile: r.sequence for r in genome.tiles_of_lines(readers.read_fasta_lines(spark, str(tmp_path)), 128, 300).collect()}
    assert got == {i: seq[i * 128 : i * 128 + 428] for i in range(-(-5000 // 128))}


def test_two_records_of_one_name(spark, tmp_path):
    for f in "ab":
        (tmp_path / f"{f}.fa").write_text(">x\nACGT\n")
    with pytest.raises(Exception, match="two records are named x"):
        genome.tiles_of_lines(readers.read_fasta_lines(spark, str(tmp_path))).collect()


@pytest.mark.parametrize("k", [5, 21, 60])
def test_counts_of_whole_chromosomes(spark, files, k):
    folder, records = files
    tiles = genome.tiles_of_lines(readers.read_fasta_lines(spark, folder), 128)
    got = {r.kmer: r.cnt for r in kmers.count_kmers(genome.tile_windows(tiles, k, 128), k, ci=1, cs=10**9, both_strands=False).collect()}
    want = Counter(s.upper()[i : i + k] for s in records.values() for i in range(len(s) - k + 1) if "N" not in s.upper()[i : i + k])
    assert got == dict(want)


def test_windows_by_codes_are_windows_by_strings(spark, files):
    folder, records = files
    tiles = genome.tiles_of_lines(readers.read_fasta_lines(spark, folder), 128)
    for k, unknown in ((9, 0), (12, 2)):
        rows = genome.genome_codes(tiles, k, 128, unknown).select("chr", "pos", F.coalesce("sequence", kmers.from_two_bit(F.col("code"), k)).alias("s"), "code").collect()
        want = {(n, i + 1, s.upper()[i : i + k]) for n, s in records.items() for i in range(len(s) - k + 1) if s.upper()[i : i + k].count("N") <= unknown}
        assert {(r.chr, r.pos, r.s) for r in rows} == want and len(rows) == len(want)
        assert all((r.code is None) == ("N" in r.s) for r in rows)


def test_block_compressed_reads_are_split(spark, tmp_path):
    """bzip2 is cut at its blocks, so one compressed file is many tasks' work, and records still number right."""
    import bz2

    rng = random.Random(11)
    rows = [(f"r{i}", "".join(rng.choices("ACGT", k=150)), "".join(rng.choices("!#@>IJ", k=150))) for i in range(9000)]
    (tmp_path / "x.fq.bz2").write_bytes(bz2.compress("".join(f"@{a}\n{b}\n+\n{c}\n" for a, b, c in rows).encode(), 1))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "150000")
    try:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 3
        assert sorted(map(tuple, readers.read_fastq(spark, str(tmp_path)).collect())) == sorted(rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
