"""Golden feature values and edge cases."""

import pytest
from pyspark.sql import functions as F

from strandlake.functions import sequence as fs
from strandlake.streaming.features import stream_features

GOLDEN = {"GCGT": (0.75, 0.25, 1, 0.25, 1, 0.25, 1, 1), "TTAA": (0.0, 1.0, 2, 0.5, 0, 0.0, 2, 4), "": (0.0, 0.0, 0, 0.0, 0, 0.0, 0, 0), "gcNN": (0.0, 0.0, 0, 0.0, 0, 0.0, 0, 0)}


def test_golden_features(spark):
    df = spark.createDataFrame([(s,) for s in GOLDEN], "sequence string")
    got = {r[0]: tuple(r[1:]) for r in df.select("sequence", *fs.feature_columns(F.col("sequence"))).collect()}
    assert got == GOLDEN


def test_null_counts_as_empty_and_unknown_names_fail(spark):
    df = spark.createDataFrame([(None,)], "sequence string")
    assert tuple(df.select(*fs.feature_columns(F.col("sequence"))).first()) == GOLDEN[""]
    with pytest.raises(ValueError):
        fs.feature_columns(F.col("sequence"), ["GC"])


@pytest.mark.parametrize(("n", "ends"), [(1, "S00001"), (100, "S00100"), (1000, "S01000"), (999999, "S999999"), (1000000, "S1000000")])
def test_site_ids(spark, n, ends):
    row = spark.range(1).select(fs.site_id(F.lit("X"), F.lit("my gene"), "Exon", F.lit(n))).first()
    assert row[0] == f"X-my_gene-Exon-{ends}"


def test_turning_twice_is_nothing(spark):
    df = spark.createDataFrame([("ATCGATCGATCGATCG",), ("ACGTURYSWKMBDHVN",)], "s string")
    for r in df.select("s", fs.reverse_complement(F.col("s")).alias("r"), fs.reverse_complement(fs.reverse_complement(F.col("s"))).alias("b")).collect():
        assert r.b.replace("T", "U") == r.s.replace("T", "U")


def test_two_bit_mismatches(spark):
    df = spark.createDataFrame([("ACGTACGT", "ACGTACGT"), ("AAAAAAAA", "TTTTTTTT"), ("ACGTACGT", "TCGTACGA")], "a string, b string")
    got = df.select(fs.two_bit_mismatches(fs.two_bit(F.col("a")), fs.two_bit(F.col("b"))), fs.mismatches(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(0, 0), (8, 8), (2, 2)]


def test_features_on_a_stream(spark, tmp_path):
    spark.createDataFrame([("GCGT",)], "sequence string").write.parquet(str(tmp_path / "in"))
    out = stream_features(spark.readStream.schema("sequence string").parquet(str(tmp_path / "in")), ["GC_content"])
    run = out.writeStream.format("memory").queryName("features").trigger(availableNow=True).start()
    run.awaitTermination(60)
    assert spark.table("features").first().GC_content == 0.75
