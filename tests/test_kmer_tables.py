"""Stored k-mer tables, expressions over many, several outputs of one, sketches, counting by minimizers."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strandlake.functions import codes
from strandlake.operators import kmers
from strandlake.operators.algebra import Kmers, evaluate, evaluate_all
from strandlake.sources import kmer_tables, readers, scratch
from strandlake.sources.kmer_tables import OtherSettings, Settings, counted_table


def rc(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def counted(rows, k, both):
    found = Counter()
    for s in rows:
        for i in range(len(s or "") - k + 1):
            x = s[i : i + k]
            if set(x) <= set("ACGT"):
                found[min(x, rc(x)) if both else x] += 1
    return found


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def odd_sequences():
    rng = random.Random(1)
    rows = ["".join(rng.choices("ACGTN", (30, 30, 30, 30, 0.3), k=n)) for n in (0, 1, 5, 40, 41, 300, 7, 12, 5000, 700)]
    return [*rows, None, "ACGTacgt" * 10, "ACG" * 500, "A" * 3000, *rows[5:9]]


@pytest.mark.parametrize("both", [True, False])
@pytest.mark.parametrize("k", [1, 10, 11, 25, 31, 32, 256])
def test_counts_of_any_k(spark, k, both):
    rows = odd_sequences()
    frame = spark.createDataFrame([(s,) for s in rows], "sequence string").repartition(3)
    want = dict(counted(rows, k, both))
    assert {r.kmer: r.cnt for r in kmers.count_kmers(frame, k, ci=1, cs=10**9, both_strands=both).collect()} == want
    if kmers.DENSE < k <= codes.MOST:  # with groups so small that most classes go by their codes
        assert {r.kmer: r.cnt for r in kmers._by_minimizers(frame, k, both, 100).collect()} == want


def test_runs_send_less_than_codes(spark):
    rng = random.Random(2)
    frame = spark.createDataFrame([("".join(rng.choices("ACGT", k=150)),) for _ in range(3000)], "sequence string")
    sizes = kmers._classes(frame, 25)
    assert int(sizes.sum()) == 3000 * 126 and (sizes > 0).sum() > 30_000  # minimizers spread over the classes
    groups = kmers.groups_of(sizes, 10_000)
    held = Counter()
    for c, g in enumerate(groups.tolist()):
        held[g] += int(sizes[c])
    assert held[-1] == 0 and max(held.values()) <= 10_000 and len(held) < 60
    size, n = kmers.runs_of(frame, 25, groups).agg(F.sum(F.length("runs")), F.count(F.lit(1))).first()
    print(f"{3000 * 126} windows: {size} bytes in {n} rows")
    assert size < 0.2 * 8 * 3000 * 126  # a code has 8 bytes


def test_a_repeat_in_every_read_is_no_task_of_its_own(spark):
    """One minimizer with most windows of all goes by codes, counted before they are shuffled."""
    rng = random.Random(3)
    rows = ["ACAG" * 40 + "".join(rng.choices("ACGT", k=40)) for _ in range(400)]
    frame = spark.createDataFrame([(s,) for s in rows], "sequence string")
    groups = kmers.groups_of(kmers._classes(frame, 21), 2000)
    assert (groups < 0).any() and kmers.runs_of(frame, 21, groups).agg(F.sum(F.length("runs"))).first()[0] < 0.35 * sum(map(len, rows))
    assert {r.kmer: r.cnt for r in kmers._by_minimizers(frame, 21, True, 2000).collect()} == dict(counted(rows, 21, True))


def test_codes_of_windows():
    import pyarrow as pa

    rows = odd_sequences()
    number = lambda s: int("".join(str("ACGT".index(x)) for x in s), 4)
    for k, m in ((1, 1), (7, 3), (16, 5), (31, 11)):
        minimizer = {}
        for chunk in (64, 1 << 19):
            got = []
            for w in codes.windows(*codes.flat(pa.array(["zz", *rows])[1:]), k, m, chunk):
                got += [(int(i), int(p), int(x) if ok else None, int(y) if ok else None) for i, p, x, y, ok in zip(w.row, w.at, w.code, w.turned, w.known, strict=True)]
                for x, y, least, ok in zip(w.code, w.turned, w.least, w.known, strict=True):
                    assert not ok or minimizer.setdefault(min(int(x), int(y)), int(least)) == int(least)
            ok = lambda s: set(s) <= set("ACGT")
            each = [(i, p, s[p : p + k]) for i, s in enumerate(rows) if s for p in range(len(s) - k + 1)]
            assert got == [(i, p, number(s) if ok(s) else None, number(rc(s)) if ok(s) else None) for i, p, s in each]
    whole = "".join(random.Random(4).choices("ACGT", k=300)).encode()
    import numpy as np

    starts, sizes = np.array([0, 3, 10, 100, 250]), np.array([1, 2, 3, 120, 50])
    parts, values = codes.pack(np.frombuffer(whole, np.uint8), starts, sizes, np.array([7, 3, 7, 3, 5]))
    assert parts.tolist() == [3, 5, 7]
    letters, ends = codes.unpack(pa.array(values)[1:])
    assert [letters[a:b].tobytes() for a, b in zip(ends, ends[1:])] == [whole[a : a + n] for a, n in ((250, 50), (0, 1), (10, 3))]
    assert codes.decoded(np.array([number("ACGTT"), 0]), 5).to_pylist() == ["ACGTT", "AAAAA"]


def tables(spark, n, seed=5):
    rng = random.Random(seed)
    held = [{"".join(rng.choices("ACGT", k=3)): rng.randint(1, 9) for _ in range(40)} for _ in range(n)]
    return held, [spark.createDataFrame(sorted(x.items()), "kmer string, cnt long") for x in held]


def test_expressions_equal_two_table_functions(spark):
    _, (a, b, c) = tables(spark, 3)
    held = {"a": a, "b": b, "c": c}
    x, y, z = Kmers("a"), Kmers("b"), Kmers("c")
    rows = lambda df: sorted((r.kmer, r.cnt) for r in df.collect())
    for mode in kmers.MODES:
        assert rows(evaluate(x.intersect(y, mode), held)) == rows(kmers.intersect(a, b, mode))
        assert rows(evaluate(x.union(y, mode), held)) == rows(kmers.union(a, b, mode))
    assert rows(evaluate(x - y, held)) == rows(kmers.subtract(a, b)) and rows(evaluate(y ^ x, held)) == rows(kmers.reverse_subtract_counts(a, b))
    deep = ((x * y) + (z - x)) ^ (Kmers("b", ci=3, cx=7) + z * x)
    want = kmers.subtract_counts(kmers.union(kmers.intersect(a, b), kmers.subtract(c, a)), kmers.union(kmers.reduce_counts(b, 3, 7), kmers.intersect(c, a)))
    assert rows(evaluate(deep, held)) == rows(want)
    several = evaluate_all({"p": x * y, "q": deep}, held).collect()
    assert sorted((r.kmer, r.cnt) for r in several if r.output == "q") == rows(want)
    chain = x
    for _ in range(30):  # steps are columns, so a long expression stays a short plan
        chain = chain + y
    assert rows(evaluate(chain, held))[0][1] > 0
    with pytest.raises(ValueError, match="no table"):
        evaluate(x * Kmers("d"), held)


def test_expression_over_n_tables_shuffles_once(spark):
    _, frames = tables(spark, 5)
    held = {f"t{i}": f for i, f in enumerate(frames)}
    expression = Kmers("t0")
    for i in range(1, 5):
        expression = (expression + Kmers(f"t{i}")) - (Kmers(f"t{i}") * Kmers("t0"))
    plan = plan_of(evaluate(expression, held))
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("Exchange") == 1, final


def test_stored_tables_join_without_exchange(spark, tmp_path):
    rng = random.Random(6)
    reads = [spark.createDataFrame([("".join(rng.choices("ACGT", k=200)),) for _ in range(50)], "sequence string") for _ in range(2)]
    a, b = (counted_table(r, str(tmp_path / n), Settings(k=6, ci=1), buckets=5) for n, r in zip("ab", reads, strict=True))
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for result in (kmers.intersect(a, b), kmers.union(a, b), kmers.subtract(a, b), kmers.subtract_counts(a, b), kmers.histogram(kmers.paired(a, b).select("kmer", F.col("a").alias("cnt")), 0).select("cnt").limit(0)):
            assert "Exchange hashpartitioning(kmer" not in plan_of(result)
        assert "Exchange" not in plan_of(kmers.union(a, b))
        scan = plan_of(kmers.reduce_counts(a, 3, 8))
        assert "PushedFilters: [IsNotNull(cnt), GreaterThanOrEqual(cnt,3), LessThanOrEqual(cnt,8)]" in scan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
    # a session that hasn't made the table learns of its buckets
    spark.sql(f"drop table {kmer_tables._name(str(tmp_path / 'a'))}")
    again = kmer_tables.open_kmer_table(spark, str(tmp_path / "a"))
    assert sorted(again.collect()) == sorted(kmers.count_kmers(reads[0], 6, ci=1).collect())
    assert "Exchange" not in plan_of(again.groupBy("kmer").agg(F.sum("cnt")))
    assert readers.read_kmer_table(spark, str(tmp_path / "a" / "kmers"), 2).count() == again.where("cnt >= 2").count()


def test_settings_are_kept(spark, tmp_path):
    path, reads = str(tmp_path / "t"), spark.createDataFrame([("ACGTACGTAC",)], "sequence string")
    first = counted_table(reads, path, Settings(k=4, ci=1), 2).collect()
    other = spark.createDataFrame([("GGGGGGG",)], "sequence string")
    assert sorted(counted_table(other, path, Settings(k=4, ci=1), 2).collect()) == sorted(first)
    for changed in (Settings(k=5, ci=1), Settings(k=4, ci=1, both_strands=False), Settings(k=4, ci=1, cs=3), Settings(k=4, ci=2), Settings(k=4, ci=1, compress=True)):
        with pytest.raises(OtherSettings):
            counted_table(other, path, changed, 2)
    assert [tuple(r) for r in counted_table(other, path, Settings(k=5, ci=1), 2, rebuild=True).collect()] == [("CCCCC", 3)]
    assert kmer_tables.settings_of(spark, path) == (Settings(k=5, ci=1), 2)
    assert [tuple(r) for r in counted_table(other, path, Settings(k=4, ci=1), 3, reuse=False).collect()] == [("CCCC", 4)]
    # unfinished: kmers without settings
    scratch.forget(spark, f"{path}/settings")
    assert kmer_tables.settings_of(spark, path) is None
    with pytest.raises(FileNotFoundError):
        kmer_tables.open_kmer_table(spark, path)
    assert counted_table(reads, path, Settings(k=4, ci=1), 2).count() == len(first)


def test_many_outputs_take_one_evaluation(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(it):
        for batch in it:
            seen.add(batch.num_rows)
            yield batch

    frame = spark.range(100).selectExpr("cast(id % 7 as string) kmer", "id cnt").mapInArrow(count, "kmer string, cnt long")
    paths = {str(tmp_path / n): (lambda x, p, low=low: kmers.reduce_counts(x, low).write.parquet(p)) for n, low in (("a", 10), ("b", 50), ("c", 90))}
    scratch.write_outputs(frame, paths)
    assert seen.value == 100 and [spark.read.parquet(p).count() for p in paths] == [90, 50, 10]
    with scratch.evaluated_once(frame) as shared:
        path = shared.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert shared.count() == shared.count() == 100
    import os

    assert seen.value == 200 and not os.path.exists(path)
    with pytest.raises(RuntimeError), scratch.evaluated_once(frame) as shared:
        path = shared.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        raise RuntimeError
    assert not os.path.exists(path)


@pytest.mark.parametrize("k", [15, 40])
def test_sketches(spark, tmp_path, k):
    rng = random.Random(k)
    shared = "".join(rng.choices("ACGT", k=20_000))
    rows = [(f, s) for f in "abc" for s in ("".join(rng.choices("ACGT", k=30_000)), shared, shared[:500] + "N" * 50)] + [("a", None)]
    frame = spark.createDataFrame(rows, "file string, sequence string")
    path = str(tmp_path / "sketches")
    kmers.kmer_sketches(frame, k, by=("file",)).write.parquet(path)
    kept = spark.read.parquet(path)
    for got, of in [({r.file: r.distinct_kmers for r in kmers.sketched_distinct(kept, ("file",)).collect()}, "abc"), ({"all": kmers.sketched_distinct(kept).first().distinct_kmers}, ["all"])]:
        for f in of:
            exact = len(counted([s for g, s in rows if f in (g, "all")], k, True))
            assert abs(got[f] - exact) < 0.05 * exact
