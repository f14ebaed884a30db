"""Filter audit: the query against its SQL, odd rows, prefixes by brute force."""

import random
from collections import Counter
from itertools import combinations, permutations

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strandlake.llm import filter_audit as fa

D = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string, kind string, rid string, n string, fails string"
LABELS = "doc_id long, quality int, toxic int"


def from_sql(docs, labels):
    con = duckdb.connect()
    con.register("documents", docs)
    con.register("labels", labels)
    return con.sql(fa.SQL).df()


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(map(tuple, df.values.tolist()))


def test_query_equals_sql(spark):
    docs, labels = (pd.read_parquet(f"{D}/{t}.parquet") for t in ("documents", "labels"))
    assert rows(fa.op11_filter_audit(spark, D).toPandas()) == rows(from_sql(docs, labels))


def odd_rows():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)] + ["AB", "x#y", "Q"]
    texts = [" ".join(rng.choices(words, k=n)) for n in (0, 1, 150, 199, 200, 201, 350, 400, 900)] + ["a " * 220, "  \n\t ", None, "é" * 50 + "A"]
    docs = [(rng.choice([None, 1, 2, 3, 50, 51, 52, 53, 54, 2**63 - 1]), rng.choice(texts), rng.choice(["s", "s", "s", "t", "", None])) for _ in range(120)]
    docs += docs[:5]
    labels = [(1, 1, 0), (1, 0, 1), (2, 0, 0), (3, None, 1), (None, 1, 1), (50, 1, None), (50, 1, 0), (999, 1, 1)]
    return [(*d, "all", "0", "7", "A") for d in docs], labels


def test_odd_rows(spark):
    docs, labels = odd_rows()
    got = fa.audit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS), fa.text_filters(F.coalesce("text", F.lit(""))))
    whole = lambda values: pd.array(list(values), "Int64")
    frame = pd.DataFrame({"doc_id": whole(d[0] for d in docs), "text": [d[1] for d in docs], "source": [d[2] for d in docs]})
    want = from_sql(frame, pd.DataFrame({c: whole(x[k] for x in labels) for k, c in enumerate(("doc_id", "quality", "toxic"))}))
    assert rows(got.toPandas()) == rows(want)


def test_empty_tables(spark):
    docs, labels = odd_rows()
    filters = fa.text_filters(F.coalesce("text", F.lit("")))
    assert fa.audit(spark.createDataFrame([], DOCS), spark.createDataFrame(labels, LABELS), filters).count() == 0
    found = fa.audit(spark.createDataFrame(docs, DOCS), spark.createDataFrame([], LABELS), filters)
    assert found.count() == 120 * 5 * 3 and found.where("good_lost + toxic_lost > 0").count() == 0


def test_three_filters_by_brute_force(spark):
    rng = random.Random(5)
    texts = ["".join(c for c in "xyz" if rng.random() < 0.5) for _ in range(200)]
    docs = [(i, t, "p") for i, t in enumerate(texts)]
    filters = {c.upper(): F.contains("text", F.lit(c)) for c in "xyz"}
    found = fa.audit(spark.createDataFrame(docs, "doc_id long, text string, source string"), spark.createDataFrame([(i, 1, 0) for i in range(0, 200, 3)], LABELS), filters, repeats=None)
    got = {(r.filter_order, r.step): r for r in found.collect()}
    assert len(got) == 6 * 3
    for order in permutations("XYZ"):
        left = list(docs)
        for step, f in enumerate(order, 1):
            gone = [d for d in left if f.lower() in d[1]]
            left = [d for d in left if f.lower() not in d[1]]
            r = got["".join(order), step]
            assert (r.kept, r.removed, r.good_lost) == (len(left), len(gone), sum(d[0] % 3 == 0 for d in gone))
            assert r.redundant == sum(f.lower() in t for t in texts) - len(gone) and r.unique_fails == texts.count(f.lower())
    for f in "XYZ":
        assert {got[o, s].shapley for o, s in got if o[s - 1] == f} == {sum(got[o, s].removed for o, s in got if o[s - 1] == f)}


def test_prefixes_are_anti_joins(spark):
    """Each count equals a plain chain of left-anti joins."""
    ids = spark.range(60).select(F.col("id").alias("rid"), F.lit("p").alias("part"), F.lit("all").alias("kind"))
    rng = random.Random(6)
    fails = {f: set(rng.sample(range(60), 20)) for f in "ABC"}
    tables = {f: spark.createDataFrame([(x,) for x in x_], "rid long") for f, x_ in fails.items()}
    got = Counter({(r.filter, r.prefix): r.n for r in fa.prefixes(ids, tables).collect()})
    for n in range(4):
        for before in combinations("ABC", n):
            left = set(range(60)).difference(*(fails[f] for f in before))
            assert got["", "".join(before)] == len(left)
            for f in set("ABC") - set(before):
                assert got[f, "".join(before)] == len(left & fails[f])


def test_hot_and_cold_texts_agree(spark):
    docs = [(i, "same" if i % 3 else f"t{i % 40}", "p") for i in range(300)]
    rows_of = fa.measured(spark.createDataFrame(docs, "doc_id long, text string, source string"), {"A": F.lit(False)})
    found = [{r.rid for r in fa.repeating(rows_of, hot).collect()} for hot in (1, 3, 1000)]
    assert found[0] == found[1] == found[2] and len(found[0]) == 300 - len({d[1] for d in docs})


def test_names_of_filters(spark):
    with pytest.raises(ValueError):
        fa.audit(None, None, {"AB": F.lit(True)})
