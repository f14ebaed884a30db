"""The benchmark index: skipping, global statistics, shards, short items, and the query against exhaustive BM25."""

import math
import random
from collections import Counter

import duckdb
import numpy as np

from strandlake.llm import decontaminate as dc

from .test_text_operators import docs_of

D = "/root/testdata/sf0.001"


def exhaustive(docs, items):
    """(doc_id, item_id, rounded score) by scoring every passage against every unit, then checking the overlaps."""
    units = [(i, w) for i, t in items for q, a in [dc.parts_of(t)] if len(q) + len(a) >= dc.LEAST for w in dc.units_of(q + a)]
    seen = Counter(w for _, u in units for w in set(u))
    mean = sum(len(u) for _, u in units) / len(units)

    def weights(u):
        idf = lambda w: math.log(1 + (len(units) - seen[w] + 0.5) / (seen[w] + 0.5))
        own = {w: idf(w) * f * (dc.K1 + 1) / (f + dc.K1 * (1 - dc.B + dc.B * len(u) / mean)) for w, f in Counter(u).items()}
        return {w: x / sum(own.values()) for w, x in own.items()}

    impacts, parts, out = [(i, weights(u)) for i, u in units], {i: dc.parts_of(t) for i, t in items}, []
    for doc, text in docs:
        words, best, spans = dc.words_of(text), {}, {}
        for at in range(0, max(1, len(words) - dc.LENGTH + dc.STRIDE), dc.STRIDE):
            own = set(words[at : at + dc.LENGTH])
            for i, weight in impacts:
                score = sum(x for w, x in weight.items() if w in own)
                if score >= dc.THRESHOLD - 1e-9:
                    best[i] = max(score, best.get(i, 0))
                    spans.setdefault(i, []).append(at)
        for i, score in best.items():
            q, a = parts[i]
            size = len(q) + len(a)
            near = words[max(0, min(spans[i]) - size) : max(spans[i]) + dc.LENGTH + size]
            if dc.overlap(q, near) >= dc.VERIFY and dc.overlap(a, near) >= dc.VERIFY:
                out.append((doc, i, round(score, 5)))
    return sorted(out)


def test_query_is_exhaustive_search(spark):
    docs = duckdb.sql(f"select doc_id, text from '{D}/documents.parquet'").fetchall()
    items = duckdb.sql(f"select item_id, text from '{D}/benchmark.parquet'").fetchall()
    got = sorted((r.doc_id, r.item_id, round(r.score, 5)) for r in dc.op7_decontaminate(spark, D).collect())
    assert got and got == exhaustive(docs, items)


def texts(seed, n_items=120, n_docs=60):
    rng = random.Random(seed)
    text = lambda n: " ".join(f"w{int(rng.paretovariate(0.6)) % 3000}" for _ in range(n))
    items = [(k, f"{text(rng.randint(12, 200))}. {text(8)}") for k in range(n_items)]
    docs = [(k, text(rng.randint(0, 900))) for k in range(n_docs)]
    # parts of items, so that some score near the threshold
    docs += [(1000 + k, f"{text(60)} {' '.join(w for w in t.split() if rng.random() < 0.9)} {text(60)}") for k, t in items[:50]]
    return items, docs


def test_shards_change_nothing(spark):
    items, docs = texts(5)
    bench, df = spark.createDataFrame(items, "item_id long, text string"), docs_of(spark, docs + docs[:3] + [(7000, None), (7001, "")])
    rows = lambda shard: sorted(map(tuple, dc.contaminated(df, bench, shard=shard).collect()))
    whole = rows(20_000)
    assert len(whole) > 20 and rows(50) == whole
    assert sorted({(i, j, round(s, 5)) for i, j, s, _, _ in whole}) == exhaustive(docs, items)
    kept = [sorted(r.doc_id for r in dc.drop_contaminated(df, bench, shard=s).collect()) for s in (20_000, 50)]
    assert kept[0] == kept[1] == sorted(r.doc_id for r in df.collect() if r.doc_id not in {x[0] for x in whole})


def test_wand_skips_postings():
    """On the given documents fewer than one posting in a hundred of the passages' words is scored."""
    docs = duckdb.sql("select text from '/root/testdata/sf0.01/documents.parquet'").fetchall()
    index = dc.Index(duckdb.sql("select item_id, text from '/root/testdata/sf0.01/benchmark.parquet'").fetchall())
    found, all_postings = 0, 0
    for (t,) in docs:
        ids = np.array([index.word.get(w, -1) for w in dc.words_of(t)], np.int64)
        for at in range(0, max(1, len(ids) - dc.LENGTH + dc.STRIDE), dc.STRIDE):
            own = np.unique(ids[at : at + dc.LENGTH])
            own = own[own >= 0]
            all_postings += int((index.post_at[own + 1] - index.post_at[own]).sum())
        found += len(index.search(t))
    assert found and 0 < index.read < all_postings / 100


def test_short_items_and_far_parts(spark):
    bench = spark.createDataFrame([(1, "the"), (2, "the cat sat"), (3, "alpha beta gamma delta epsilon zeta eta theta. Iota kappa lambda."), (3, "alpha beta gamma delta epsilon zeta eta theta. Iota kappa lambda.")], "item_id long, text string")
    assert sorted(map(tuple, dc.short_items(bench).collect())) == [(1, 1), (2, 3)]
    filler = " ".join(f"x{k}" for k in range(600))
    docs = docs_of(spark, [(1, "the cat sat"), (2, f"{filler} alpha beta gamma delta epsilon zeta eta theta iota kappa lambda {filler}"), (3, f"alpha beta gamma delta epsilon zeta eta theta {filler} iota kappa lambda")])
    assert [(r.doc_id, r.item_id) for r in dc.contaminated(docs, bench).collect()] == [(2, 3)]
    assert {r.doc_id for r in dc.drop_contaminated(docs, bench).collect()} == {1, 3}


def test_short_items_are_not_collected(spark):
    items = [(k, f"w{k} x y") for k in range(3000)] + [(5000 + k, " ".join(f"u{k}v{i}" for i in range(30))) for k in range(40)] + [(9000, " ".join(f"long{i}" for i in range(20_000)))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    n, indexes = dc._indexes(bench, 100)
    held = [len(x.items) for x in indexes]
    # 40 units and 313 of the long item: by units there are several shards, and the long item is in one
    assert n == 6 and sum(held) == 41
    assert dc.short_items(bench).count() == 3000
    n, indexes = dc._indexes(bench.where("item_id < 5000"), 100)
    assert [len(x.items) for x in indexes] == [0]
    docs = docs_of(spark, [(1, items[3000][1]), (2, items[0][1]), (3, items[-1][1])])
    assert sorted((r.doc_id, r.item_id) for r in dc.contaminated(docs, bench, shard=100).collect()) == [(1, 5000), (3, 9000)]
