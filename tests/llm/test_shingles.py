"""Near-duplicates of the pipeline against measured similarities."""

import itertools
import math
import random
from collections import Counter

import pytest
import xxhash

import corpus_pipeline
from strandlake.llm import shingles, simhash
from strandlake.llm.common import table

from .test_text_operators import WORD, docs_of


def plain_set(t):
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(t or "")]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_heads(texts):
    """doc_ids that stay where all pairs are measured."""
    sets, group = [plain_set(t) for _, t in texts], list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if group[i] != group[j] and (a == b or len(a & b) >= 0.8 * len(a | b)):
                group = [group[j] if g == group[i] else g for g in group]
    return {min(texts[i][0] for i in range(len(texts)) if group[i] == g) for g in set(group)}


def changed(words, n, rng):
    words = list(words)
    for at in rng.sample(range(len(words)), n):
        words[at] = f"new{rng.randint(0, 10**9)}"
    return words


def near_texts():
    """Copies with a few words changed, on both sides of the limit, and chains of them."""
    rng = random.Random(4)
    texts = []
    for _ in range(12):
        words = [f"w{rng.randint(0, 3000)}" for _ in range(rng.randint(60, 300))]
        texts += [words, changed(words, len(words) // 50, rng), changed(words, len(words) // 15, rng)]
        for _ in range(4):
            words = changed(words, max(1, len(words) // 70), rng)
            texts.append(words)
    texts = [" ".join(t) for t in texts] + ["", None, " \n", "A b", "a  B", "one two three four five six"]
    rng.shuffle(texts)
    return list(enumerate(texts))


def plain_prints(text):
    """Word fingerprints, one vote at a time."""
    counts = Counter(w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text or ""))
    out = []
    for salt in map(int, shingles._SALTS):
        bits = 0
        hashes = {}
        for w in counts:
            h = ((xxhash.xxh64_intdigest(w.encode()) ^ salt) * 0xBF58476D1CE4E5B9) % 2**64
            h = ((h ^ (h >> 29)) * 0x94D049BB133111EB) % 2**64
            hashes[w] = h ^ (h >> 32)
        for bit in range(64):
            vote = sum(round(1024 * math.sqrt(c)) for w, c in counts.items() if hashes[w] >> bit & 1)
            bits |= (2 * vote > sum(round(1024 * math.sqrt(c)) for c in counts.values())) << bit
        out.append(bits)
    return out


def near(p, q):
    return min((a ^ b).bit_count() for a, b in zip(p, q, strict=True)) <= simhash.RADIUS


def plain_kept(texts):
    """doc_ids that stay where all pairs within the radius of a fingerprint are measured."""
    sets, prints, group = [plain_set(t) for _, t in texts], [plain_prints(t) for _, t in texts], list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if group[i] != group[j] and (a == b or (len(a & b) >= 0.8 * len(a | b) and near(prints[i], prints[j]))):
                group = [group[j] if g == group[i] else g for g in group]
    return {min(texts[i][0] for i in range(len(texts)) if group[i] == g) for g in set(group)}


@pytest.mark.parametrize("cell", [64, 2])
def test_links_are_measured_candidates(spark, cell):
    texts = near_texts()
    kept = shingles.keep_first(docs_of(spark, [*texts, (None, "A b")]), cell=cell)
    assert kept.columns == docs_of(spark, []).columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(None) == 1 and sorted(i for i in ids if i is not None) == sorted(plain_kept(texts))
    # of the documents that any measured link would drop, at least nine in ten go
    drops = len(texts) - len(plain_heads(texts))
    assert len(texts) - len(set(ids) - {None}) >= 0.9 * drops


def test_large_bucket_of_unlike_members_is_measured_whole(spark):
    """Many texts within the radius of each other, of which few are alike: sweeps find nothing and blocks take over."""
    rng = random.Random(7)
    base = [f"w{k}" for k in range(400)]
    texts = []
    for _ in range(24):
        words = base[:]
        rng.shuffle(words)  # the same words in another order: equal fingerprints, no run in common
        texts.append(words)
    texts += [changed(texts[3], 2, rng), changed(texts[9], 2, rng)]
    texts = [(i, " ".join(t)) for i, t in enumerate(texts)]
    kept = {r.doc_id for r in shingles.keep_first(docs_of(spark, texts), cell=4).collect()}
    assert kept == set(range(24)) == plain_kept(texts)


def test_recall_of_similar_pairs():
    """Nine in ten or more of the pairs at 0.8 share a table, on the given documents."""
    import duckdb

    texts = [r[0] for r in duckdb.sql("select distinct text from '/root/testdata/sf0.1/documents.parquet' where text is not null order by text").fetchall()]
    sets, holders = [shingles.shingles(t) for t in texts], {}
    for i, s in enumerate(sets):
        for h in s[: len(s) - math.ceil(0.8 * len(s)) + 1].tolist():  # two sets at 0.8 share one of these
            holders.setdefault(h, []).append(i)
    pairs = {p for v in holders.values() for p in itertools.combinations(v, 2) if 0.8 <= len(sets[p[0]]) / len(sets[p[1]]) <= 1.25}
    pairs = [p for p in pairs if 0.8 <= shingles.similarity(sets[p[0]], sets[p[1]]) < 1]
    prints = {i: list(map(int, shingles.word_prints(texts[i]))) for p in pairs for i in p}
    caught = sum(near(prints[i], prints[j]) for i, j in pairs)
    print(f"{caught} of {len(pairs)} pairs")
    assert len(pairs) > 40 and caught >= 0.9 * len(pairs)


def test_shared_ids_clashing_columns_and_repeats(spark):
    long = " ".join(f"w{k}" for k in range(100))
    rows = [(1, long, 0, "x"), (1, "quite another text of seven words", 5, "y"), (1, long, 0, "x"), (2, long + " more", 1, "z"), (3, None, 2, "n"), (4, " ", 2, "m")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node int, h string")
    kept = shingles.keep_first(docs).collect()
    assert sorted((r.doc_id, r.h) for r in kept) == [(1, "x"), (1, "y"), (3, "n")]
    assert sorted((r.doc_id, r.h) for r in simhash.keep_first(docs).collect()) in ([(1, "x"), (1, "y"), (3, "n")], [(1, "x"), (1, "y"), (2, "z"), (3, "n")])


def test_pipeline_stage_measures_similarity(spark):
    d = "/root/testdata/sf0.001"
    docs = table(spark, d, "documents")
    kept = corpus_pipeline.near_duplicates(spark, docs, d)
    assert {r.doc_id for r in kept.collect()} == plain_heads([(r.doc_id, r.text) for r in docs.collect()])


def test_empty_table(spark):
    assert shingles.keep_first(docs_of(spark, [])).count() == 0


def test_hooked_links_connect_the_same(spark):
    rng = random.Random(12)
    links = [(j, *sorted(rng.sample(range(60), 2))) for j in range(2) for _ in range(50)] + [(0, 3, x) for x in range(100, 160)] + [(0, 4, x) for x in range(100, 160)]

    def classes(found):
        root = {}

        def find(x):
            while root.setdefault(x, x) != x:
                x = root[x]
            return x

        for j, a, b in found:
            root[find((j, b))] = find((j, a))
        groups = {}
        for x in list(root):
            groups.setdefault(find(x), set()).add(x)
        return sorted(map(sorted, groups.values()))

    frame = spark.createDataFrame([(j, b, a) if (a + b) % 2 else (j, a, b) for j, a, b in links], "j int, a long, b long")
    got = [(r.j, r.a, r.b) for r in simhash.hooked(frame, ("j",)).collect()]
    assert classes(got) == classes(links) and all(a < b for _, a, b in got) and len(got) == len(set(got)) < len(links) - 40
