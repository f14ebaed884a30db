"""Random tokens planted at three rates: recall and false discoveries by class of lengths; the query's base spans."""

import base64
import hashlib
import random
from collections import Counter

import pytest

from strandlake.llm import secrets

from .test_text_operators import base_secrets, docs_of

D = "/root/testdata/sf0.001"


def planted(rate, n=4000):
    """Texts with long plain tokens all over, and random keys in a share of them: their places by text."""
    rng = random.Random(int(rate * 1000))
    letters = "etaoinshrdlu" * 6 + "cmfwypvbgkjqxz"
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(2, 9)))
    texts, keys = [], {}
    for i in range(n):
        words = [word() for _ in range(30)]
        for _ in range(2):  # names and paths, of which some have digits and capitals
            words.insert(rng.randrange(30), rng.choice(["_", "-", "/"]).join(word() for _ in range(rng.randint(4, 8))) + rng.choice(["", "2024", "V1"]))
        if i < rate * n:
            raw = bytes(rng.randrange(256) for _ in range(rng.choice([18, 24, 33, 48])))
            token = rng.choice([base64.b64encode(raw).decode().rstrip("="), base64.b32encode(raw).decode().rstrip("=")])
            at = rng.randrange(30)
            start = len(" ".join(words[:at])) + (at > 0)
            words.insert(at, token)
            keys[i] = (start, start + len(token))
        texts.append((i, " ".join(words)))
    return texts, keys


@pytest.mark.parametrize(("rate", "recall"), [(0.001, 0.0), (0.01, 0.5), (0.1, 0.7)])
def test_planted_keys(spark, rate, recall):
    texts, keys = planted(rate)
    _, spans = secrets.secret_spans(docs_of(spark, texts))
    got = {(r[0], s.start, s.end) for r in docs_of(spark, texts).select("doc_id", spans).collect() for s in r[1] if s.kind == "random"}
    true = {(i, a, b) for i, (a, b) in keys.items()}
    by_class = {c: (sum(sum(b - a >= x for x in secrets.CLASSES) - 1 == c for _, a, b in got & true), sum(sum(b - a >= x for x in secrets.CLASSES) - 1 == c for _, a, b in true)) for c in range(4)}
    print(f"rate {rate}: recall {len(got & true)} of {len(true)}, false {len(got - true)} of {len(got)}, by class {by_class}")
    assert len(got & true) >= recall * len(true)
    assert len(got - true) <= 0.2 * len(got) + 1


def test_query_base_spans(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{D}/documents.parquet").collect()}
    for r in secrets.op10_secrets(spark, D).collect():
        base = base_secrets(texts[r.doc_id])
        count = Counter(x.split(":")[0] for x in base)
        assert (r.n_assign, r.n_access, r.n_hex) == (count["assign"], count["access"], count["hex"])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest() and set(base) <= set(r.spans.split(","))
