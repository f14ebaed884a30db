"""Substring dedup: parts of any number give the same, what is sent grows with the text, odd ids."""

import hashlib
import random
from collections import Counter

import pytest

from strandlake.llm import substrings
from strandlake.llm.common import table

from .test_text_operators import docs_of, plain_substrings

D = "/root/testdata/sf0.001"


def rows(found):
    return Counter((r.doc_id, r.n_words, sum(x.end - x.start for x in r.removed), r.kept) for r in found.collect())


def test_query_on_the_whole_table(spark):
    docs = table(spark, D, "documents").select("doc_id", "text").collect()
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.op9_substrings(spark, D).collect())
    assert got == Counter((i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for (i, n, gone, kept), k in plain_substrings([tuple(r) for r in docs], 20).items() for _ in range(k))


@pytest.mark.parametrize("part_bytes", [1 << 30, 3000, 50])
def test_parts_change_nothing(spark, part_bytes):
    rng = random.Random(1)
    passages = [[f"w{rng.randrange(60)}" for _ in range(rng.randint(5, 45))] for _ in range(8)]
    texts = [(i, " ".join(w for _ in range(rng.randint(1, 5)) for w in rng.choice(passages))) for i in range(40)]
    # unlike texts under one id, many null ids, the greatest id, and repeats of rows
    texts += [(7, texts[11][1]), (7, texts[12][1]), *((None, t) for _, t in texts[:9]), (2**63 - 1, texts[3][1]), texts[5], texts[5], (99, None), (98, "")]
    found = substrings.repeated_passages(docs_of(spark, texts), 6, part_bytes)
    got = rows(found)
    assert sum(got.values()) == len(texts) and (2**63 - 1) in {i for i, *_ in got}
    assert got == plain_substrings(texts, 6)


def test_rows_sent_do_not_grow_with_the_parts(spark):
    """Each word sends at most one anchor and one window, into however many parts the text is dealt."""
    docs = table(spark, D, "documents")
    words = sum(r.n_words for r in substrings.op9_substrings(spark, D).collect())
    for n in (4, 64, 1024):
        from pyspark.sql import functions as F

        part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int")
        dealt = docs.select("doc_id", F.col("text").cast("binary").alias("text"), part.alias("part")).repartition("part")
        named = substrings.anchors_of(dealt, 20)
        sent = substrings.windows_of(dealt, substrings.shared_anchors(named), 20)
        assert named.count() < words / 4 and sent.count() <= words


def test_long_text(spark):
    text = " ".join(f"w{k % 5000}" for k in range(200_000))
    (r,) = substrings.repeated_passages(docs_of(spark, [(1, text)])).collect()
    assert r.n_words == 200_000 and r.kept == " ".join(f"w{k}" for k in range(5000))
