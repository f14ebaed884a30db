"""What op2, op4 and op6 return for a whole table, column by column, against plain Python."""

import hashlib
import math
import re

import xxhash

from strandlake.llm import pii, quality_rules, simhash
from strandlake.llm.common import table

from .test_text_operators import WORD, base_pii, luhn, plain_counts, plain_fingerprint

D = "/root/testdata/sf0.001"


def texts_of(spark):
    return {r.doc_id: r.text for r in table(spark, D, "documents").select("doc_id", "text").collect()}


def ibans(t):
    lengths = {c: n for n, names in pii.IBAN_LENGTHS.items() for c in names.split()}
    out, at = [], 0
    while m := re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}").search(t, at):
        n, code, k = lengths.get(m[0][:2], 0), m[0], m.end()
        while len(code) < n and (x := re.compile(r"\x20?([A-Z0-9])").match(t, k)):
            code, k = code + x[1], x.end()
        at = m.start() + 1
        if n and len(code) == n and not re.compile("[A-Za-z0-9]").match(t, k):
            at = k
            if int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1:
                out.append((m.start(), k))
    return out


def accounts(t):
    out = []
    for m in re.finditer(r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9])*", t):
        number = re.sub("[^0-9]", "", m[0])
        near = (t[max(0, m.start() - 48) : m.start()] + " | " + t[m.end() : m.end() + 48]).lower()
        if 13 <= len(number) <= 15 and luhn(number) and re.search(r"(?<!\w)(?:%s)(?!\w)" % pii.CONTEXT["account"], near):
            out.append(m.span())
    return out


def test_op2(spark):
    texts = texts_of(spark)
    rows = pii.op2_pii(spark, D).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        t = texts[r.doc_id] or ""
        base = base_pii(t)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(x) for x in base]
        flat = [x for kind in base for x in kind]
        assert r.base_sha256 == hashlib.sha256(",".join(flat).encode()).hexdigest()
        added = [f"{kind}:{a}:{b}" for kind, found in (("iban", ibans(t)), ("account", accounts(t))) for a, b in found]
        assert r.spans == ",".join(flat + added)
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows) > 0


def test_op4(spark):
    texts = texts_of(spark)
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in prints:
        for j in prints:
            if i < j and (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op4_simhash(spark, D).collect()}
    assert got == {i: (f"{prints[i]:016x}", find(i)) for i in texts}
    assert len({find(i) for i in texts}) < len(texts)


def test_op6(spark):
    texts, n = texts_of(spark), quality_rules.BUCKETS
    words = {i: WORD.findall(t or "") for i, t in texts.items()}
    one = lambda w, seed=42: xxhash.xxh64_intdigest(w.encode(), seed)
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    grams = {i: [signed(one(x)) % n for x in w] + [signed(one(b, one(a))) % n for a, b in zip(w, w[1:], strict=False)] for i, w in words.items()}

    def trusted(i):
        w, t = words[i], texts[i] or ""
        return len(w) >= 50 and len(t) < 9 * len(w) and not any(s in t for s in quality_rules.SYMBOLS) and len(set(w)) > min(0.3 * len(w), 150)

    raw, good = [0] * n, [0] * n
    for i, g in grams.items():
        for b in g:
            raw[b] += 1
            good[b] += trusted(i)
    of = lambda counts, b: math.log((counts[b] + 1) / (sum_of[id(counts)] + n))
    sum_of = {id(raw): sum(raw), id(good): sum(good)}
    rows = quality_rules.op6_quality_rules(spark, D).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_counts(texts[r.doc_id])
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        g = grams[r.doc_id]
        mark = sum(of(good, b) - of(raw, b) for b in g) / len(g) if g else 0.0
        assert r.base_failed == failed and abs(r.mark - mark) < 1e-6
        assert abs(mark - quality_rules.LEAST) < 1e-6 or r.kept == (not failed and mark >= quality_rules.LEAST)
    assert {r.kept for r in rows} == {True, False}
