"""Substring dedup: Rabin-Karp hashes of every window of 20 words, counted in Spark.

Words get 64-bit hashes; a window's Rabin-Karp hash is the polynomial of its word hashes in BASE modulo 2^64. A word goes
if some window over it has the same words as a window that starts earlier (smaller doc_id, or the same document and
an earlier start); adjacent windows that go merge into maximal intervals. Windows are equal if their hashes are.

The rows are dealt once, by a hash of the row, to parts of about PART_BYTES of text, and three passes go over the parts.
Between them Spark counts plain rows by hash, so what is sent grows with the text and not with the number of parts, and
sorts spill:
  1. each part names the least hash of 5 words inside each of its windows, each once (a minimizer: equal windows have
     equal ones, and about one place in eight is named); Spark finds those that several parts name;
  2. each part sends its windows that hold such a minimizer, each distinct one once with its first place, so a passage
     that stands in a third of all documents is one row per part; Spark finds the first place of each over all parts and
     tells the parts whose first place is a later one;
  3. each part removes words by the windows told and by repeats within the part.

Null and empty texts have no words; a text of any length is one row's work. A null doc_id counts as the last of all. Rows
that share doc_id and start are the same place, so a repeated row removes nothing from its twin, and rows that share a
doc_id but not the text are judged by their own windows. An empty table gives an empty result. Other columns are ignored,
whatever their names; doc_id is an integer.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

WINDOW = 20
GRAM = 5
BASE = 0x9E3779B97F4A7C15 | 1
#: Text in a part: what a task holds at once, with some 15 times as much in words and hashes.
PART_BYTES = 4 << 20
_LAST = np.iinfo(np.int64).max


class _WordHashes(dict):
    """Hashes of words seen lately."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_HASHES = _WordHashes()


def polynomial(h: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hash of each run of `width` entries, by doubling: a run of a + b is a run of a and one of b."""
    done, left, shift, out = 0, width, 1, None
    run, run_base = h, BASE
    while left:
        if left & 1:
            out = run.copy() if out is None else out[: len(run) - done if len(run) > done else 0] * np.uint64(run_base) + run[done:]
            done += shift
        left >>= 1
        if left:
            run = run[: max(len(run) - shift, 0)] * np.uint64(run_base) + run[shift:]
            run_base = run_base * run_base % (1 << 64)
            shift *= 2
    n = max(len(h) - width + 1, 0)
    return out[:n]


class Part:
    """The rows of a part by doc_id, their words one after another, and all their windows."""

    def __init__(self, rows: pa.Table, window: int):
        given = rows.column("doc_id").combine_chunks()
        ids = given.fill_null(_LAST).to_numpy(zero_copy_only=False)
        order = np.argsort(ids, kind="stable")
        texts = rows.column("text").to_pylist()
        self.ids, self.given = ids[order], given.take(pa.array(order))
        self.words = [(texts[k] or b"").split() for k in order]
        self.sizes = np.fromiter(map(len, self.words), np.int64, len(self.words))
        self.first = np.concatenate(([0], np.cumsum(self.sizes)))
        n = int(self.first[-1])
        h = np.fromiter(map(_HASHES.__getitem__, chain.from_iterable(self.words)), np.uint64, n)
        doc = np.repeat(np.arange(len(ids)), self.sizes)
        inside = np.arange(max(n - window + 1, 0))
        inside = inside[doc[inside] == doc[inside + window - 1]] if len(inside) else inside
        self.hash = polynomial(h, window)[inside]
        self.doc = doc[inside]
        self.start = inside - self.first[self.doc]
        gram = min(GRAM, window)
        least = polynomial(h, gram)
        left, step = window - gram, 1
        while left:  # least of ever more neighbours, up to all grams of a window
            step = min(step, left)
            least = np.minimum(least[: len(least) - step], least[step:]) if len(least) > step else least[:0]
            left -= step
            step *= 2
        self.anchor = least[inside]

    def firsts(self) -> tuple[np.ndarray, np.ndarray]:
        """Windows that are the first of their hash in this part, and those with an earlier equal (places may tie)."""
        key = self.ids[self.doc]
        # windows stand in order of their places, but for rows that share an id
        shared = bool((self.ids[1:] == self.ids[:-1]).any())
        order = np.lexsort((self.start, key, self.hash)) if shared else np.argsort(self.hash, kind="stable")
        h, d, s = self.hash[order], key[order], self.start[order]
        new = np.concatenate(([True], h[1:] != h[:-1]))[: len(h)]
        head = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0)) if len(h) else np.zeros(0, int)
        later = (d != d[head]) | (s != s[head])
        return order[new], order[later]


_ANCHORS = pa.schema([("h", pa.int64()), ("part", pa.int32())])
_WINDOWS = pa.schema([("h", pa.int64()), ("part", pa.int32()), ("id", pa.int64()), ("start", pa.int32())])


def _told(rows: pa.Table) -> np.ndarray:
    return rows.column("h").to_numpy().view(np.uint64)


def parts_of(docs: DataFrame, size: int = PART_BYTES) -> int:
    """How many parts the texts make."""
    return max(1, -(-(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // size))


def anchors_of(dealt: DataFrame, window: int) -> DataFrame:
    """(h, part): the minimizers of each part, each once."""

    def name(key: tuple, rows: pa.Table) -> pa.Table:
        found = np.unique(Part(rows, window).anchor)
        return pa.table([found.view(np.int64), np.full(len(found), key[0].as_py(), np.int32)], schema=_ANCHORS)

    return dealt.groupBy("part").applyInArrow(name, "h long, part int")


def shared_anchors(named: DataFrame) -> DataFrame:
    """Those of (h, part) that several parts name; each part names an h once, so no h has more rows than there are parts."""
    same = Window.partitionBy("h")
    return named.withColumn("lo", F.min("part").over(same)).withColumn("hi", F.max("part").over(same)).where("lo < hi").select("h", "part")


def windows_of(dealt: DataFrame, shared: DataFrame, window: int) -> DataFrame:
    """(h, part, id, start): each distinct window of a part that holds a shared minimizer, at its first place there."""

    def send(key: tuple, rows: pa.Table, told: pa.Table) -> pa.Table:
        if not rows.num_rows or not told.num_rows:
            return _WINDOWS.empty_table()
        own = Part(rows, window)
        first, _ = own.firsts()
        first = first[np.isin(own.anchor[first], _told(told))]
        columns = [own.hash[first].view(np.int64), np.full(len(first), key[0].as_py(), np.int32), own.ids[own.doc[first]], own.start[first].astype(np.int32)]
        return pa.table(columns, schema=_WINDOWS)

    return dealt.groupBy("part").cogroup(shared.groupBy("part")).applyInArrow(send, "h long, part int, id long, start int")


def later_windows(sent: DataFrame) -> DataFrame:
    """(h, part) where the part's first place of a window isn't the first of all."""
    place = F.struct("id", "start")
    return sent.withColumn("first", F.min(place).over(Window.partitionBy("h"))).where(F.col("first") < place).select("h", "part")


def repeated_passages(docs: DataFrame, window: int = WINDOW, part_bytes: int = PART_BYTES) -> DataFrame:
    """doc_id, n_words, removed (array of word intervals, end exclusive) and kept (the other words) of every row."""
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts_of(docs, part_bytes))).cast("int")
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), part.alias("part")).repartition("part")
    result = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("kept", pa.string())])

    def remove(rows: pa.Table, told: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return result.empty_table()
        own = Part(rows, window)
        gone = np.zeros(int(own.first[-1]) + 1, np.int64)  # windows to remove, by their first word
        later = own.firsts()[1]
        gone[own.first[own.doc[later]] + own.start[later]] = 1
        if told.num_rows:  # all places of a window that began elsewhere
            later = np.flatnonzero(np.isin(own.hash, _told(told)))
            gone[own.first[own.doc[later]] + own.start[later]] = 1
        total = np.concatenate((np.zeros(window, np.int64), np.cumsum(gone[:-1])))
        covered = total[window:] - total[:-window] > 0
        spans, kept = [], []
        for k, words in enumerate(own.words):
            mark = covered[own.first[k] : own.first[k + 1]]
            edges = np.flatnonzero(np.diff(np.concatenate(([False], mark, [False])).astype(np.int8))) if mark.any() else np.zeros(0, np.int64)
            spans.append([{"start": i, "end": j} for i, j in edges.reshape(-1, 2).tolist()])
            kept.append(b" ".join([w for w, m in zip(words, mark.tolist(), strict=True) if not m] if len(edges) else words).decode())
        return pa.table([own.given, own.sizes, pa.array(spans, result.field("removed").type), kept], schema=result)

    shared = shared_anchors(anchors_of(dealt, window))
    told = later_windows(windows_of(dealt, shared, window))
    return dealt.groupBy("part").cogroup(told.groupBy("part")).applyInArrow(remove, "doc_id long, n_words long, removed array<struct<start:int,end:int>>, kept string")


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_passages(table(spark, sf_dir, "documents"))
    gone = F.aggregate("removed", F.lit(0), lambda acc, x: acc + x["end"] - x["start"]).cast("long")
    return found.select("doc_id", "n_words", gone.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"), F.size("removed").alias("n_intervals"))
