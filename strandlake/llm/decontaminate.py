"""Benchmark decontamination: a BM25 inverted index of test items, block-max WAND, then a check of both parts.

Items are cut into units of at most UNIT words; the index maps a word to its units (a posting list in blocks of BLOCK
unit numbers, each with its greatest impact). An impact is the word's BM25 weight in the unit over the unit's score for
itself, so a passage that has all of a unit's words scores 1. Document frequencies, the number of units and their mean
length are counted in Spark over the whole benchmark, so scores don't depend on how the index is dealt. Every training
passage (LENGTH words, a new one each STRIDE, to the end of the text) is a query:
  0. block maxima, summed for all strides of a text at once, rule out passages that reach the threshold in no block;
  1. words whose greatest impacts together stay below the threshold lift no unit there alone, so only blocks that hold
     another word of the passage can have a pivot;
  2. of those, blocks whose summed block maxima stay below the threshold are passed over, their postings unread;
  3. in the others WAND runs: cursors in order of their units, the pivot is the first unit up to which the maxima of the
     cursors reach the threshold, cursors before it skip to it, and it is scored once they all stand on it.
All units at or above the threshold are retrieved; nothing is cut off at a number.

A retrieved item is reported if its question and its answer (its last sentence; items of one sentence are all question)
each overlap the passages where it was found (and as many words on either side as the item has): at least VERIFY of their
word trigrams (of the whole part where it is shorter) occur there. Items of fewer than LEAST words can't be told from
common phrases; they stay out of the index, and short_items names them.

The index is dealt into shards of about SHARD units by a hash of the item, after short items have gone and by units, not by
items; one shard at a time is broadcast, searched with and let go, so what driver and executors hold has a bound: SHARD
units of UNIT words and the longest item. One shard (the usual case) needs one lazy pass.

Words are lower-cased; ASCII punctuation separates. Null and empty texts and items yield nothing; texts of any length are
read whole. Equal items (id and text) count once; repeated documents yield repeated rows; items that share an id are
searched for one by one. Ties in score stay both. Items with a null id are left out, since no row could name them. Empty
tables give an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import repeat
from math import fsum

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_slices, staged, table

UNIT, SHARD, BLOCK = 64, 20_000, 8
LENGTH, STRIDE = 128, 64
THRESHOLD, VERIFY = 0.6, 0.6
#: Words from which an item is indexed.
LEAST = 8
_EPS = 1e-9
K1, B = 1.2, 0.75
_SEPARATE = bytes(32 if chr(c) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~\t\n\r\x0b\x0c" else c for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_SEPARATE).split()


def parts_of(text: str) -> tuple[list[bytes], list[bytes]]:
    """Words of the question and of the answer."""
    cuts = [m.end() for m in re.finditer(r"[.!?:]\s+|\n+", text.rstrip())]
    for at in reversed(cuts):
        question, answer = words_of(text[:at]), words_of(text[at:])
        if len(question) >= 3 and answer:
            return question, answer
    return words_of(text), []


def _grams(words: list[bytes], n: int) -> set[tuple[bytes, ...]]:
    return set(zip(*(words[k:] for k in range(n)), strict=False))


def overlap(part: list[bytes], words: list[bytes]) -> float:
    """Share of a part's n-grams (3, or the whole part where shorter) that some words have."""
    n = min(3, len(part))
    if not n:
        return 1.0
    own = _grams(part, n)
    return len(own & _grams(words, n)) / len(own)


def units_of(words: list[bytes]) -> list[list[bytes]]:
    return [words[at : at + UNIT] for at in range(0, len(words), UNIT)]


class Index:
    """Posting lists as one array each for all words: units and impacts by word, and blocks and their maxima by word.

    seen (units of the whole benchmark that have a word), number and mean (words of a unit) are those of the items
    themselves unless given."""

    def __init__(self, items: list[tuple[int, str]], seen: dict[bytes, int] | None = None, number: int | None = None, mean: float | None = None):
        self.items = [(i, *parts_of(t)) for i, t in items]
        units = [(k, words) for k, (_, q, a) in enumerate(self.items) if len(q) + len(a) >= LEAST for words in units_of(q + a)]
        self.unit_item = np.array([k for k, _ in units], np.int32)
        counts = [Counter(w) for _, w in units]
        seen = Counter(w for c in counts for w in c) if seen is None else seen
        number = len(units) if number is None else number
        mean = max(1.0, sum(len(w) for _, w in units) / max(1, len(units))) if mean is None else mean
        self.word = {w: k for k, w in enumerate(dict.fromkeys(w for c in counts for w in c))}
        self.blocks = -(-len(units) // BLOCK)
        rows = []
        for u, c in enumerate(counts):
            size = sum(c.values())
            own = [(self.word[w], np.log1p((number - seen[w] + 0.5) / (seen[w] + 0.5)) * f * (K1 + 1) / (f + K1 * (1 - B + B * size / mean))) for w, f in c.items()]
            total = sum(x for _, x in own)
            rows += [(w, u, x / total) for w, x in own]
        rows.sort(key=lambda r: r[:2])
        self.post_word = np.array([r[0] for r in rows], np.int64)
        self.post_unit = np.array([r[1] for r in rows], np.int32)
        self.post_impact = np.array([r[2] for r in rows], np.float64)
        self.post_at = np.searchsorted(self.post_word, np.arange(len(self.word) + 1))
        tops: dict[tuple[int, int], tuple[float, int]] = {}
        for p, (w, u, x) in enumerate(rows):
            top, first = tops.get((w, u // BLOCK), (0.0, p))
            tops[w, u // BLOCK] = max(x, top), first
        self.top_block = np.array([b for _, b in tops], np.int64)
        self.top_impact = np.array([x for x, _ in tops.values()], np.float64)
        #: Where a block's postings begin; they end where the next one's begin.
        self.top_post = np.array([p for _, p in tops.values()] + [len(rows)], np.int64)
        self.top_at = np.searchsorted(np.array([w for w, _ in tops], np.int64), np.arange(len(self.word) + 1))
        self.top_of_word = np.array([self.top_impact[i:j].max(initial=0.0) for i, j in zip(self.top_at[:-1], self.top_at[1:], strict=True)])
        #: Postings scored so far.
        self.read = 0

    @staticmethod
    def _spread(at: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Places of the entries of several words."""
        low, size = at[ids], at[ids + 1] - at[ids]
        return np.repeat(low - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())

    def _reach(self, ids: np.ndarray) -> np.ndarray:
        """For each passage the greatest sum of block maxima of its distinct words: a score that no unit exceeds. Counted for
        all strides of a text at once; a passage has two, less what is in both."""
        n, blocks, words = max(1, -(-len(ids) // STRIDE)), max(1, self.blocks), len(self.word)
        reach = np.zeros(n)
        if not words:
            return reach
        place = np.flatnonzero(ids >= 0)
        key = np.unique(place // STRIDE * words + ids[place])
        both = key[np.isin(key + words, key, assume_unique=True)]  # also in the next stride

        def summed(key: np.ndarray, low: int, rows: int) -> np.ndarray:
            i, j = np.searchsorted(key, (low * words, (low + rows) * words))
            stride, word = np.divmod(key[i:j], words)
            at = self._spread(self.top_at, word)
            own = np.repeat(stride - low, self.top_at[word + 1] - self.top_at[word])
            return np.bincount(own * blocks + self.top_block[at], self.top_impact[at], rows * blocks).reshape(rows, blocks)

        step = max(1, (1 << 17) // blocks)  # strides at once: bounded, however long the text or large the index
        for low in range(0, n, step):
            rows = min(step, n - low)
            bound = summed(key, low, rows + 1)
            reach[low : low + rows] = (bound[:-1] + bound[1:] - summed(both, low, rows)).max(axis=1)
        return reach

    def query(self, ids: np.ndarray, threshold: float) -> list[tuple[int, float]]:
        """All units that score threshold or more for the distinct words of a passage, by unit."""
        ids = ids[np.argsort(self.top_of_word[ids], kind="stable")]
        reach = np.cumsum(self.top_of_word[ids])
        if not len(ids) or reach[-1] < threshold - _EPS:
            return []
        at = self._spread(self.top_at, ids)
        block = self.top_block[at]
        bound = np.bincount(block, self.top_impact[at], self.blocks)
        can_pivot = np.zeros(self.blocks, bool)
        can_pivot[self.top_block[self._spread(self.top_at, ids[np.searchsorted(reach, threshold - _EPS) :])]] = True
        opened = np.flatnonzero(can_pivot & (bound >= threshold - _EPS))
        return [x for b in opened.tolist() for x in self._wand(at[block == b], threshold)]

    def _wand(self, tops: np.ndarray, threshold: float) -> list[tuple[int, float]]:
        """The units of one block that score threshold or more, from its words' entries."""
        found = []
        cursors = []  # [unit, place in units, greatest impact in the block, units, impacts]
        for low, high, top in zip(self.top_post[tops].tolist(), self.top_post[tops + 1].tolist(), self.top_impact[tops].tolist(), strict=True):
            units = self.post_unit[low:high].tolist()
            cursors.append([units[0], 0, top, units, low])
        while cursors:
            cursors.sort(key=lambda c: c[0])
            total, pivot = 0.0, None
            for c in cursors:
                total += c[2]
                if total >= threshold - _EPS:
                    pivot = c[0]
                    break
            if pivot is None:
                break
            if cursors[0][0] == pivot:
                on = [c for c in cursors if c[0] == pivot]
                score = fsum(self.post_impact[[c[4] + c[1] for c in on]].tolist())  # whatever the order of the words
                self.read += len(on)
                if score >= threshold - _EPS:
                    found.append((pivot, score))
                for c in on:
                    c[1] += 1
            else:
                for c in cursors:
                    if c[0] >= pivot:
                        break
                    c[1] = bisect_left(c[3], pivot, c[1])
            cursors = [c for c in cursors if c[1] < len(c[3])]
            for c in cursors:
                c[0] = c[3][c[1]]
        return found

    def search(self, text: str | None, threshold: float = THRESHOLD, verify: float = VERIFY) -> list[tuple[int, float, float, float]]:
        """(item id, score, question overlap, answer overlap) of the items that a document has."""
        words = words_of(text)
        ids = np.fromiter(map(self.word.get, words, repeat(-1)), np.int64, len(words))
        found: dict[int, tuple[float, int, int]] = {}
        can_reach = self._reach(ids) >= threshold - _EPS
        for at in range(0, max(1, len(words) - LENGTH + STRIDE), STRIDE):
            if not can_reach[at // STRIDE]:
                continue
            own = np.unique(ids[at : at + LENGTH])
            for u, score in self.query(own[own >= 0], threshold):
                k = int(self.unit_item[u])
                before, low, high = found.get(k, (0.0, at, at))
                found[k] = max(score, before), min(low, at), max(high, at + LENGTH)
        out = []
        for k, (score, low, high) in sorted(found.items()):
            item, question, answer = self.items[k]
            size = len(question) + len(answer)
            near = words[max(0, low - size) : high + size]
            q, a = overlap(question, near), overlap(answer, near)
            if q >= verify and a >= verify:
                out.append((item, score, q, a))
        return out


def _named(benchmark: DataFrame) -> DataFrame:
    return benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()


def _sized(benchmark: DataFrame) -> DataFrame:
    """item_id, text and n_words of the items."""

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(it):
            sizes = pa.array([sum(map(len, parts_of(t))) for t in batch.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), batch.column("text"), sizes], ["item_id", "text", "n_words"])

    return _named(benchmark).mapInArrow(count, "item_id long, text string, n_words long")


def short_items(benchmark: DataFrame, least: int = LEAST) -> DataFrame:
    """item_id and n_words of the items with too few words to be indexed."""
    return _sized(benchmark).where(F.col("n_words") < least).select("item_id", "n_words")


def _unit_words(items: DataFrame) -> DataFrame:
    """word, unit (0 for the first distinct word of a unit, else 1) and size (that unit's words, 0 else) of every distinct
    word of every unit."""

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            rows = []
            for t in batch.column("text").to_pylist():
                question, answer = parts_of(t)
                for unit in units_of(question + answer) if len(question) + len(answer) >= LEAST else []:
                    rows += [(w, int(k == 0), len(unit) * (k == 0)) for k, w in enumerate(dict.fromkeys(unit))]
            columns = list(zip(*rows, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], ["word", "unit", "size"])

    return items.select("text").mapInArrow(cut, "word binary, unit long, size long")


def _indexes(benchmark: DataFrame, shard: int) -> tuple[int, Iterator[Index]]:
    """How many shards there are, and their indexes, one after another."""
    items = staged(_sized(benchmark).where(F.col("n_words") >= LEAST).select("item_id", "text"), "benchmark-items")
    words = staged(_unit_words(items).groupBy("word").agg(F.count(F.lit(1)).alias("seen"), F.sum("unit").alias("units"), F.sum("size").alias("size")), "benchmark-words")
    number, size = words.agg(F.sum("units"), F.sum("size")).first()
    number = number or 0
    n = 1 if number <= shard else -(-3 * number // (2 * shard))

    def build() -> Iterator[Index]:
        for k in range(n):
            part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
            seen = words.join(_unit_words(part).select("word").distinct(), "word", "left_semi").select("word", "seen")  # at most shard * UNIT rows
            yield Index(sorted(map(tuple, part.collect())), {bytes(r.word): r.seen for r in seen.collect()}, number, max(1.0, (size or 0) / max(1, number)))

    return n, build()


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, verify: float = VERIFY, shard: int = SHARD) -> DataFrame:
    """doc_id, item_id, score, question_overlap and answer_overlap of every document with a test item in it."""
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()

    def found_in(kept):  # noqa: ANN001, ANN202
        def find(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = kept.value
            for batch in in_slices(it):
                ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
                rows = [(k, *x) for k, t in enumerate(texts) for x in index.search(t, threshold, verify)]
                columns = list(zip(*rows, strict=True)) or [[]] * 5
                found = [ids.take(pa.array(columns[0], pa.int64())), pa.array(columns[1], pa.int64()), *(pa.array(c, pa.float64()) for c in columns[2:])]
                yield pa.RecordBatch.from_arrays(found, ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

        return docs.select("doc_id", "text").mapInArrow(find, f"doc_id {kind}, item_id long, score double, question_overlap double, answer_overlap double")

    n, indexes = _indexes(benchmark, shard)
    if n == 1:
        return found_in(spark.sparkContext.broadcast(next(indexes)))
    parts = []
    for index in indexes:
        kept = spark.sparkContext.broadcast(index)
        parts.append(staged(found_in(kept), "benchmark-hits"))
        kept.destroy()
    return reduce(DataFrame.unionByName, parts)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, verify: float = VERIFY, shard: int = SHARD) -> DataFrame:
    """The rows without a test item in them, with all their columns; rows without a doc_id are judged like others."""
    spark, names, digest = docs.sparkSession, docs.columns, "drop_contaminated_sha"

    def chosen(df: DataFrame, kept, has: bool) -> DataFrame:  # noqa: ANN001
        def choose(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in in_slices(it):
                yield batch.filter(pa.array([bool(kept.value.search(t, threshold, verify)) == has for t in batch.column("text").to_pylist()], pa.bool_()))

        return df.mapInArrow(choose, df.schema)

    n, indexes = _indexes(benchmark, shard)
    if n == 1:
        return chosen(docs, spark.sparkContext.broadcast(next(indexes)), False)
    # equal texts are judged alike, so the digests of the texts to drop are all that the shards leave behind
    marked, parts = docs.withColumn(digest, F.sha2(F.coalesce("text", F.lit("")), 256)), []
    for index in indexes:
        kept = spark.sparkContext.broadcast(index)
        parts.append(staged(chosen(marked.select(digest, "text"), kept, True).select(digest).distinct(), "benchmark-hits"))
        kept.destroy()
    return marked.join(reduce(DataFrame.unionByName, parts), digest, "left_anti").select(*names)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.round("score", 6).alias("score"), F.round("question_overlap", 6).alias("question_overlap"), F.round("answer_overlap", 6).alias("answer_overlap"))
