"""Target-distribution importance resampling: documents drawn by how much likelier their n-grams are in target texts.

Words are runs of digits, a-z (A-Z in lower case) and characters beyond ASCII; features are all runs of 1 to 3 words,
joined by a space, in BUCKETS buckets by CRC-32. Both corpora are counted whole:

Segments: newlines separate words, so they cut a text into lines. Each line is brought to its words and sent once by each
task that has it, with its number; equal lines meet in one aggregate. The features of a distinct line are hashed once and
count as often as the line occurs. Features that cross from line to line are few; each task adds them up beside its lines.
A licence line that a third of all documents hold is thus one row a task, and no key is hot.

Hashing: CRC-32 is linear, so the code of a run of words comes from the codes of its words (`Hasher`), all of a block of
words at once; nothing is joined to strings.

Gains (one whole number for each bucket) go to all tasks; a document's weight sums them over its features, and its score
adds Gumbel noise from a hash of its id, so that the highest scores are a draw without replacement in proportion to the
exponential of the weights. Ranks: equal bins of scores tell where the last drawn one lies, rows from there on are sorted
by range and written, and each range is numbered by itself after what the ranges before it hold.

Null texts have no words: no features, weight 0. Texts and words of any length are read whole, in blocks. Repeated rows
count and come out as often as they stand; equal scores are ranked by smaller doc_id, and rows that are equal in both by
weight and features (rows equal in all columns take ranks in any order, which gives the same result). A row without a
doc_id counts as text but has no score and is not drawn. An empty table gives an empty result; a target without words
makes rare features gain. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import in_slices, staged, table

BUCKETS = 10_000
SEED = 42
LEAST_WORDS = 20
#: Documents drawn of a hundred.
PERCENT = 5
#: Bins of scores in which the last drawn one is looked for.
BINS = 1 << 16
#: Words hashed at once, bytes of a text that are cut into words at once, and words that a task remembers.
BLOCK, PIECE, KNOWN = 1 << 18, 1 << 22, 1 << 18
_KEPT = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(128, 256))
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c if c in _KEPT or c == 10 else 32 for c in range(256))


def lines_of(text: str | None) -> Iterator[bytes]:
    """The lines of a text that have words: lower-case words with one space between."""
    for line in (text or "").encode().translate(_LOWER).split(b"\n"):
        # a long line never becomes a list of words
        if words := b" ".join(line.split()) if len(line) < PIECE else re.sub(b" +", b" ", line).strip():
            yield words


def crossing(lines: Iterable[bytes]) -> Iterator[bytes]:
    """The runs of 2 and 3 words that aren't within one line."""
    before: list[bytes] = []
    for line in lines:
        first = line.split(b" ", 2)[:2]
        if before:
            yield b" ".join((before[-1], first[0]))
            if len(before) == 2:
                yield b" ".join((*before, first[0]))
            if len(first) == 2:
                yield b" ".join((before[-1], *first))
        before = (before + line.rsplit(b" ", 2)[-2:])[-2:]


def _through(tables: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, as 4 tables of 256 values, applied to codes."""
    return tables[0][codes & 255] ^ tables[1][codes >> 8 & 255] ^ tables[2][codes >> 16 & 255] ^ tables[3][codes >> 24]


def _zero_bytes() -> tuple[np.ndarray, list[np.ndarray]]:
    """Maps that tell how a CRC-32 changes as zero bytes follow: for 0 to 63 of them, and for 2, 4, 8.. of them up to 2^31."""
    values = np.arange(256, dtype=np.uint32)
    start = np.stack([values << np.uint32(8 * j) for j in range(4)])
    # with two texts of one length, what differs in their CRCs after a zero byte is the map of what differed before
    codes = np.array([zlib.crc32(b"\0", int(v)) for v in values], np.uint32) ^ np.uint32(zlib.crc32(b"\0"))
    one = np.stack([codes] + [np.array([zlib.crc32(b"\0", int(v) << 8 * j) for v in values], np.uint32) ^ np.uint32(zlib.crc32(b"\0")) for j in (1, 2, 3)])
    short = [start]
    for _ in range(63):
        short.append(_through(one, short[-1]))
    doubled = [one]
    for _ in range(31):
        doubled.append(_through(doubled[-1], doubled[-1]))
    return np.stack(short), doubled


_SHORT, _DOUBLED = _zero_bytes()


def followed(codes: np.ndarray, n: np.ndarray) -> np.ndarray:
    """CRC-32 codes as they go on over n further bytes, but for those bytes' own code."""
    k = np.minimum(n, 63)
    out = _SHORT[k, 0, codes & 255] ^ _SHORT[k, 1, codes >> 8 & 255] ^ _SHORT[k, 2, codes >> 16 & 255] ^ _SHORT[k, 3, codes >> 24]
    rest = n - k
    for at in np.flatnonzero(rest):
        for j in range(int(rest[at]).bit_length()):
            if int(rest[at]) >> j & 1:
                out[at] = _through(_DOUBLED[j], out[at : at + 1])[0]
    return out


class Hasher(dict):
    """Words by number, with the CRC-32 of each, that of the word after a space, and its length with that space."""

    def __init__(self) -> None:
        super().__init__()
        self.plain, self.spaced, self.length, self.held = array("I"), array("I"), array("q"), 0

    def __missing__(self, word: bytes) -> int:
        self[word] = k = len(self.plain)
        self.plain.append(zlib.crc32(word))
        self.spaced.append(zlib.crc32(b" " + word))
        self.length.append(len(word) + 1)
        self.held += len(word)
        return k

    def buckets(self, words: list[bytes], tags: np.ndarray, done: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(tags, buckets) of runs of 1, 2 and 3 words of one tag that end at word number `done` or later."""
        if len(self) > KNOWN or self.held > 64 * KNOWN:
            self.clear()
            self.__init__()
        ids = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        plain, spaced, length = (np.array(x)[ids] for x in (self.plain, self.spaced, self.length))
        code, out = plain, []
        for n in range(3):
            if n:
                code = followed(code[:-1], length[n:]) ^ spaced[n:]
            low = max(0, done - n)
            same = tags[n:][low:] == tags[: len(tags) - n][low:]
            out.append((tags[n:][low:][same], (code[low:][same] % np.uint32(BUCKETS)).astype(np.int64)))
        return out


def features(units: Iterable[tuple[int, bytes]], hasher: Hasher) -> Iterator[list[tuple[np.ndarray, np.ndarray]]]:
    """What Hasher.buckets gives, block after block, for units (tag, words with spaces or newlines between)."""
    words: list[bytes] = []
    tags: list[np.ndarray] = []
    done = 0
    for tag, data in units:
        at = 0
        while at < len(data):
            end = len(data)
            if end - at > PIECE:  # a word is never cut
                end = max(data.rfind(b" ", at, at + PIECE), data.rfind(b"\n", at, at + PIECE))
                end = end if end > at else min((x for x in (data.find(b" ", at + PIECE), data.find(b"\n", at + PIECE)) if x > 0), default=len(data))
            new = data[at:end].split()
            words += new
            tags.append(np.full(len(new), tag, np.int64))
            at = end
            if len(words) >= BLOCK:
                all_tags = np.concatenate(tags)
                yield hasher.buckets(words, all_tags, done)
                words, tags, done = words[-2:], [all_tags[-2:]], 2
    if len(words) > done:
        yield hasher.buckets(words, np.concatenate(tags), done)


def bucket_counts(texts: DataFrame) -> tuple[np.ndarray, int]:
    """How many features of all texts (column text) fall into each bucket, and their number; BUCKETS rows come back."""

    def segments(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        across = np.zeros(BUCKETS, np.int64)
        for batch in in_slices(it):
            found: Counter[bytes] = Counter()
            for text in batch.column("text").to_pylist():
                lines = list(lines_of(text))
                found.update(lines)
                for run in crossing(lines):
                    across[zlib.crc32(run) % BUCKETS] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.nulls(len(found), pa.int32()), pa.array(list(found.values()), pa.int64())], ["line", "bucket", "n"])
        at = np.flatnonzero(across)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(at), pa.binary()), pa.array(at, pa.int32()), pa.array(across[at])], ["line", "bucket", "n"])

    def counted(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, hasher = np.zeros(BUCKETS, np.int64), Hasher()
        for batch in in_slices(it, 1 << 14):
            lines, n = batch.column("line").to_pylist(), batch.column("n").to_numpy()
            for k, b in enumerate(batch.column("bucket").to_pylist()):
                if b is not None:
                    total[b] += n[k]
            for block in features(((k, line) for k, line in enumerate(lines) if line is not None), hasher):
                for tags, buckets in block:
                    np.add.at(total, buckets, n[tags])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["bucket", "n"])

    rows = texts.select("text").mapInArrow(segments, "line binary, bucket int, n long").groupBy("line", "bucket").agg(F.sum("n").alias("n"))
    sums = rows.mapInArrow(counted, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS, np.int64)
    for r in sums:
        out[r.bucket] = r.n
    return out, int(out.sum())


def gains(raw: tuple[np.ndarray, int], target: tuple[np.ndarray, int]) -> np.ndarray:
    """The thousandfold logarithm of the ratio of smoothed shares in target and raw, for each bucket, rounded down."""
    (s, n_raw), (t, n_target) = raw, target
    return np.array([math.floor(1000 * math.log(float(b + 1) * (n_raw + BUCKETS) / (float(a + 1) * (n_target + BUCKETS)))) for a, b in zip(s.tolist(), t.tolist(), strict=True)], np.int64)


def noise(doc_id: int, seed: int = SEED) -> int:
    h = int.from_bytes(sha256(f"{seed}:{doc_id}".encode()).digest()[:4], "big")
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighed(docs: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row."""

    def weigh(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in in_slices(it):
            ids = batch.column("doc_id").to_pylist()
            words, n, weight = (np.zeros(len(ids), np.int64) for _ in range(3))
            for block in features(((k, (t or "").encode().translate(_LOWER)) for k, t in enumerate(batch.column("text").to_pylist())), hasher):
                for size, (tags, buckets) in enumerate(block):
                    count = np.bincount(tags, minlength=len(ids))
                    n += count
                    words += count if size == 0 else 0
                    np.add.at(weight, tags, gain[buckets])
            score = [None if i is None else int(w) + noise(i, seed) for i, w in zip(ids, weight.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (words, n, weight, score))], ["doc_id", "n_words", "n_features", "weight", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long, score long")


def ranked(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """scored, a written table as of `weighed`, with rank: 1, 2, 3.. for the drawn rows, highest score first, else null."""
    spark, none = scored.sparkSession, F.lit(None).cast("long")
    able = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    n, low, high = scored.where(able).agg(F.count(F.lit(1)), F.min("score"), F.max("score")).first()
    if not (k := percent * n // 100):
        return scored.withColumn("rank", none)
    width = (high - low) // BINS + 1
    bins = dict(scored.where(able).groupBy(F.expr(f"cast((score - {low}) div {width} as int)").alias("bin")).count().collect())
    held, cut = 0, low
    for b in sorted(bins, reverse=True):
        held, cut = held + bins[b], low + b * width
        if held >= k:
            break
    near = able & (F.col("score") >= cut)
    dealt = staged(scored.where(near).repartitionByRange(F.desc("score"), F.asc("doc_id")).withColumn("part", F.spark_partition_id()), "importance-ranges")
    # one row a range
    before, offsets = 0, []
    for part, size in sorted(dealt.groupBy("part").count().collect()):
        offsets.append((part, before))
        before += size
    order = Window.partitionBy("part").orderBy(F.desc("score"), "doc_id", "weight", "n_features", "n_words")
    placed = dealt.withColumn("at", F.row_number().over(order)).join(F.broadcast(spark.createDataFrame(offsets, "part int, offset long")), "part")
    rank = F.col("at") + F.col("offset")
    top = placed.withColumn("rank", F.when(rank <= k, rank)).select(*scored.columns, "rank")
    return scored.where(~F.coalesce(near, F.lit(False))).withColumn("rank", none).unionByName(top)


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every row of docs; target has a column text."""
    gain = gains(bucket_counts(docs), bucket_counts(target))
    return ranked(staged(weighed(docs, gain, seed), "importance-scores"), percent, least_words)


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank", "n_words")
