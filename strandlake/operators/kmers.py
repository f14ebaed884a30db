"""K-mer tables (kmer, cnt): counting, transforms and set algebra, all as joins and aggregates on the k-mer."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandlake.functions import codes
from strandlake.functions.sequence import compress_homopolymers, from_two_bit, reverse_complement, window_starts

#: Default bounds: least and greatest true count kept, and the greatest count stored.
CI, CX, CS = 2, 1_000_000_000, 255
#: Bases after which a record is cut where its windows are strings.
STRIP = 256
#: Up to this k every task counts all k-mers there are.
DENSE = 10
#: Classes of minimizers, and windows of a group of classes that one task counts at once.
CLASSES, GROUP = 1 << 16, 1 << 23
#: Windows of a run at most.
RUN = 256


def canonical(kmer: Column) -> Column:
    return F.least(kmer, reverse_complement(kmer))


def strips(reads: DataFrame, k: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """(keep, at, sequence): reads cut at every STRIP bases into pieces that also hold the next k - 1; each window of k lies
    in one piece. So no window is looked for far into a long record, and a chromosome's windows can be many tasks' work."""
    cut = F.regexp_extract_all("sequence", F.lit(f"(?s).{{1,{STRIP}}}"), F.lit(0))
    after = -(-(k - 1) // STRIP)
    rest = lambda a: F.transform(a, lambda x, i: F.concat(x, F.substring(F.array_join(F.slice(a, i + 2, F.lit(after)), ""), 1, k - 1) if after else F.lit("")))
    whole = F.transform(F.array(cut), rest)[0]
    pieces = F.when(F.length("sequence") <= STRIP, F.array("sequence")).otherwise(whole)
    return reads.select(*keep, F.posexplode(pieces).alias("i", "sequence")).select(*keep, (F.col("i") * STRIP).cast("long").alias("at"), "sequence")


def _sequences(reads: DataFrame, k: int, compress: bool, keep: tuple[str, ...] = ()) -> DataFrame:
    if not 1 <= k <= 256:
        raise ValueError("k must be in 1..256")
    return reads.select(*keep, (compress_homopolymers(F.col("sequence")) if compress else F.col("sequence")).alias("sequence"))


def read_codes(reads: DataFrame, k: int, both_strands: bool = True, compress: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """(keep, pos, code): the two-bit code of each window of k <= 31 of each read, 1-based; null where a base is none of ACGT.
    The cost is linear in bases, whatever the length of the records."""
    if k > codes.MOST:
        raise ValueError(f"codes have k of {codes.MOST} at most")
    rows = _sequences(reads, k, compress, keep)

    def roll(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for w in codes.windows(*codes.flat(batch.column("sequence")), k):
                kept = [batch.column(c).take(pa.array(w.row)) for c in keep]
                value = pa.array(w.canonical() if both_strands else w.code, mask=~w.known)
                yield pa.RecordBatch.from_arrays([*kept, pa.array(w.at + 1), value], [*keep, "pos", "code"])

    schema = T.StructType([rows.schema[c] for c in keep] + [T.StructField("pos", T.LongType()), T.StructField("code", T.LongType())])
    return rows.mapInArrow(roll, schema)


def read_kmers(reads: DataFrame, k: int, both_strands: bool = True, compress: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """A row (keep, pos, kmer) for each window of k of each read, 1-based; windows with other symbols than ACGT have a null
    k-mer. Records of any length: codes up to k = 31, beyond that strings from strips."""
    if k <= codes.MOST:
        return read_codes(reads, k, both_strands, compress, keep).select(*keep, "pos", from_two_bit(F.col("code"), k).alias("kmer"))
    rows = strips(_sequences(reads, k, compress, keep), k, keep)
    rows = rows.select(*keep, "at", "sequence", F.explode(window_starts(F.length("sequence"), k)).alias("i")).where(F.col("i") < STRIP)
    window = F.substring("sequence", F.col("i") + 1, F.lit(k))
    rows = rows.select(*keep, (F.col("at") + F.col("i") + 1).alias("pos"), window.alias("kmer"))
    kmer = canonical(F.col("kmer")) if both_strands else F.col("kmer")
    return rows.withColumn("kmer", F.when(F.col("kmer").rlike("^[ACGT]+$"), kmer))


def _dense(rows: DataFrame, k: int, both_strands: bool) -> DataFrame:
    """(kmer, cnt) for small k: a task sends each k-mer once."""

    def add(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(4**k, np.int64)
        for batch in it:
            for w in codes.windows(*codes.flat(batch.column("sequence")), k):
                total += np.bincount((w.canonical() if both_strands else w.code)[w.known], minlength=4**k)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["code", "n"])

    counted = rows.mapInArrow(add, "code long, n long").groupBy("code").agg(F.sum("n").alias("cnt"))
    return counted.select(from_two_bit(F.col("code"), k).alias("kmer"), "cnt")


def minimizer_size(k: int) -> int:
    return min(11, k // 2 + 1)


def _classes(rows: DataFrame, k: int) -> np.ndarray:
    """How many windows have each class of minimizers: CLASSES numbers."""

    def add(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES, np.int64)
        for batch in it:
            for w in codes.windows(*codes.flat(batch.column("sequence")), k, minimizer_size(k)):
                total += np.bincount(w.least[w.known] % CLASSES, minlength=CLASSES)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["class", "n"])

    out = np.zeros(CLASSES, np.int64)
    for r in rows.mapInArrow(add, "class long, n long").groupBy("class").agg(F.sum("n").alias("n")).collect():
        out[r["class"]] = r.n
    return out


def groups_of(sizes: np.ndarray, group: int = GROUP) -> np.ndarray:
    """The group of each class: neighbours together up to `group` windows; -1 for classes that have more alone."""
    out, at, held = np.full(len(sizes), -1, np.int32), 0, 0
    for c, n in enumerate(sizes.tolist()):
        if n <= group:
            if held + n > group:
                at, held = at + 1, 0
            out[c], held = at, held + n
    return out


def runs_of(rows: DataFrame, k: int, group: np.ndarray) -> DataFrame:
    """(part, runs): pieces of the sequences whose windows share a group of minimizers, packed in two bits a base, a row for
    each group and block of windows; each window without unknown bases is in one piece, but for those of group -1."""

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            data, ends = codes.flat(batch.column("sequence"))
            for w in codes.windows(data, ends, k, minimizer_size(k)):
                part = np.where(w.known, group[w.least % CLASSES], -1)
                new = np.ones(len(part), bool)
                new[1:] = (part[1:] != part[:-1]) | (w.row[1:] != w.row[:-1])
                first = np.flatnonzero(new)
                place = np.arange(len(part)) - np.repeat(first, np.diff(np.append(first, len(part))))
                first = np.flatnonzero(place % RUN == 0)
                size = np.diff(np.append(first, len(part)))
                kept = part[first] >= 0
                first, size = first[kept], size[kept]
                parts, runs = codes.pack(data, (ends[w.row] + w.at)[first], size + k - 1, part[first])
                yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(runs, pa.binary())], ["part", "runs"])

    return rows.mapInArrow(cut, "part int, runs binary")


def _count_runs(runs: DataFrame, k: int, both_strands: bool) -> DataFrame:
    """(kmer, cnt) of runs: all windows of a k-mer are in one part, so one shuffle of runs is all."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]

        def merged() -> tuple[np.ndarray, np.ndarray]:
            key, n = (np.concatenate(x) for x in zip(*held, strict=True))
            found, place = np.unique(key, return_inverse=True)
            return found, np.bincount(place, n, len(found)).astype(np.int64)

        for batch in batches:
            for w in codes.windows(*codes.unpack(batch.column("runs")), k):
                held.append(np.unique(w.canonical() if both_strands else w.code, return_counts=True))
                if sum(len(x[0]) for x in held[1:]) > max(codes.CHUNK * 4, len(held[0][0])):
                    held = [merged()]
        key, n = merged()
        for low in range(0, len(key), codes.CHUNK):
            part = slice(low, low + codes.CHUNK)
            yield pa.RecordBatch.from_arrays([codes.decoded(key[part], k), pa.array(n[part])], ["kmer", "cnt"])

    return runs.groupBy("part").applyInArrow(add, "kmer string, cnt long")


def _by_minimizers(rows: DataFrame, k: int, both_strands: bool, group: int = GROUP) -> DataFrame:
    """(kmer, cnt) by minimizers: neighbouring windows mostly share one, and travel as one packed run instead of a code each.
    Classes of minimizers with more windows than a task should count at once (repeats) go by their codes, which are counted
    before they are shuffled."""
    sizes = _classes(rows, k)
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = groups_of(sizes, min(group, max(1 << 14, int(sizes.sum()) // (4 * tasks))))
    counted = _count_runs(runs_of(rows, k, groups), k, both_strands)
    if not (sizes[groups < 0] > 0).any():
        return counted

    def rest(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for w in codes.windows(*codes.flat(batch.column("sequence")), k, minimizer_size(k)):
                mine = w.known & (groups[w.least % CLASSES] < 0)
                found, n = np.unique((w.canonical() if both_strands else w.code)[mine], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], ["code", "n"])

    heavy = rows.mapInArrow(rest, "code long, n long").groupBy("code").agg(F.sum("n").alias("cnt"))
    return counted.unionByName(heavy.select(from_two_bit(F.col("code"), k).alias("kmer"), "cnt"))


def _counted(reads: DataFrame, k: int, both_strands: bool, compress: bool = False) -> DataFrame:
    """(kmer, cnt) of all k-mers."""
    rows = _sequences(reads, k, compress)
    if k <= DENSE:
        return _dense(rows, k, both_strands)
    if k <= codes.MOST:
        return _by_minimizers(rows, k, both_strands)
    return read_kmers(rows, k, both_strands).where("kmer is not null").groupBy("kmer").agg(F.count(F.lit(1)).alias("cnt"))


def count_kmers(reads: DataFrame, k: int = 25, ci: int = CI, cx: int = CX, cs: int = CS, both_strands: bool = True, compress: bool = False) -> DataFrame:
    """(kmer, cnt): counts in ci..cx, stored as cs at most."""
    return reduce_counts(_counted(reads, k, both_strands, compress), ci, cx, cs)


def count_summary(reads: DataFrame, k: int = 25, ci: int = CI, cx: int = CX, both_strands: bool = True, compress: bool = False) -> DataFrame:
    """One row: k-mers in all, distinct ones, those below ci and above cx, and reads."""
    totals = _counted(reads, k, both_strands, compress).agg(
        F.coalesce(F.sum("cnt"), F.lit(0)).cast("long").alias("total_kmers"), F.count(F.lit(1)).alias("unique_kmers"),
        F.count_if(F.col("cnt") < ci).alias("below_min"), F.count_if(F.col("cnt") > cx).alias("above_max"),
        F.count_if(F.col("cnt").between(ci, cx)).alias("counted_kmers"), F.lit(1).alias("one"),
    )
    number = reads.agg(F.count(F.lit(1)).alias("reads"), F.lit(1).alias("one"))
    return totals.join(number, "one").drop("one")


def _sampled(reads: DataFrame, k: int, one_in: int, both_strands: bool) -> DataFrame:
    """(kmer, cnt) of the k-mers whose hash (the first 8 digits of their MD5) falls into one of one_in classes."""
    rows = read_kmers(reads, k, both_strands).where("kmer is not null")
    mine = F.conv(F.substring(F.md5("kmer"), 1, 8), 16, 10).cast("long") % one_in == 0
    return rows.where(mine).groupBy("kmer").agg(F.count(F.lit(1)).alias("cnt"))


def estimate_histogram(reads: DataFrame, k: int = 25, one_in: int = 16, both_strands: bool = True) -> DataFrame:
    """(cnt, kmers) estimated from one class of k-mers, each counted exactly."""
    return _sampled(reads, k, one_in, both_strands).groupBy("cnt").agg((F.count(F.lit(1)) * one_in).alias("kmers"))


def estimate_totals(reads: DataFrame, k: int = 25, one_in: int = 16, both_strands: bool = True) -> DataFrame:
    """One row: distinct_kmers and total_kmers, estimated likewise."""
    total = F.coalesce(F.sum("cnt"), F.lit(0)).cast("long") * one_in
    return _sampled(reads, k, one_in, both_strands).agg((F.count(F.lit(1)) * one_in).alias("distinct_kmers"), total.alias("total_kmers"))


def kmer_sketches(reads: DataFrame, k: int = 25, by: tuple[str, ...] = (), lg: int = 12, both_strands: bool = True) -> DataFrame:
    """(by, sketch): a HyperLogLog sketch of 2^lg registers of the distinct k-mers of each group of reads, a few kilobytes
    whatever the input. Sketches are written like any column and merged with those of other files."""
    each = read_codes(reads, k, both_strands, keep=by).where("code is not null") if k <= codes.MOST else read_kmers(reads, k, both_strands, keep=by).withColumnRenamed("kmer", "code").where("code is not null")
    return each.groupBy(*by).agg(F.hll_sketch_agg("code", F.lit(lg)).alias("sketch"))


def sketched_distinct(sketches: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, distinct_kmers) estimated from sketches, merged within each group of by: equal k-mers of different files count
    once. The error is about 1 / sqrt(2^lg), a hundredth and a half at lg = 12."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_kmers"))


# Transforms. A frame that several branches read is worth persisting: each branch stays a filter over it.


def reduce_counts(table: DataFrame, ci: int = 1, cx: int = CX, cs: int | None = None) -> DataFrame:
    """Bounds apply to the true count, the cap afterwards."""
    kept = table.where(F.col("cnt").between(ci, cx))
    return kept if cs is None else kept.withColumn("cnt", F.least("cnt", F.lit(cs).cast("long")))


def sort_kmers(table: DataFrame) -> DataFrame:
    return table.orderBy("kmer")


def compact(table: DataFrame) -> DataFrame:
    return table.select("kmer")


def histogram(table: DataFrame, ci: int = 1, cx: int = 10_000, dense: bool = False) -> DataFrame:
    """(cnt, kmers) for counts in ci..cx; dense adds the counts that none has."""
    found = table.where(F.col("cnt").between(ci, cx)).groupBy("cnt").agg(F.count(F.lit(1)).alias("kmers"))
    if not dense:
        return found
    return table.sparkSession.range(ci, cx + 1).select(F.col("id").alias("cnt")).join(found, "cnt", "left").select("cnt", F.coalesce("kmers", F.lit(0)).cast("long").alias("kmers"))


def set_counts(table: DataFrame, value: int) -> DataFrame:
    return table.withColumn("cnt", F.lit(value).cast("long"))


# Set algebra on (kmer, cnt).

#: Counter of the result by mode; a and b are the two counters, 0 where absent.
MODES: dict[str, Callable[[Column, Column], Column]] = {
    "min": lambda a, b: F.least(a, b), "max": lambda a, b: F.greatest(a, b), "sum": lambda a, b: a + b,
    "diff": lambda a, b: a - b, "left": lambda a, b: a, "right": lambda a, b: b,
}


def paired(a: DataFrame, b: DataFrame) -> DataFrame:
    """(kmer, a, b) of all k-mers of either, 0 where absent: one shuffle of each side, from which all results derive."""
    left, right = a.select("kmer", F.col("cnt").alias("a")), b.select("kmer", F.col("cnt").alias("b"))
    return left.join(right, "kmer", "full").select("kmer", F.coalesce("a", F.lit(0)).cast("long").alias("a"), F.coalesce("b", F.lit(0)).cast("long").alias("b"))


def _combined(both: DataFrame, mode: str) -> DataFrame:
    out = both.select("kmer", MODES[mode](F.col("a"), F.col("b")).alias("cnt"))
    return out.where("cnt > 0") if mode == "diff" else out


def intersect_of(both: DataFrame, mode: str = "min") -> DataFrame:
    return _combined(both.where("a > 0 and b > 0"), mode)


def union_of(both: DataFrame, mode: str = "sum") -> DataFrame:
    return _combined(both, mode)


def intersect(a: DataFrame, b: DataFrame, mode: str = "min") -> DataFrame:
    both = a.select("kmer", F.col("cnt").alias("a")).join(b.select("kmer", F.col("cnt").alias("b")), "kmer")
    return _combined(both, mode)


def union(a: DataFrame, b: DataFrame, mode: str = "sum") -> DataFrame:
    return union_of(paired(a, b), mode)


def subtract(a: DataFrame, b: DataFrame) -> DataFrame:
    """K-mers of a that b lacks, with their counters."""
    return a.join(b, "kmer", "left_anti")


def subtract_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    """Counters of a less those of b, where more than 0."""
    both = a.select("kmer", F.col("cnt").alias("a")).join(b.select("kmer", F.col("cnt").alias("b")), "kmer", "left")
    return _combined(both.select("kmer", "a", F.coalesce("b", F.lit(0)).cast("long").alias("b")), "diff")


def reverse_subtract(a: DataFrame, b: DataFrame) -> DataFrame:
    return subtract(b, a)


def reverse_subtract_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    return subtract_counts(b, a)
