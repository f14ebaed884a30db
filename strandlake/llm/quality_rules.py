"""Quality rules: counts of a text, and a hashed n-gram likelihood ratio of trusted against raw text.

Words and pairs of adjacent words fall into `buckets` by hash. Two multinomials are counted over the buckets: one from
all documents (raw) and one from those that a stated rule trusts (target). A document's mark is the mean over its
n-grams of log(P(target) / P(raw)), with add-one smoothing: length-normalised, so long and short texts compare. Every
document at LEAST or more is kept, all others go; nothing is drawn at random.

Null and empty texts have zero counts and mark 0 (they fail the base rule for want of words). Texts of any length are
read whole; equal marks are equal verdicts. Repeated rows count and come out as often as they stand. In an empty table
nothing is counted and nothing comes out. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, table, whole_words

BUCKETS = 1 << 14
#: Mark from which a document is kept.
LEAST = -0.04
SYMBOLS = "#*$%&|<>"
WINDOW = 3


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """How many words stand in a window of `width` words that is found twice or more; windows compare by 64-bit hash.

    The windows are sorted beside their places, so equal ones become neighbours; then the places of those with an
    equal neighbour, in order, each cover what the one before has left."""

    def marked(w: Column) -> Column:
        one = lambda i: F.struct(F.xxhash64(*(F.element_at(w, i + k) for k in range(width))).alias("h"), i.alias("i"))
        return F.transform(F.sequence(F.lit(1), F.size(w) - (width - 1)), one)

    def twice(s: Column) -> Column:
        equal = lambda x, k: (F.coalesce(F.try_element_at(s, k + 2)["h"] == x["h"], F.lit(False))) | ((k > 0) & (F.element_at(s, F.greatest(k, F.lit(1)))["h"] == x["h"]))
        return F.sort_array(F.transform(F.filter(s, equal), lambda x: x["i"]))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda i, k: F.when(k + 1 < F.size(at), F.least(F.coalesce(F.try_element_at(at, k + 2), i) - i, F.lit(width))).otherwise(width))
        return F.aggregate(steps, F.lit(0), lambda acc, x: acc + x)

    def found(m: Column) -> Column:
        alone = F.size(F.array_distinct(F.transform(m, lambda x: x["h"]))) == F.size(m)
        return F.when(alone, 0).otherwise(let(let(F.sort_array(m), twice), covered))

    return F.when(F.size(words) < width + 1, 0).otherwise(let(let(words, marked), found))


def counts(docs: DataFrame) -> DataFrame:
    """docs' id and text with words (array) and the base counts, as columns q_*."""
    text = F.coalesce("text", F.lit(""))
    has_word = r"[^\x20\x09-\x0D]"
    cut = docs.select("doc_id", whole_words(F.col("text")).alias("q_words"), (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).alias("q_symbols"), F.filter(F.split(text, "\n"), lambda x: x.rlike(has_word)).alias("q_lines"))
    return cut.select(
        "doc_id", "q_words", "q_symbols", F.size("q_words").alias("q_n"),
        F.length(F.array_join("q_words", "")).alias("q_chars"),
        (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).alias("q_dup_lines"),
        repeated_words(F.col("q_words")).alias("q_repeat"),
    )


def grams(words: Column, buckets: int) -> Column:
    """Buckets of the words and of the pairs of adjacent words (0-based)."""

    def of(w: Column) -> Column:
        single = F.transform(w, lambda x: F.pmod(F.xxhash64(x), F.lit(buckets)).cast("int"))
        pair = lambda i: F.pmod(F.xxhash64(F.element_at(w, i), F.element_at(w, i + 1)), F.lit(buckets)).cast("int")
        return F.when(F.size(w) < 2, single).otherwise(F.concat(single, F.transform(F.sequence(F.lit(1), F.size(w) - 1), pair)))

    return let(words, of)


def base_failed() -> Column:
    return (F.col("q_n") < 50) | (100 * F.col("q_repeat").cast("long") > 50 * F.col("q_n").cast("long"))


def trusted(words: Column, text: Column) -> Column:
    """The stated rule for target text: 50 words or more of usual length, no symbols, and not a few words over and over."""
    n = F.size(words)
    return (n >= 50) & (F.length(text) < 9 * n) & ~text.rlike(f"[{SYMBOLS}]") & (F.size(F.array_distinct(words)) > F.least(0.3 * n, F.lit(150)))


def gram_ratios(docs: DataFrame, buckets: int = BUCKETS) -> list[float]:
    """log(P(target) / P(raw)) of each bucket: buckets numbers, however large the corpus."""
    seen = docs.select("text", whole_words(F.col("text")).alias("q_words"))
    seen = seen.select(F.coalesce(trusted(F.col("q_words"), F.col("text")), F.lit(False)).alias("good"), grams(F.col("q_words"), buckets).alias("g"))
    # outer: a plain explode would have its size tested before the words are cut, which cuts them twice
    seen = seen.select("good", F.explode_outer("g").alias("b")).where("b is not null")
    seen = seen.groupBy("b").agg(F.count(F.lit(1)).alias("raw"), F.count_if("good").alias("target"))
    rows = F.broadcast(seen)  # at most `buckets` rows
    all_buckets = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("b")).join(rows, "b", "left").na.fill(0)
    sums = all_buckets.agg(F.sort_array(F.collect_list(F.struct("b", "raw", "target"))).alias("all"), F.sum("raw").alias("raw"), F.sum("target").alias("target"))  # one row of `buckets` entries
    ratio = lambda x: F.log((x["target"] + 1) / (F.col("target") + buckets)) - F.log((x["raw"] + 1) / (F.col("raw") + buckets))
    return sums.select(F.transform("all", ratio)).first()[0]


def assess(docs: DataFrame, buckets: int = BUCKETS, least: float = LEAST) -> DataFrame:
    """doc_id, the base counts, mark and kept of every row."""
    counted = counts(docs)
    ratios = gram_ratios(docs, buckets)
    table_of = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")  # a constant of `buckets` numbers
    total = F.aggregate(grams(F.col("q_words"), buckets), F.lit(0.0), lambda acc, b: acc + F.element_at(table_of, b + 1))
    mark = F.when(F.col("q_n") == 0, 0.0).otherwise(total / (2 * F.col("q_n") - 1))
    return counted.withColumn("mark", F.round(mark, 9)).select(
        "doc_id", F.col("q_n").cast("long").alias("n_words"), F.col("q_chars").cast("long").alias("word_chars"), F.col("q_symbols").cast("long").alias("n_symbols"),
        F.col("q_dup_lines").cast("long").alias("n_dup_lines"), F.col("q_repeat").cast("long").alias("n_repeat_words"),
        base_failed().alias("base_failed"), (~base_failed() & (F.col("mark") >= least)).alias("kept"), "mark",
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assess(table(spark, sf_dir, "documents"))
