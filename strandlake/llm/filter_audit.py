"""Filter interaction audit: what each filter of a chain removes, in every order, from tables of failing ids.

Every row of docs gets a row id of its own, so rows that share a doc_id are judged apart. Each filter has a stored table
of the ids that fail it (`failing`), and labels give id tables of good and of toxic rows (left-semi joins on doc_id).

`prefixes` then walks through the filters once. In its step for filter g every row is held beside itself with g put
before it, and a left-anti join with g's table takes away those copies that fail g. What is left for a set of filters
are the survivors of that prefix; beginning from the ids that fail f (left-semi) it leaves what f removes after that
prefix, and the good and toxic ones among them. So n filters take n left-anti joins for all 2^n prefixes, all on the
row id, which is unique: no key is hot. What a filter finds gone already (redundant) are its failing ids less those it
removes; what it alone removes comes after the prefix of all others. Only counts by (part, filter, prefix) leave the
joins, and the n! orders look their steps up in these.

Filter `repeats` fails a row whose text stands under a smaller doc_id: least ids by SHA-256 of the text. Texts that hold
more than one in HOT of all rows are at most HOT, and only those are broadcast; others join by hash of the text.

Null text counts as empty; a null source is the part named by the empty string; texts of any length are read whole. A
null doc_id is smaller than none and larger than none: such a row never repeats another and has no label. Equal rows
under one doc_id repeat nothing. A doc_id labelled more than once is good, or toxic, if any label says so. A part comes
with all its orders and steps, zeros included; an empty table has no part and gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, staged, table, whole_words

HOT = 1024
REPEATS = "E"


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions on one text, by letter."""
    few = lambda w: F.struct((F.size(w) < 200).alias("A"), (100 * F.size(F.array_distinct(w)) < 50 * F.size(w)).alias("B"))
    words = let(whole_words(text), few)
    return {"A": words["A"], "B": words["B"], "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 2 * F.length(text), "D": text.rlike("[#$%&*|]")}


def measured(docs: DataFrame, filters: dict[str, Column], part: str = "source") -> DataFrame:
    """(rid, doc_id, part, content, fails), written: the letters of the failed filters and a hash of the text for each row."""
    text = F.coalesce("text", F.lit(""))
    failed = F.concat(*(F.when(c, f).otherwise("") for f, c in filters.items()))
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.coalesce(F.col(part), F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("content"), failed.alias("fails"))
    return staged(rows, "audit-rows")


def repeating(rows: DataFrame, hot: int = HOT) -> DataFrame:
    """rid of the rows whose content stands under a smaller doc_id."""
    groups = staged(rows.groupBy("content").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count(F.lit(1)).alias("n")).where("least < most"), "audit-contents")
    limit = rows.count() // hot
    large = F.broadcast(groups.where(F.col("n") > limit))  # fewer than hot + 1 groups hold so many rows
    found = [rows.select("rid", "doc_id", "content").join(g, "content").where("doc_id > least").select("rid") for g in (large, groups.where(F.col("n") <= limit))]
    return found[0].unionByName(found[1])


def failing(rows: DataFrame, letters: list[str], repeats: str | None = REPEATS) -> dict[str, DataFrame]:
    """The stored table of failing ids (rid) of each filter."""
    tables = {f: staged(rows.where(F.col("fails").contains(f)).select("rid"), f"audit-fails-{f}") for f in letters}
    return tables | ({repeats: staged(repeating(rows), f"audit-fails-{repeats}")} if repeats else {})


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(rid, part, kind), written: every row as `all`, good ones as `good` and toxic ones as `toxic` once more."""
    of = lambda kind, which: rows.join(labels.where(which).select("doc_id"), "doc_id", "left_semi").select("rid", "part", F.lit(kind).alias("kind"))
    return staged(rows.select("rid", "part", F.lit("all").alias("kind")).unionByName(of("good", "quality = 1")).unionByName(of("toxic", "toxic = 1")), "audit-kinds")


def prefixes(kinds: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """(part, kind, filter, prefix, n): how many rows of a kind the filter removes after the filters of the prefix (their
    letters in order); where filter is empty, how many survive the prefix. Counts of zero have no row."""
    every = kinds.where("kind = 'all'").withColumn("filter", F.lit(""))
    rows = [every, *(kinds.join(ids, "rid", "left_semi").select(*kinds.columns, F.lit(f).alias("filter")) for f, ids in tables.items())]
    walk = reduce(DataFrame.unionByName, rows).withColumn("prefix", F.lit(0))
    for i, (f, ids) in enumerate(tables.items()):
        both = F.when(F.col("filter") == f, F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))
        walk = walk.withColumn("taken", F.explode(both)).withColumn("prefix", F.when(F.col("taken"), F.col("prefix") + (1 << i)).otherwise(F.col("prefix")))
        gone = ids.select(F.col("rid").alias("gone")).hint("shuffle_hash")
        walk = walk.join(gone, F.col("taken") & (F.col("rid") == F.col("gone")), "left_anti").drop("taken")
    counted = walk.groupBy("part", "kind", "filter", "prefix").agg(F.count(F.lit(1)).alias("n"))
    letters = F.concat(*(F.when(F.col("prefix").bitwiseAND(1 << i) > 0, f).otherwise("") for i, f in enumerate(tables)))
    return counted.withColumn("prefix", letters)


def orders(counts: DataFrame, letters: list[str]) -> DataFrame:
    """A row for each part, order of all filters and step of it. A part's counts, at most a few hundred, are one map."""
    key = F.concat_ws("/", "kind", "filter", "prefix")
    parts = staged(counts.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct(key, "n"))).alias("of")), "audit-counts")
    every = ",".join(map("".join, permutations(letters)))
    sorted_letters = lambda s: F.array_join(F.array_sort(F.split(s, "")), "")
    steps = parts.select("part", "of", F.explode(F.split(F.lit(every), ",")).alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step"))
    steps = steps.withColumns({"f": F.col("filter_order").substr(F.col("step"), F.lit(1)), "before": sorted_letters(F.col("filter_order").substr(F.lit(1), F.col("step") - 1)), "after": sorted_letters(F.col("filter_order").substr(F.lit(1), F.col("step")))})
    count = lambda kind, f, prefix: F.coalesce(F.try_element_at("of", F.concat_ws("/", F.lit(kind), f, prefix)), F.lit(0)).cast("long")
    f, none = F.col("f"), F.lit("")
    removed = count("all", f, F.col("before"))
    others = F.replace(F.lit("".join(sorted(letters))), f, none)
    # a prefix of p filters stands before f in p! (n - 1 - p)! orders
    weight = {p: factorial(p) * factorial(len(letters) - 1 - p) for p in range(len(letters))}
    subsets = F.array(*(F.lit("".join(sorted(x for i, x in enumerate(sorted(letters)) if m >> i & 1))) for m in range(1 << len(letters))))
    share = lambda s: F.when(F.contains(s, f), 0).otherwise(count("all", f, s) * F.element_at(F.array(*(F.lit(weight[p]) for p in sorted(weight))), F.least(F.length(s), F.lit(len(letters) - 1)) + 1))
    shapley = F.aggregate(F.transform(subsets, share), F.lit(0).cast("long"), lambda a, x: a + x)
    return steps.select(
        "part", "filter_order", "step", count("all", none, F.col("after")).alias("kept"), removed.alias("removed"), (count("all", f, none) - removed).alias("redundant"),
        count("all", f, others).alias("unique_fails"), count("good", f, F.col("before")).alias("good_lost"), count("toxic", f, F.col("before")).alias("toxic_lost"), shapley.alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Column], repeats: str | None = REPEATS, part: str = "source") -> DataFrame:
    """The audit of filters (letter: failure condition over a text without nulls, see text_filters) and, unless repeats is
    None, of the filter on repeated texts under that letter. Rows are as `orders` says; at most 6 filters."""
    letters = [*filters, *([repeats] if repeats else [])]
    if not 1 <= len(letters) <= 6 or any(len(f) != 1 for f in letters) or len(set(letters)) < len(letters):
        raise ValueError("1 to 6 filters, each named by its own letter")
    rows = measured(docs, filters, part)
    return orders(prefixes(labelled(rows, labels), failing(rows, list(filters), repeats)), letters)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), text_filters(F.coalesce("text", F.lit(""))))


SQL = r"""with w as (select doc_id, coalesce(source, '') part, coalesce(text, '') t, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') ws from documents),
  least as (select t, min(doc_id) d from w group by t),
  m as (select w.doc_id, part, cast(len(ws) < 200 as int) + 2 * cast(100 * len(list_distinct(ws)) < 50 * len(ws) as int) + 4 * cast(100 * len(regexp_extract_all(w.t, '[A-Z]')) > 2 * length(w.t) as int)
    + 8 * cast(regexp_matches(w.t, '[#$%&*|]') as int) + 16 * cast(coalesce(w.doc_id > least.d, false) as int) mask,
    cast(w.doc_id in (select doc_id from labels where quality = 1 and doc_id is not null) as int) good, cast(w.doc_id in (select doc_id from labels where toxic = 1 and doc_id is not null) as int) toxic from w join least on least.t = w.t),
  g as (select part, mask, count(*) n, sum(good) good, sum(toxic) toxic from m group by part, mask),
  l as (select unnest(['A', 'B', 'C', 'D', 'E']) x, unnest([1, 2, 4, 8, 16]) b),
  o as (select a.x || b.x || c.x || d.x || e.x filter_order, [a.b, b.b, c.b, d.b, e.b] bits from l a, l b, l c, l d, l e where a.b + b.b + c.b + d.b + e.b = 31 and a.b | b.b | c.b | d.b | e.b = 31),
  s as (select filter_order, step, bits[step] f, cast(list_sum(list_slice(bits, 1, step)) as int) after from o, range(1, 6) t(step)),
  r as (select part, filter_order, step, f, sum(n) filter (mask & after = 0) kept, sum(n) filter (mask & after = f) removed, sum(n) filter (mask & f = f and mask & after <> f) redundant, sum(n) filter (mask = f) unique_fails,
    sum(good) filter (mask & after = f) good_lost, sum(toxic) filter (mask & after = f) toxic_lost from g, s group by part, filter_order, step, f, after),
  v as (select part, f, sum(removed) shapley from r group by part, f)
  select r.part, filter_order, cast(step as integer) step, cast(coalesce(kept, 0) as bigint) kept, cast(coalesce(removed, 0) as bigint) removed, cast(coalesce(redundant, 0) as bigint) redundant, cast(coalesce(unique_fails, 0) as bigint) unique_fails,
  cast(coalesce(good_lost, 0) as bigint) good_lost, cast(coalesce(toxic_lost, 0) as bigint) toxic_lost, cast(coalesce(shapley, 0) as bigint) shapley from r join v on v.part = r.part and v.f = r.f"""
