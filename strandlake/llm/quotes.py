"""Chat formatting by quotation linking.

Lines that begin with > are quoted; the number of > is the level, and adjacent lines of one level are a passage.
Passages, and their lines of LEAST characters or more, are normalised (lower case, white space to one space) and hashed.
A quote's original is the earliest message of the conversation with that text of its own (by 64-bit hash and length), as a
whole message, a paragraph or a line, if it stands before the quoting message. A message replies to the original of its
outermost linked level (of several there the one with most quoted characters, then the latest). thread_root is where its
chain of replies begins, depth how long the chain is, position its place in the thread: (conv_id, thread_root, position)
is reply order, in which no reply precedes what it answers. text is what the message says itself: quotes, and the lines
that announce them just above, are gone; line ends are \n, white space at the ends of lines goes.

build_conversations makes role-tagged texts of that, as records of at most PART messages of a thread, so that a thread of
any length is many records and no group is collected whole.

Every distinct own text of a conversation is one row before quotes join it, so a phrase that thousands of messages
repeat stays one candidate; positions are counted by bins of turns, so a conversation that holds a third of all messages
is many tasks' work. Null and empty texts are empty messages, texts of any length are read whole; messages with null
conv_id or turn link to nothing and have no position. Repeated rows come out as often as they stand, side by side. An
empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import let, restaged, staged, table

#: Characters from which a single line is evidence.
LEAST = 20
#: Turns that are counted together, and messages of a record.
BIN, PART = 1024, 256
_MARKS = r"^((?:[ \t]*>)+)"
#: How a line begins and which verb it has that announces the quote below it.
_ANNOUNCES = r"(?i)^\s*(?:on|am|le|el)\b.*\b(?:wrote|schrieb|écrit|escribió)\b.*:\s*$"


def normal(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def parsed_lines(text: Column) -> Column:
    """array<struct<level,body>> of the lines of a message."""

    def line(x: Column) -> Column:
        return let(F.regexp_extract(x, _MARKS, 1), lambda m: F.struct(F.length(F.regexp_replace(m, "[^>]", "")).alias("level"), F.rtrim(F.when(F.length(m) == 0, x).otherwise(F.ltrim(F.substring(x, F.length(m) + 1, F.length(x))))).alias("body")))

    return F.transform(F.split(F.coalesce(text, F.lit("")), "\r?\n"), line)


def passages(lines: Column) -> Column:
    """array<struct<level,body>>: adjacent lines of one level joined; blank lines cut level 0 into paragraphs."""

    def begins(a: Column) -> Column:
        blank = lambda x: (x["level"] == 0) & (x["body"] == "")
        new = lambda i: (i == 1) | (F.element_at(a, i)["level"] != F.element_at(a, F.greatest(i - 1, F.lit(1)))["level"]) | blank(F.element_at(a, F.greatest(i - 1, F.lit(1))))
        return F.filter(F.sequence(F.lit(1), F.size(a)), new)

    def joined(a: Column) -> Column:
        def piece(b: Column) -> Column:
            stop = lambda k: F.when(k + 1 < F.size(b), F.coalesce(F.try_element_at(b, k + 2), F.lit(1))).otherwise(F.size(a) + 1)
            return F.transform(b, lambda i, k: F.struct(F.element_at(a, i)["level"].alias("level"), F.array_join(F.transform(F.slice(a, i, stop(k) - i), lambda x: x["body"]), "\n").alias("body")))

        return let(begins(a), piece)

    none = F.array().cast("array<struct<level:int,body:string>>")
    return let(lines, lambda a: F.when(F.size(a) == 0, none).otherwise(joined(a)))


def _keys(of: Column) -> Column:
    """array<struct<level,h,chars>> of passages and of their longer lines."""
    key = lambda level, body: let(normal(body), lambda n: F.struct(level.alias("level"), F.xxhash64(n).alias("h"), F.length(n).alias("chars")))
    whole = F.transform(of, lambda p: key(p["level"], p["body"]))
    single = F.flatten(F.transform(of, lambda p: F.transform(F.filter(F.split(p["body"], "\n"), lambda x: F.length(normal(x)) >= LEAST), lambda x: key(p["level"], x))))
    return F.array_distinct(F.filter(F.concat(whole, single), lambda k: k["chars"] > 0))


def link_quotes(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, reply_to, thread_root, depth, position, n_quotes and n_linked of every message."""
    cut = messages.select("conv_id", "turn", "role", parsed_lines(F.col("text")).alias("lines"), F.col("text").contains(">").alias("may"))
    at = lambda i: F.try_element_at("lines", i)
    quoted_next = lambda i: F.coalesce((at(i + 2)["level"] > 0) | ((at(i + 2)["body"] == "") & (at(i + 3)["level"] > 0)), F.lit(False))
    own_lines = F.filter("lines", lambda x, i: (x["level"] == 0) & ~(F.col("may") & quoted_next(i) & x["body"].rlike(_ANNOUNCES)))
    own = F.regexp_replace(F.array_join(F.transform(own_lines, lambda x: x["body"]), "\n"), r"^\s+|\s+$", "")
    quoted = F.when(F.exists("lines", lambda x: x["level"] > 0), F.filter(passages(F.col("lines")), lambda p: p["level"] > 0)).otherwise(F.array().cast("array<struct<level:int,body:string>>"))
    read = cut.select("conv_id", "turn", "role", own.alias("text"), quoted.alias("quoted"), F.filter(passages(own_lines), lambda p: p["body"] != "").alias("own"))

    quotes = read.where(F.size("quoted") > 0).select("conv_id", "turn", F.explode(_keys(F.col("quoted"))).alias("q")).select("conv_id", "turn", "q.*")
    quotes = staged(quotes.where("conv_id is not null and turn is not null"), "quotes")
    whole = let(normal(F.col("text")), lambda n: F.struct(F.lit(0).alias("level"), F.xxhash64(n).alias("h"), F.length(n).alias("chars")))
    named = read.select("conv_id", "turn", F.explode_outer(F.concat(F.array(whole), _keys(F.col("own")))).alias("o")).select("conv_id", "turn", "o.h", "o.chars")
    key = ["conv_id", "h", "chars"]
    originals = named.join(quotes.select(*key).distinct(), key, "left_semi").groupBy(*key).agg(F.min("turn").alias("origin"))
    linked = quotes.join(originals, key).where("origin < turn")
    by_origin = linked.groupBy("conv_id", "turn", "level", "origin").agg(F.sum("chars").alias("chars"))
    best = by_origin.groupBy("conv_id", "turn").agg(F.max(F.struct(-F.col("level"), "chars", "origin"))["origin"].alias("reply_to"), F.count(F.lit(1)).alias("n_linked"))
    chains = thread_roots(best)
    found = read.join(chains, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", "text", "reply_to", F.coalesce("thread_root", "turn").alias("thread_root"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        F.size("quoted").cast("long").alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
    )
    return positioned(found)


def positioned(messages: DataFrame) -> DataFrame:
    """The messages with position, the 0-based place of each in its thread by turn."""
    known = (F.col("conv_id").isNotNull() & F.col("turn").isNotNull()).alias("known")
    binned = messages.select("*", known, F.floor(F.col("turn") / BIN).alias("bin"))
    thread = ["conv_id", "thread_root"]
    sizes = binned.where("known").groupBy(*thread, "bin").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy(*thread).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(*thread, "bin", F.coalesce(before, F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy(*thread, "bin").orderBy("turn", "role", "text"))
    placed = binned.where("known").withColumn("within", within).join(sizes, [*thread, "bin"]).select(*messages.columns, (F.col("before") + F.col("within") - 1).alias("position"))
    return placed.unionByName(binned.where("not known").select(*messages.columns, F.lit(None).cast("long").alias("position")))


def build_conversations(linked: DataFrame, part: int = PART) -> DataFrame:
    """conv_id, thread_root, part, n_messages, turns, replies (what each turn answers, or null), n_quotes, n_linked and text: the
    messages of a thread in reply order without their quotes, each under its role, at most `part` in a record. A message
    without a position (no conv_id or no turn) is a record of its own, without a part."""
    tagged = F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), "text")
    message = F.struct("position", tagged.alias("t"), "turn", "reply_to")
    rows = linked.where("position is not null").select("conv_id", "thread_root", F.floor(F.col("position") / part).alias("part"), message.alias("m"), "n_quotes", "n_linked")
    each = lambda name: F.transform("all", lambda x: x[name])
    sums = [F.count(F.lit(1)).alias("n_messages"), F.sum("n_quotes").alias("n_quotes"), F.sum("n_linked").alias("n_linked"), F.sort_array(F.collect_list("m")).alias("all")]
    whole = rows.groupBy("conv_id", "thread_root", "part").agg(*sums)
    columns = ["conv_id", "thread_root", "part", "n_messages", each("turn").alias("turns"), each("reply_to").alias("replies"), "n_quotes", "n_linked", F.array_join(each("t"), "\n").alias("text")]
    alone = linked.where("position is null").select("conv_id", "thread_root", F.lit(None).cast("long").alias("part"), F.lit(1).cast("long").alias("n_messages"), F.array(message).alias("all"), "n_quotes", "n_linked")
    return whole.select(columns).unionByName(alone.select(columns))


def thread_roots(replies: DataFrame) -> DataFrame:
    """thread_root and depth for (conv_id, turn, reply_to): chains halve in each round, as replies point backwards."""
    now, path = restaged(replies.select("conv_id", "turn", "reply_to", "n_linked", F.col("reply_to").alias("thread_root"), F.lit(1).alias("depth")), "threads")
    while True:
        up = now.select("conv_id", F.col("turn").alias("thread_root"), F.col("thread_root").alias("next"), F.col("depth").alias("more"))
        stepped = now.join(up, ["conv_id", "thread_root"], "left").select("conv_id", "turn", "reply_to", "n_linked", F.coalesce("next", "thread_root").alias("thread_root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("next").isNotNull().alias("moved"))
        now, path = restaged(stepped, "threads", path)
        if now.where("moved").isEmpty():
            return now.drop("moved")
        now = now.drop("moved")


def op5_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_conversations(link_quotes(table(spark, sf_dir, "conversations")))
