r"""Secret scans: patterns for known forms, and a battery of randomness tests for the rest.

Candidates are runs of 20 or more characters of one inferred encoding (hex, base32, or base64 with its URL form) that
overlap no span of a known form. Each symbol gets its value in the encoding's alphabet of K symbols; then
  - chi-squared over 7 groups of the alphabet against what K symbols give each (6 degrees of freedom),
  - the runs test on values above and below the middle of the alphabet,
  - the lag-one serial correlation of the values
each give a p-value under "all symbols are drawn at random", and Fisher's method makes one of the three.

Random strings have uniform p; words have p near 0 with a thin tail. In each class of lengths (short strings tell
less, so they are judged among themselves) the share of truly random candidates is read off the upper half of the
p-values, where few words reach, and the threshold is the least p above which the expected share of words is at most
`rate`: false-discovery control that knows lengths. The corpus-wide histogram that this needs has 4 classes of 50 bins.

Where a class of lengths has no candidates, or only ones that words explain, nothing is added in it; a lone key is found
only if its p falls where few words' do.

Null and empty texts have no spans; texts of any length are read whole; tokens of equal length class and p are decided
alike. Repeated rows count and come out as often as they stand; an empty table gives an empty result. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, located, running_totals, table

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A run that is too short fails whole, so the least length can stand in the pattern.
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "(?<![0-9a-f])[0-9a-f]{32,}"
CANDIDATE = "(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Lengths at which a new class begins.
CLASSES = (20, 28, 40, 64)
BINS = 50
GROUPS = 7
SPAN = "array<struct<start:int,end:int,rank:int,kind:string,p:double>>"


def _spans(found: Column, kind: str) -> Column:
    rank = KINDS.index(kind)
    return F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), F.lit(None).cast("double").alias("p")))


def known_spans(text: Column) -> Column:
    """Spans of the known forms, by start and then kind."""
    text, none = F.coalesce(text, F.lit("")), F.array().cast(SPAN)
    assign = F.filter(located(text, ASSIGN), lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 1)) >= 8)
    parts = [
        F.when(text.rlike("[:=]"), _spans(assign, "assign")).otherwise(none),
        F.when(F.contains(text, F.lit("AKIA")), _spans(located(text, ACCESS), "access")).otherwise(none),
        F.when(text.rlike("[0-9a-f]{32}"), _spans(located(text, HEX), "hex")).otherwise(none),
    ]
    return F.sort_array(F.concat(*parts))


def upper_tail(x: Column, df: int) -> Column:
    """P(chi-squared with an even number of degrees of freedom > x): a finite sum."""

    def tail(half: Column) -> Column:
        term, total = F.lit(1.0), F.lit(1.0)
        for k in range(1, df // 2):
            term = term * half / k
            total = total + term
        return F.least(F.exp(-half) * total, F.lit(1.0))

    return let(x / 2, tail)  # x is a long expression


def two_sided(z: Column) -> Column:
    """P(|normal| > |z|), by the logistic approximation (error below 2e-4)."""
    return let(F.abs(z), lambda a: F.least(2 / (1 + F.exp(F.least(1.5976 * a + 0.070566 * a * a * a, F.lit(700.0)))), F.lit(1.0)))


def _battery(values: Column, size: Column) -> Column:
    """Fisher's combination of the three p-values for values in 0 .. size - 1."""
    n = F.size(values).cast("double")
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)
    group = lambda x: F.floor(x * GROUPS / size)
    # group g holds the values v with g <= GROUPS * v / size < g + 1
    share = lambda g: (F.ceil((g + 1) * size / GROUPS) - F.ceil(g * size / GROUPS)) / size
    here = lambda g: F.size(F.filter(values, lambda x: group(x) == g)).cast("double")
    off = lambda g: let(n * share(g), lambda due: let(here(g) - due, lambda d: d * d / due))
    chi = total(F.transform(F.sequence(F.lit(0), F.lit(GROUPS - 1)), off))
    runs = let(F.transform(values, lambda x: (2 * x >= size).cast("int")), _runs)
    serial = let(total(F.transform(values, lambda x: x.cast("double"))) / n, lambda mean: let(F.transform(values, lambda x: x - mean), _serial))
    log = lambda p: F.log(F.greatest(p, F.lit(1e-300)))
    return upper_tail(-2 * (log(upper_tail(chi, GROUPS - 1)) + log(runs) + log(serial)), 6)


def _runs(high: Column) -> Column:
    n = F.size(high)
    ups = F.aggregate(high, F.lit(0), lambda acc, x: acc + x).cast("double")
    changes = F.size(F.filter(F.sequence(F.lit(1), n - 1), lambda i: F.element_at(high, i) != F.element_at(high, i + 1)))

    def test(u: Column) -> Column:
        m = n.cast("double")
        mean = 1 + 2 * u * (m - u) / m
        var = (mean - 1) * (mean - 2) / (m - 1)
        return F.when(var <= 0, 0.0).otherwise(two_sided((changes + 1 - mean) / F.sqrt(F.when(var > 0, var).otherwise(1.0))))

    return let(ups, test)


def _serial(dev: Column) -> Column:
    n = F.size(dev)
    sum_of = lambda a: F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)
    square = sum_of(F.transform(dev, lambda x: x * x))
    lagged = sum_of(F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.element_at(dev, i) * F.element_at(dev, i + 1)))
    # under randomness the lag-one correlation has mean -1 / n and variance near 1 / n
    return let(square, lambda s: F.when(s <= 0, 0.0).otherwise(two_sided((lagged / F.when(s > 0, s).otherwise(1.0) + 1.0 / n) * F.sqrt(n.cast("double")))))


def randomness(token: Column) -> Column:
    """p-value of a token under its inferred encoding; 0 where it has none (fewer than two kinds of characters)."""
    mixed = token.rlike("[0-9]") & token.rlike("[A-Za-z]") | token.rlike("[a-z]") & token.rlike("[A-Z]")
    alphabet = F.when(token.rlike("^[0-9a-f]+$"), "0123456789abcdef").when(token.rlike("^[0-9A-F]+$"), "0123456789ABCDEF").when(token.rlike("^[A-Z2-7]+$"), BASE32).otherwise(BASE64)

    def of(a: Column) -> Column:
        plain = F.translate(token, "-_", "+/")
        values = F.transform(F.filter(F.split(plain, ""), lambda c: c != ""), lambda c: F.instr(a, c) - 1)
        return let(values, lambda v: _battery(v, F.length(a)))

    return F.when(mixed, let(alphabet, of)).otherwise(0.0)


def candidate_spans(text: Column, known: Column) -> Column:
    """Candidates outside the known spans, with their p."""
    text, none = F.coalesce(text, F.lit("")), F.array().cast(SPAN)
    apart = lambda s: ~F.exists(known, lambda k: (k["start"] < s["end"]) & (s["start"] < k["end"]))
    rank = KINDS.index("random")
    judged = F.transform(F.filter(located(text, CANDIDATE), apart), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(rank).alias("rank"), F.lit("random").alias("kind"), randomness(s["match"]).alias("p")))
    return F.when(text.rlike("[A-Za-z0-9+/_-]{20}"), judged).otherwise(none)


def _class(s: Column) -> Column:
    n = s["end"] - s["start"]
    return sum(((n >= c).cast("int") for c in CLASSES), F.lit(-1))


def thresholds(docs: DataFrame, rate: float = 0.1) -> list[float]:
    """For each class of lengths the p from which a candidate counts as random; 2.0 (never) where no p will do."""
    found = docs.select(known_spans(F.col("text")).alias("known"), "text").select(candidate_spans(F.col("text"), F.col("known")).alias("c"))
    bins = found.select(F.explode_outer("c").alias("s")).where("s is not null").groupBy(_class(F.col("s")).alias("k"), F.least(F.floor(F.col("s.p") * BINS), F.lit(BINS - 1)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    best = [2.0] * len(CLASSES)
    counts = [[0] * BINS for _ in CLASSES]
    for r in bins.collect():  # at most len(CLASSES) * BINS rows
        counts[r.k][r.bin] = r.n
    for k, row in enumerate(counts):
        per_bin = 2 * sum(row[BINS // 2 :]) / BINS
        for b in range(BINS - 1, 0, -1):
            above = sum(row[b:])
            if above and max(0.0, above - per_bin * (BINS - b)) <= rate * above:
                best[k] = b / BINS
    return best


def secret_spans(docs: DataFrame, rate: float = 0.1) -> tuple[Column, Column]:
    """Expressions over a text column: the known spans, and all spans by start and then kind."""
    limits = F.array(*map(F.lit, thresholds(docs, rate)))
    known = known_spans(F.col("text"))

    def with_random(k: Column) -> Column:
        passed = F.filter(candidate_spans(F.col("text"), k), lambda s: s["p"] >= F.element_at(limits, _class(s) + 1))
        return F.sort_array(F.concat(k, passed))

    return known, let(known, with_random)


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, mask: str = "[SECRET]", rate: float = 0.1) -> DataFrame:
    """docs with every secret span of text replaced by mask; n_chars, where there is one, follows."""
    _, spans = secret_spans(docs, rate)
    text = F.coalesce("text", F.lit(""))

    # spans of several kinds may overlap: a masked stretch lasts from where the first opens to where all have closed
    edge = lambda name, step: F.transform("redact_s", lambda x: F.struct(x[name].alias("at"), F.lit(-step).alias("order"), F.lit(step).alias("step")))
    opened = running_totals(F.transform("redact_e", lambda x: x["step"]))
    state = F.zip_with("redact_e", opened, lambda x, n: F.struct(x["at"].alias("at"), x["step"].alias("step"), n.alias("n")))
    where = lambda n, step: F.transform(F.filter("redact_e", lambda x: (x["n"] == n) & (x["step"] == step)), lambda x: x["at"])

    def piece(x: Column, i: Column) -> Column:
        until = F.when(i == 0, 0).otherwise(F.element_at("redact_r", F.greatest(i, F.lit(1)))["e"])
        return F.concat(F.substring(text, until + 1, x["b"] - until), F.lit(mask))

    tail = F.substring(text, F.element_at("redact_r", -1)["e"] + 1, F.length(text))
    rebuilt = F.when(F.size("redact_s") == 0, F.col("text")).otherwise(F.concat(F.array_join(F.transform("redact_r", piece), ""), tail))
    marked = docs.withColumn("redact_s", spans).withColumn("redact_e", F.array_sort(F.concat(edge("start", 1), edge("end", -1)))).withColumn("redact_e", state)
    changed = marked.withColumn("redact_r", F.arrays_zip(where(1, 1).alias("b"), where(0, -1).alias("e"))).withColumn("text", rebuilt).select(*docs.columns)
    return changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else changed


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    known, spans = secret_spans(docs)
    found = docs.select("doc_id", known.alias("base"), spans.alias("s"))
    count = lambda rank: F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")
    return found.select("doc_id", *(count(k).alias(f"n_{KINDS[k]}") for k in range(3)), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("s")).alias("spans"))
