"""Personal data: regular expressions propose spans, checksums confirm them, nearby words adjust the score.

pii_spans(text) is a plain Column expression, so it works on any frame and stays in the JVM. Every span has a kind, a
start and an end (code points, end exclusive) and a score. The base kinds email, ip, card and phone always stay; iban
(as long as its country says, confirmed by mod 97) and account (13 to 15 digits that pass Luhn) are added where their
score reaches LEAST, which for account takes a context word: a whole word within REACH characters on either side.

Null and empty texts have no spans. Texts of any length are read whole; what stands near a span is looked for in the block
of BLOCK characters that it begins and ends in, so a span costs no more in a long text.
Spans of several kinds over one place all stay; within a kind the leftmost wins. Repeated rows give repeated results, an
empty table an empty one. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, located, table

KINDS = ("email", "ip", "card", "phone", "iban", "account")
#: Score from which an added span is given.
LEAST = 0.6
#: Code points on either side of a span that are searched for context words.
REACH = 48
BLOCK = 512

# Possessive quantifiers and looks behind only keep long runs from being tried at each of their characters: a match
# always starts at the left end of its run, or where the match before it ended (\G).
_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
#: A whole run of digits with single separators that has 16 to 19 digits (13 to 15 for the added kind).
_RUN = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){%s}(?![\x20-]?[0-9])"
CARD, ACCOUNT = _RUN % "15,18", _RUN % "12,14"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: The length of a bank account number by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FO FI GL NL FK SD", 19: "MK SI", 20: "AT BA EE KZ XK LT LU MN", 21: "HR LV LI CH",
    22: "BH BG CR GE DE IE ME RS GB VA", 23: "GI IQ IL TL AE SO OM", 24: "AD CZ MD PK RO SA SK ES SE TN VG", 25: "PT ST LY",
    26: "IS TR", 27: "FR GR IT MC MR SM BI DJ", 28: "AL AZ BY CY DO GT HU LB PL SV NI", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
IBAN = (
    r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2})(?:"
    + "|".join(rf"(?:{names.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, names in IBAN_LENGTHS.items())
    + ")(?![A-Za-z0-9])"
)

#: Words that speak for a kind when they stand near a span.
CONTEXT = {
    "email": "e?-?mail|contact|write|address",
    "ip": "ip|host|server|address|login",
    "card": "cards?|visa|mastercard|amex|credit|debit|payment|karte|carte|tarjeta",
    "phone": "phone|call|tel|mobile|fax|cell|whatsapp|telefon",
    "iban": "iban|bank|account|konto|compte|cuenta|transfer",
    "account": "cards?|amex|accounts?|credit|payment|bank",
}
#: Score before context; a context word adds BOOST.
PRIOR = {"email": 0.8, "ip": 0.5, "card": 0.75, "phone": 0.5, "iban": 0.75, "account": 0.4}
BOOST = 0.2


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""

    def add(d: Column) -> Column:
        def one(acc: Column, i: Column) -> Column:
            x = F.substring(d, F.length(d) - i, F.lit(1)).cast("int")
            return acc + F.when(i % 2 == 0, x).when(x > 4, 2 * x - 9).otherwise(2 * x)

        return F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), one) % 10 == 0

    return (F.length(number) > 0) & let(number, add)


def mod97(code: Column) -> Column:
    """Whether a bank account number passes ISO 7064 mod 97-10: letters count 10 to 35, the first four come last."""

    def of(s: Column) -> Column:
        moved = F.concat(F.substring(s, F.lit(5), F.length(s)), F.substring(s, 1, 4))

        def step(acc: Column, i: Column) -> Column:
            x = F.ascii(F.substring(moved, i, F.lit(1)))
            return F.when(x >= 65, acc * 100 + x - 55).otherwise(acc * 10 + x - 48) % 97

        return F.aggregate(F.sequence(F.lit(1), F.length(s)), F.lit(0), step) == 1

    return let(F.regexp_replace(code, " ", ""), of)


def _octets(s: Column) -> Column:
    """Whether no part of a dotted number exceeds 255."""
    return F.forall(F.split(s, r"\."), lambda p: let(F.regexp_replace(p, "^0+(?=[0-9])", ""), lambda q: (F.length(q) < 4) & (F.when(F.length(q) < 4, q.cast("int")).otherwise(999) <= 255)))


def pii_spans(text: Column) -> Column:
    """array<struct<rank,kind,start,end,score>> of all spans, by kind as in KINDS and then by start."""
    empty = F.array().cast("array<struct<rank:int,kind:string,start:int,end:int,score:double>>")
    text = F.coalesce(text, F.lit(""))

    def within(blocks: Column, at: Column, n: Column) -> Column:
        """n <= REACH characters of the text from 0-based place at."""
        b = F.floor(at / BLOCK).cast("int")
        two = F.concat(F.coalesce(F.try_element_at(blocks, b + 1), F.lit("")), F.coalesce(F.try_element_at(blocks, b + 2), F.lit("")))
        return F.substring(two, at - b * BLOCK + 1, n)

    def of(kind: str, here: Column, pattern: str, valid, least: float = 0.0) -> Column:
        def scored(s: Column, blocks: Column) -> Column:
            before = within(blocks, F.greatest(s["start"] - REACH, F.lit(0)), F.least(s["start"], F.lit(REACH)))
            near = F.lower(F.concat(before, F.lit(" | "), within(blocks, s["end"], F.lit(REACH))))
            score = F.lit(PRIOR[kind]) + F.when(near.rlike(rf"(?<![\p{{L}}\p{{N}}])(?:{CONTEXT[kind]})(?![\p{{L}}\p{{N}}])"), BOOST).otherwise(0.0)
            return F.struct(F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), score.alias("score"))

        proposed = F.filter(located(text, pattern), lambda s: valid(s["match"]))
        found = let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)), lambda blocks: F.transform(proposed, lambda s: scored(s, blocks)))
        return F.when(here, F.filter(found, lambda s: s["score"] >= least) if least else found).otherwise(empty)

    always = lambda m: F.lit(True)
    parts = [
        of("email", F.contains(text, F.lit("@")), EMAIL, always),
        of("ip", text.rlike(r"[0-9]\.[0-9]"), IP, _octets),
        of("card", text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"), CARD, lambda m: luhn(digits(m))),
        of("phone", F.contains(text, F.lit("+")), PHONE, lambda m: F.length(digits(m)).between(8, 15)),
        of("iban", text.rlike(r"[A-Z]{2}[0-9]{2}"), IBAN, mod97, LEAST),
        of("account", text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"), ACCOUNT, lambda m: luhn(digits(m)), LEAST),
    ]
    return F.concat(*parts)


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "documents").select("doc_id", pii_spans(F.col("text")).alias("s"))
    count = lambda rank: F.size(F.filter("s", lambda s: s["rank"] == rank)).cast("long")
    counts = [count(k).alias(f"n_{KINDS[k]}") for k in range(4)]
    base = F.filter("s", lambda s: s["rank"] < 4)
    top = F.round(F.array_max(F.transform("s", lambda s: s["score"])), 3).alias("max_score")
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("s")).alias("spans"), top)

