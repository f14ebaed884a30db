"""Column functions over nucleotide strings. Counting is case-sensitive; null or empty sequences give 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: IUPAC codes and their complements.
IUPAC, COMPLEMENT = "ACGTURYSWKMBDHVNacgturyswkmbdhvn", "TGCAAYRSWMKVHDBNtgcaayrswmkvhdbn"


def _s(seq: Column) -> Column:
    return F.coalesce(seq, F.lit(""))


def _share(count: Column, seq: Column) -> Column:
    return F.when(F.length(_s(seq)) > 0, count.cast("double") / F.length(_s(seq))).otherwise(F.lit(0.0))


def _count_of(seq: Column, letters: str) -> Column:
    return (F.length(_s(seq)) - F.length(F.translate(_s(seq), letters, ""))).cast("long")


def complement(seq: Column) -> Column:
    return F.translate(seq, IUPAC, COMPLEMENT)


def reverse_complement(seq: Column) -> Column:
    return F.reverse(complement(seq))


def gc_content(seq: Column) -> Column:
    return _share(_count_of(seq, "GC"), seq)


def at_content(seq: Column) -> Column:
    return _share(_count_of(seq, "AT"), seq)


def t_count(seq: Column) -> Column:
    return _count_of(seq, "T")


def t_content(seq: Column) -> Column:
    return _share(t_count(seq), seq)


def cpg_count(seq: Column) -> Column:
    return F.regexp_count(_s(seq), F.lit("CG")).cast("long")


def cpg_content(seq: Column) -> Column:
    """CpG sites by the length of the sequence (not by its number of pairs)."""
    return _share(cpg_count(seq), seq)


def _longest(seq: Column, letters: str) -> Column:
    runs = F.transform(F.regexp_extract_all(_s(seq), F.lit(f"[{letters}]+"), F.lit(0)), F.length)
    return F.coalesce(F.array_max(runs), F.lit(0)).cast("long")


def longest_t_run(seq: Column) -> Column:
    return _longest(seq, "T")


def longest_at_run(seq: Column) -> Column:
    return _longest(seq, "AT")


def valid_alphabet(seq: Column) -> Column:
    return _s(seq).rlike("^[ACGTUN]*$")


#: Feature functions by the names they have in results.
FEATURES = {
    "GC_content": gc_content, "AT_content": at_content, "T_count": t_count, "T_content": t_content, "CpG_count": cpg_count,
    "CpG_content": cpg_content, "longest_T_run": longest_t_run, "longest_AT_run": longest_at_run,
}


def feature_columns(seq: Column, names: list[str] | None = None) -> list[Column]:
    """The named features (all by default); an unknown name is an error."""
    names = list(FEATURES) if names is None else names
    if unknown := [n for n in names if n not in FEATURES]:
        raise ValueError(f"unknown features: {unknown}")
    return [FEATURES[n](seq).alias(n) for n in names]


def compress_homopolymers(seq: Column) -> Column:
    return F.regexp_replace(seq, r"(.)\1+", "$1")


def two_bit(kmer: Column) -> Column:
    """The code of a k-mer over ACGT with k <= 31, two bits a base."""
    return F.conv(F.translate(kmer, "ACGT", "0123"), 4, 10).cast("long")


def from_two_bit(code: Column, k: int) -> Column:
    """The k-mer of a code, four bases at a time."""
    fours = F.array(*(F.lit("".join("ACGT"[v >> s & 3] for s in (6, 4, 2, 0))) for v in range(256)))
    parts = [F.element_at(fours, F.shiftright(code, 2 * at).bitwiseAND(255).cast("int") + 1) for at in range(0, k, 4)]
    if k % 4:
        parts[-1] = F.substring(parts[-1], 5 - k % 4, k % 4)
    return F.concat(*reversed(parts))


def two_bit_mismatches(a: Column, b: Column) -> Column:
    """Positions in which two codes of equal length differ."""
    x = a.bitwiseXOR(b)
    return F.bit_count(x.bitwiseOR(F.shiftright(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))


def mismatches(a: Column, b: Column) -> Column:
    """Positions in which two strings of equal length differ, for any k and alphabet."""
    return F.aggregate(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x != y).cast("int")), F.lit(0), lambda acc, x: acc + x)


def window_starts(length: Column, k: int) -> Column:
    """0-based starts of all windows of k; none where the length is under k (sequence would run backwards)."""
    return F.when(length >= k, F.sequence(F.lit(0), length - k)).otherwise(F.array().cast("array<int>"))


def locus_id(chrom: Column, start: Column, end: Column, strand: Column) -> Column:
    return F.format_string("%s:%d-%d,%s", chrom, start, end, strand)


def transcript_site_id(transcript: Column, t_start: Column, t_end: Column) -> Column:
    return F.format_string("%s:%d-%d", transcript, t_start, t_end)


def site_id(prefix: Column, name: Column, region: str, ordinal: Column) -> Column:
    """PREFIX-name-Region-S00001: five digits at least, spaces of the name as underscores."""
    return numbered_id(site_id_stem(prefix, name, region), ordinal)


def site_id_stem(prefix: Column, name: Column, region: str) -> Column:
    """The part of its sites' ids that a gene has once."""
    return F.concat_ws("-", prefix, F.replace(name, F.lit(" "), F.lit("_")), F.lit(region), F.lit("S"))


def numbered_id(stem: Column, ordinal: Column) -> Column:
    digits = ordinal.cast("string")
    # 100,000 and a number of up to five digits are those five, behind a 1
    padded = F.when(ordinal.between(0, 99_999), F.substring((ordinal + 100_000).cast("string"), 2, 5)).otherwise(F.lpad(digits, F.greatest(F.lit(5), F.length(digits)), F.lit("0")))
    return F.concat(stem, padded)


def target_key(target_id: Column, target_name: Column) -> Column:
    """The first that isn't empty."""
    return F.coalesce(F.nullif(target_id, F.lit("")), F.nullif(target_name, F.lit("")))
