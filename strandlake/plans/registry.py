"""Queries over the given tables, one or more for each operator, and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.functions import sequence as fs
from strandlake.operators import analysis, genome, joins, kmers, offtargets, reads, sites
from strandlake.operators.algebra import Kmers, evaluate, evaluate_all
from strandlake.sources import readers, writers
from strandlake.sources.kmer_tables import Settings, counted_table
from strandlake.sources.scratch import new_path, staged, write_outputs

from . import derived as v
from .derived import TILE, sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
#: The prefix of site ids in all queries.
PREFIX = "SL"


def query(statement: str | None):  # noqa: ANN201
    def add(f: Callable[[SparkSession, str], DataFrame]):  # noqa: ANN202
        QUERIES[f.__name__] = f
        if statement:
            ORACLE_SQL[f.__name__] = statement
        return f

    return add


def _rc(x: str) -> str:
    return f"translate(reverse({x}), 'ACGT', 'TGCA')"


def _turned(x: str) -> str:
    return f"case when strand = '-' then {_rc(x)} else {x} end"


def _id(name: str, region: str, ordinal: str) -> str:
    return f"""concat('{PREFIX}-', replace({name}, ' ', '_'), '-{region}-S', lpad(cast({ordinal} as varchar), cast(greatest(5, length(cast({ordinal} as varchar))) as integer), '0'))"""


# features

_FEATURES = """cast(length(s) - length(translate(s, 'GC', '')) as double) / length(s) "GC_content", cast(length(s) - length(translate(s, 'AT', '')) as double) / length(s) "AT_content",
  cast(length(s) - length(replace(s, 'T', '')) as bigint) "T_count", cast(length(s) - length(replace(s, 'T', '')) as double) / length(s) "T_content",
  cast(len(regexp_extract_all(s, 'CG')) as bigint) "CpG_count", cast(len(regexp_extract_all(s, 'CG')) as double) / length(s) "CpG_content",
  cast(coalesce(list_max(list_transform(regexp_extract_all(s, 'T+'), lambda x: length(x))), 0) as bigint) "longest_T_run",
  cast(coalesce(list_max(list_transform(regexp_extract_all(s, '[AT]+'), lambda x: length(x))), 0) as bigint) "longest_AT_run\""""


@query(sql(f"select seq_id, {_FEATURES} from (select seq_id, sequence s from seqs)", "seqs"))
def sequence_features(spark, d):
    return v.seqs(spark, d).select("seq_id", *fs.feature_columns(F.col("sequence")))


@query(sql("""select seq_id, cast(length(sequence) - length(translate(sequence, 'GC', '')) as double) / length(sequence) "GC_content", cast(len(regexp_extract_all(sequence, 'CG')) as bigint) "CpG_count" from seqs""", "seqs"))
def selected_features(spark, d):
    return v.seqs(spark, d).select("seq_id", *fs.feature_columns(F.col("sequence"), ["GC_content", "CpG_count"]))


@query(sql(f"""select seq_id, translate(sequence, 'ACGT', 'TGCA') complement, {_rc('sequence')} reverse_complement, regexp_full_match(sequence, '[ACGTUN]*') valid, cast(length(sequence) as bigint) n
  from seqs""", "seqs"))
def complements(spark, d):
    s = F.col("sequence")
    return v.seqs(spark, d).select("seq_id", fs.complement(s).alias("complement"), fs.reverse_complement(s).alias("reverse_complement"), fs.valid_alphabet(s).alias("valid"), F.length(s).cast("long").alias("n"))


# genes, loci and sites

_PRE = {"pre": f"""select g.gene_id, g.gene_name, g.chr, g.strand, g_start + o w_start, g_start + o + {{k}} - 1 w_end, o, {_turned('substring(c.sequence, cast(g_start + o as integer), {k})')} as sequence
  from (select *, unnest(range(0, g_end - g_start + 1 - {{k}} + 1)) o
  from gene) g
  join chrom c
  on c.chr = g.chr"""}
_PRE_SITES = f"select gene_id, {_id('gene_name', 'Premrna', 'o + 1')} site_id, chr, w_start as start, w_end as \"end\", strand, sequence from pre"
_DISTINCT = {"dex": "select distinct e.gene_id, g.gene_name, e.chr, e_start, e_end, e.strand from exon e join gene g on g.gene_id = e.gene_id"}
_EX = _DISTINCT | {"ex": f"""select d.*, o, e_start + o w_start, e_start + o + {{k}} - 1 w_end, {_turned('substring(c.sequence, cast(e_start + o as integer), {k})')} as sequence
  from (select *, unnest(range(0, e_end - e_start + 1 - {{k}} + 1)) o
  from dex) d
  join chrom c
  on c.chr = d.chr"""}
_EX_SITES = f"""select gene_id, {_id('gene_name', 'Exon', 'n')} site_id, chr, w_start as start, w_end as \"end\", strand, sequence
  from (select *, row_number() over (partition by gene_id order by e_start, e_end, o) n
  from ex)"""


def _k(views: dict[str, str], k: int) -> dict[str, str]:
    return {name: text.replace("{k}", str(k)) for name, text in views.items()}


def _pre(spark, d, k=16):
    return sites.pre_mrna_sites(v.gene(spark, d), v.tiles(spark, d), k, PREFIX, size=TILE)


@query(sql("""select gene_id, cast(count(*) as bigint) n_sites, round(avg(cast(length(sequence) - length(translate(sequence, 'GC', '')) as double) / length(sequence)), 6) mean_gc from pre group by gene_id""", "chrom", "gene", **_k(_PRE, 16)))
def gene_gc_profile(spark, d):
    found = _pre(spark, d).select("gene_id", fs.gc_content(F.col("sequence")).alias("gc"))
    return found.groupBy("gene_id").agg(F.count(F.lit(1)).alias("n_sites"), F.round(F.avg("gc"), 6).alias("mean_gc"))


@query(sql(_PRE_SITES, "chrom", "gene", **_k(_PRE, 16)))
def pre_mrna_sites(spark, d):
    return _pre(spark, d)


@query(sql(_EX_SITES, "chrom", "gene", "exon", **_k(_EX, 16)))
def exonic_sites(spark, d):
    return sites.exonic_sites(v.exon(spark, d), v.gene(spark, d), v.tiles(spark, d), 16, PREFIX, size=TILE)


@query(sql("select gene_id, gene_name, chr, e_start as start, e_end as \"end\", strand from dex", "gene", "exon", **_DISTINCT))
def distinct_exons(spark, d):
    return genome.distinct_exons(v.exon(spark, d), v.gene(spark, d))


@query(sql(f"""select d.gene_id, d.chr, e_start as start, e_end as \"end\", strand, {_turned('substring(c.sequence, cast(e_start as integer), cast(e_end - e_start + 1 as integer))')} as sequence
  from dex d
  join chrom c
  on c.chr = d.chr""", "chrom", "gene", "exon", **_DISTINCT))
def sequence_by_locus(spark, d):
    loci = genome.distinct_exons(v.exon(spark, d), v.gene(spark, d)).drop("gene_name")
    return genome.sequences_of(loci, v.tiles(spark, d), ["gene_id"], TILE)


@query(sql(f"""select gene_id, {_turned('substring(c.sequence, cast(g_start as integer), cast(g_end - g_start + 1 as integer))')} as sequence
  from gene g
  join chrom c
  on c.chr = g.chr""", "chrom", "gene"))
def gene_sequences(spark, d):
    return genome.gene_sequences(v.gene(spark, d), v.tiles(spark, d), TILE)


@query(sql("select * from gene where gene_id = 'G00000007'", "gene"))
def gene_by_id(spark, d):
    return genome.gene_by_id(v.gene(spark, d), "G00000007")


@query(sql("select gene_id, concat(gene_name, '/', gene_id) gene_name, chr, g_start, g_end, strand from gene where gene_id = 'G00000012'", "gene"))
def gene_by_name(spark, d):
    named = v.gene(spark, d).withColumn("gene_name", F.concat("gene_name", F.lit("/"), "gene_id"))
    name = named.where("gene_id = 'G00000012'").select("gene_name").first()[0]
    return genome.gene_by_name(named, name)


@query(sql("select gene_id, coalesce(nullif(case when strand = '-' then '' else gene_id end, ''), nullif(gene_name, '')) target from gene", "gene"))
def target_keys(spark, d):
    return v.gene(spark, d).select("gene_id", fs.target_key(F.when(F.col("strand") == "-", "").otherwise(F.col("gene_id")), F.col("gene_name")).alias("target"))


@query(sql(f"select * from ({_PRE_SITES}) where gene_id = 'G00000003' and site_id like '%-S00042'", "chrom", "gene", **_k(_PRE, 16)))
def site_by_id(spark, d):
    own = _pre(spark, d).where("gene_id = 'G00000003'")
    name = v.gene(spark, d).where("gene_id = 'G00000003'").select(fs.site_id(F.lit(PREFIX), F.col("gene_name"), "Premrna", F.lit(42))).first()[0]
    return sites.site_by_id(own, name)


@query(sql(f"""select *
  from ({_PRE_SITES})
  union all select gene_id, concat(site_id, '-X') site_id, chr, start, \"end\", strand, sequence
  from ({_PRE_SITES})
  where site_id like '%1'""", "chrom", "gene", **_k(_PRE, 16)))
def add_sites(spark, d):
    own = _pre(spark, d)
    return sites.add_sites(own, own.where(F.col("site_id").like("%1")).withColumn("site_id", F.concat("site_id", F.lit("-X"))))


@query(sql(f"select * from ({_PRE_SITES}) where site_id not like '%1'", "chrom", "gene", **_k(_PRE, 16)))
def remove_sites(spark, d):
    own = _pre(spark, d)
    return sites.remove_sites(own, own.where(F.col("site_id").like("%1")).select("gene_id", "site_id"))


@query(sql(f"select *, cast(regexp_extract(site_id, '([0-9]+)$', 1) as bigint) ordinal from ({_PRE_SITES}) order by gene_id, ordinal", "chrom", "gene", **_k(_PRE, 16)))
def list_sites(spark, d):
    return sites.list_sites(_pre(spark, d))


@query(sql("""select site_id, transcript_id, t_start, t_end
  from (select distinct concat(transcript_id, ':0-16') site_id, transcript_id, 0::bigint t_start, 16::bigint t_end
  from exon)""", "gene", "exon"))
def equal_sites(spark, d):
    each = v.exon(spark, d).select("transcript_id", F.lit(0).cast("long").alias("t_start"), F.lit(16).cast("long").alias("t_end"))
    each = each.withColumn("site_id", fs.transcript_site_id(F.col("transcript_id"), F.col("t_start"), F.col("t_end")))
    return sites.distinct_transcript_sites(each).select("site_id", "transcript_id", "t_start", "t_end")


@query(sql("""select concat(chr, ':', cast(e_start as varchar), '-', cast(e_end as varchar), ',', strand) site_id, cast(e_end - e_start + 1 as bigint) n
  from dex""", "gene", "exon", **_DISTINCT))
def locus_ids(spark, d):
    e = genome.distinct_exons(v.exon(spark, d), v.gene(spark, d))
    return e.select(fs.locus_id(F.col("chr"), F.col("start"), F.col("end"), F.col("strand")).alias("site_id"), sites.site_length(e).cast("long").alias("n"))


@query(sql("""select transcript_id, o::bigint t_start, (o + 16)::bigint t_end, substring(sequence, cast(o + 1 as integer), 16) as sequence, concat(transcript_id, ':', cast(o as varchar), '-', cast(o + 16 as varchar)) site_id
  from (select concat('T', cast(seq_id as varchar)) transcript_id, sequence, unnest(range(0, 64 - 16 + 1)) o
  from seqs)""", "seqs"))
def transcript_sites(spark, d):
    t = v.seqs(spark, d).select(F.concat(F.lit("T"), F.col("seq_id").cast("string")).alias("transcript_id"), "sequence")
    return sites.transcript_sites(t, 16).withColumn("site_id", fs.transcript_site_id(F.col("transcript_id"), F.col("t_start"), F.col("t_end")))


_LAID = """select *, off_end - n off_start from (select *, e_end - e_start + 1 n, sum(e_end - e_start + 1) over w off_end, row_number() over w exon_rank
  from (select concat(transcript_id, '/', gene_id) transcript_id, chr, strand, e_start, e_end from exon)
  window w as (partition by transcript_id order by case when strand = '-' then -e_start else e_start end, e_end rows unbounded preceding))"""
_TO_GENOMIC = """select transcript_id, 5::bigint t_start, 40::bigint t_end, chr, cast(case when strand = '-' then e_end - (least(40, off_end) - off_start) + 1 else e_start + greatest(5, off_start) - off_start end as bigint) as start,
  cast(case when strand = '-' then e_end - (greatest(5, off_start) - off_start) else e_start + least(40, off_end) - off_start - 1 end as bigint) as "end", strand, cast(exon_rank as bigint) exon_rank from laid where 5 < off_end and off_start < 40"""


@query(sql(_TO_GENOMIC, "gene", "exon", laid=_LAID))
def transcript_to_genomic(spark, d):
    e = v.exon(spark, d).withColumn("transcript_id", F.concat("transcript_id", F.lit("/"), "gene_id"))
    one = e.select("transcript_id").distinct().select("transcript_id", F.lit(5).cast("long").alias("t_start"), F.lit(40).cast("long").alias("t_end"))
    return sites.to_genomic(one, e)


@query(sql(f"select * from ({_EX_SITES}) where gene_id in ('G00000001', 'G00000002', 'G00000005')", "chrom", "gene", "exon", **_k(_EX, 16)))
def create_target(spark, d):
    return sites.create_target(v.gene(spark, d), v.exon(spark, d), v.tiles(spark, d), 16, "exonic_only", gene_ids=["G00000001", "G00000002", "G00000005"], prefix=PREFIX, size=TILE)


_OWNED = """select distinct gene_id, concat('T', cast(seq_id as varchar)) transcript_id, sequence
  from seqs
  join exon
  on exon.transcript_id = concat('T', cast(seq_id as varchar))"""


@query(sql("""select gene_id, concat(transcript_id, ':', cast(o as varchar), '-', cast(o + 16 as varchar)) site_id, transcript_id, o::bigint t_start, (o + 16)::bigint t_end,
  substring(sequence, cast(o + 1 as integer), 16) as sequence from (select *, unnest(range(0, 64 - 16 + 1)) o from owned)""", "gene", "exon", "seqs", owned=_OWNED))  # fmt: skip
def create_transcript_target(spark, d):
    """Sites of the transcripts of all genes, by a frame of their names, each under its own."""
    named = v.gene(spark, d).withColumn("gene_name", F.concat("gene_name", F.lit("/"), "gene_id"))
    names = named.select("gene_name")
    spliced = v.seqs(spark, d).select(F.concat(F.lit("T"), F.col("seq_id").cast("string")).alias("transcript_id"), "sequence")
    return sites.create_target(named, v.exon(spark, d), v.tiles(spark, d), 16, "transcriptomic", gene_names=names, transcripts=spliced)


# k-mers


def _windows(name: str, source: str, k: int, ident: str = "", turned: bool = False) -> dict[str, str]:
    kmer = f"substring(sequence, cast(i + 1 as integer), {k})"
    return {name: f"""select {ident}{', ' * bool(ident)}i + 1 pos, {f'least({kmer}, {_rc(kmer)})' if turned else kmer} kmer
  from (select *, unnest(range(0, length(sequence) - {k} + 1)) i
  from {source})"""}


def _counts(name: str, windows: str) -> dict[str, str]:
    return {name: f"select kmer, cast(count(*) as bigint) cnt from {windows} group by kmer"}


_A = _windows("wa", "seqs", 6, turned=True) | _counts("ca", "wa") | {"a": "select * from ca where cnt >= 40"}
_B = _windows("wb", "reads", 6, turned=True) | _counts("cb", "wb") | {"b": "select * from cb where cnt >= 15"}
_AB = _A | _B
_BOTH = _AB | {"ab": "select coalesce(a.kmer, b.kmer) kmer, coalesce(a.cnt, 0) a, coalesce(b.cnt, 0) b from a full join b on a.kmer = b.kmer"}


def _a(spark, d):
    return kmers.count_kmers(v.seqs(spark, d), 6, ci=40, cs=1_000_000_000)


def _b(spark, d):
    return kmers.count_kmers(v.reads(spark, d), 6, ci=15, cs=1_000_000_000)


@query(sql("select kmer, cnt from c where cnt >= 2", "seqs", **_windows("w", "seqs", 8), **_counts("c", "w")))
def count_kmers(spark, d):
    return kmers.count_kmers(v.seqs(spark, d), 8, both_strands=False, cs=1_000_000_000)


@query(sql("select kmer, least(cnt, 20) cnt from c where cnt between 3 and 60", "seqs", **_windows("w", "seqs", 6, turned=True), **_counts("c", "w")))
def canonical_kmers(spark, d):
    return kmers.count_kmers(v.seqs(spark, d), 6, ci=3, cx=60, cs=20)


_HPC = {"h": """select seq_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(sequence, 'A+', 'A', 'g'), 'C+', 'C', 'g'), 'G+', 'G', 'g'), 'T+', 'T', 'g') as sequence
  from seqs"""}


@query(sql("select kmer, cnt from c where cnt >= 2", "seqs", **_HPC, **_windows("w", "h", 7), **_counts("c", "w")))
def compressed_kmers(spark, d):
    return kmers.count_kmers(v.seqs(spark, d), 7, both_strands=False, compress=True, cs=1_000_000_000)


_SAMPLED = _windows("w", "seqs", 7, turned=True) | _counts("c", "w") | {"m": "select * from c where substring(md5(kmer), 8, 1) = '0'"}  # 8 hex digits modulo 16


@query(sql("select cnt, cast(count(*) * 16 as bigint) kmers from m group by cnt", "seqs", **_SAMPLED))
def estimated_histogram(spark, d):
    return kmers.estimate_histogram(v.seqs(spark, d), 7)


@query(sql("select cast(count(*) * 16 as bigint) distinct_kmers, cast(sum(cnt) * 16 as bigint) total_kmers from m", "seqs", **_SAMPLED))
def estimated_totals(spark, d):
    return kmers.estimate_totals(v.seqs(spark, d), 7)


@query(sql("""select cast(sum(cnt) as bigint) total_kmers, count(*) unique_kmers, count(*) filter (cnt < 2) below_min, count(*) filter (cnt > 9) above_max, count(*) filter (cnt between 2 and 9) counted_kmers, (select count(*)
  from seqs) reads
  from c""", "seqs", **_windows("w", "seqs", 8, turned=True), **_counts("c", "w")))
def count_summary(spark, d):
    return kmers.count_summary(v.seqs(spark, d), 8, 2, 9)


@query(sql("select a.kmer, least(a.cnt, b.cnt) cnt from a join b on a.kmer = b.kmer", "seqs", "reads", **_AB))
def kmers_intersect(spark, d):
    return kmers.intersect(_a(spark, d), _b(spark, d))


@query(sql("select kmer, a + b cnt from ab", "seqs", "reads", **_BOTH))
def kmers_union(spark, d):
    return kmers.union(_a(spark, d), _b(spark, d))


@query(sql("select * from a where kmer not in (select kmer from b)", "seqs", "reads", **_AB))
def kmers_subtract(spark, d):
    return kmers.subtract(_a(spark, d), _b(spark, d))


@query(sql("select a.kmer, a.cnt - coalesce(b.cnt, 0) cnt from a left join b on a.kmer = b.kmer where a.cnt - coalesce(b.cnt, 0) > 0", "seqs", "reads", **_AB))
def kmers_subtract_counts(spark, d):
    return kmers.subtract_counts(_a(spark, d), _b(spark, d))


@query(sql("select * from b where kmer not in (select kmer from a)", "seqs", "reads", **_AB))
def kmers_reverse_subtract(spark, d):
    return kmers.reverse_subtract(_a(spark, d), _b(spark, d))


@query(sql("select b.kmer, b.cnt - coalesce(a.cnt, 0) cnt from b left join a on a.kmer = b.kmer where b.cnt - coalesce(a.cnt, 0) > 0", "seqs", "reads", **_AB))
def kmers_reverse_subtract_counts(spark, d):
    return kmers.reverse_subtract_counts(_a(spark, d), _b(spark, d))


@query(sql(" union all ".join(f"""select '{m}' mode_name, kmer, {e} cnt
  from ab
  where a > 0 and b > 0{' and a > b' if m == 'diff' else ''}""" for m, e in (("min", "least(a, b)"), ("max", "greatest(a, b)"), ("sum", "a + b"), ("diff", "a - b"), ("left", "a"), ("right", "b"))), "seqs", "reads", **_BOTH))
def counter_modes(spark, d):
    from functools import reduce

    both, _ = staged(kmers.paired(_a(spark, d), _b(spark, d)), "paired")
    parts = [kmers.intersect_of(both, m).select(F.lit(m).alias("mode_name"), "kmer", "cnt") for m in kmers.MODES]
    return reduce(DataFrame.unionByName, parts)


@query(sql("select 'union' output, kmer, a + b cnt from ab union all select 'intersect', kmer, least(a, b) from ab where a > 0 and b > 0", "seqs", "reads", **_BOTH))
def chained_outputs(spark, d):
    both, _ = staged(kmers.paired(_a(spark, d), _b(spark, d)), "paired")
    return kmers.union_of(both).select(F.lit("union").alias("output"), "*").unionByName(kmers.intersect_of(both).select(F.lit("intersect").alias("output"), "*"))


@query(sql("""select a.kmer, least(a.cnt, u.cnt) cnt
  from a
  join (select kmer, sum(cnt) cnt
  from (select *
  from b
  union all select *
  from a
  where cnt > 60)
  group by kmer) u
  on a.kmer = u.kmer""", "seqs", "reads", **_AB).replace("sum(cnt) cnt", "cast(sum(cnt) as bigint) cnt"))
def composed_expression(spark, d):
    a = _a(spark, d)
    return kmers.intersect(a, kmers.union(_b(spark, d), a.where("cnt > 60")))


_DIFFERENCES = """select l.kmer, l.cnt + coalesce(r.cnt, 0) cnt from (select * from a where kmer not in (select kmer from b where cnt > 30)) l left join r on r.kmer = l.kmer
  union all select kmer, cnt from r where kmer not in (select kmer from a where kmer not in (select kmer from b where cnt > 30))"""
_R = {"r": "select b.kmer, b.cnt - coalesce(a.cnt, 0) cnt from b left join a on a.kmer = b.kmer where b.cnt > coalesce(a.cnt, 0)"}


@query(sql(_DIFFERENCES, "seqs", "reads", **_AB, **_R))
def composed_differences(spark, d):
    """(a - (b with counts over 30)) + (b ~ a)."""
    a, b = _a(spark, d), _b(spark, d)
    return kmers.union(kmers.subtract(a, kmers.reduce_counts(b, 31)), kmers.subtract_counts(b, a))


@query(sql("select * from a order by kmer", "seqs", **_A))
def sorted_kmers(spark, d):
    return kmers.sort_kmers(_a(spark, d))


@query(sql("select kmer, least(cnt, 55) cnt from a where cnt between 45 and 70", "seqs", **_A))
def reduced_kmers(spark, d):
    return kmers.reduce_counts(_a(spark, d), 45, 70, 55)


@query(sql("select kmer from a", "seqs", **_A))
def compact_kmers(spark, d):
    return kmers.compact(_a(spark, d))


@query(sql("select i::bigint cnt, cast(count(ca.kmer) as bigint) kmers from range(1, 101) t(i) left join ca on ca.cnt = i group by i", "seqs", **_A))
def kmer_histogram(spark, d):
    return kmers.histogram(kmers.count_kmers(v.seqs(spark, d), 6, ci=1, cs=1_000_000_000), 1, 100, dense=True)


@query(sql("select kmer, 7::bigint cnt from a", "seqs", **_A))
def set_counts(spark, d):
    return kmers.set_counts(_a(spark, d), 7)


@query(sql("select 'compact' output, kmer, null::bigint cnt from a union all select 'reduced', kmer, cnt from a where cnt >= 50", "seqs", **_A))
def transform_outputs(spark, d):
    a, _ = staged(_a(spark, d), "kmers")
    return kmers.compact(a).select(F.lit("compact").alias("output"), "kmer", F.lit(None).cast("long").alias("cnt")).unionByName(kmers.reduce_counts(a, 50).select(F.lit("reduced").alias("output"), "kmer", "cnt"))


# reads

_HITS = _windows("wt", "seqs", 6, turned=True) | _counts("ct", "wt") | {"valid": "select kmer from ct where cnt >= 62"} | _windows("wr", "reads", 6, "read_id", turned=True) | {"hits": "select read_id, pos, kmer in (select kmer from valid) hit from wr"}


def _valid(spark, d):
    return kmers.count_kmers(v.seqs(spark, d), 6, ci=62, cs=1_000_000_000)


@query(sql("""select r.*
  from reads r
  join (select read_id, count(*) filter (hit) n
  from hits
  group by read_id) h
  on h.read_id = r.read_id
  where n between 8 and 20""", "seqs", "reads", **_HITS))
def filter_reads(spark, d):
    return reads.filter_reads(v.reads(spark, d), _valid(spark, d), 6, 8, 20)


@query(sql("""select r.*
  from reads r
  join (select read_id, cast(count(*) filter (hit) as double) / count(*) n
  from hits
  group by read_id) h
  on h.read_id = r.read_id
  where n between 0.25 and 0.5""", "seqs", "reads", **_HITS))
def filter_reads_by_share(spark, d):
    return reads.filter_reads(v.reads(spark, d), _valid(spark, d), 6, 0.25, 0.5)


@query(sql("""select r.read_id, case when bad is null then sequence when bad = 1 then '' else substring(sequence, 1, cast(bad + 4 as integer)) end as sequence
  from reads r
  left
  join (select read_id, min(pos) bad
  from hits
  where not hit
  group by read_id) h
  on h.read_id = r.read_id""", "seqs", "reads", **_HITS))
def trim_reads(spark, d):
    return reads.trim_reads(v.reads(spark, d), _valid(spark, d), 6)


_MASK = """select r.read_id, string_agg(case when exists (select 1 from hits h where h.read_id = r.read_id and h.hit and i between h.pos and h.pos + 5) then substring(r.sequence, cast(i as integer), 1) else 'N' end, '' order by i) as sequence
  from reads r, range(1, 33) t(i) group by r.read_id"""


@query(sql(_MASK, "seqs", "reads", **_HITS))
def mask_reads(spark, d):
    return reads.mask_reads(v.reads(spark, d), _valid(spark, d), 6)


@query(sql("select read_id::varchar read_id, sequence, repeat('I', length(sequence)) qual from reads", "reads"))
def fastq_round_trip(spark, d):
    path = new_path(spark, "fastq")
    writers.write_reads(reads.as_fastq(v.reads(spark, d)), path)
    return readers.read_fastq(spark, path)


_TWO_HITS = _windows("wt", "seqs", 6, turned=True) | _counts("ct", "wt") | {"valid": "select kmer from ct where cnt >= 62"} | _windows("wr", "both_reads", 6, "mate, read_id", turned=True) | {
    "hits": "select mate, read_id, pos, kmer in (select kmer from valid) hit from wr", "per": "select mate, read_id, count(*) filter (hit) n, min(pos) filter (not hit) bad from hits group by mate, read_id"}


@query(sql("select r.* from both_reads r join per on per.read_id = r.read_id and per.mate = r.mate where n between 8 and 20", "seqs", "both_reads", **_TWO_HITS))
def filter_two_files(spark, d):
    """Reads of two files whose ids are the same."""
    return reads.filter_reads(v.both_reads(spark, d), _valid(spark, d), 6, 8, 20)


@query(sql("""select r.mate, r.read_id, case when bad is null then sequence when bad = 1 then '' else substring(sequence, 1, cast(bad + 4 as integer)) end as sequence
  from both_reads r join per on per.read_id = r.read_id and per.mate = r.mate""", "seqs", "both_reads", **_TWO_HITS))  # fmt: skip
def trim_two_files(spark, d):
    return reads.trim_reads(v.both_reads(spark, d), _valid(spark, d), 6)


@query(sql("""select r.mate, r.read_id, string_agg(case when exists (select 1 from hits h where h.mate = r.mate and h.read_id = r.read_id and h.hit and i between h.pos and h.pos + 5) then substring(r.sequence, cast(i as integer), 1) else 'N' end, '' order by i) as sequence
  from both_reads r, range(1, 33) t(i) group by r.mate, r.read_id""", "seqs", "both_reads", **_TWO_HITS))  # fmt: skip
def mask_two_files(spark, d):
    return reads.mask_reads(v.both_reads(spark, d), _valid(spark, d), 6)


@query(sql("select r.* from both_reads r where read_id in (select read_id from per where n >= 8 group by read_id having count(*) = 2)", "seqs", "both_reads", **_TWO_HITS))
def filter_pairs(spark, d):
    """Pairs of which both mates pass, from two FASTQ files."""
    paths = [new_path(spark, "fastq") for _ in range(2)]
    for path, records in zip(paths, (v.reads(spark, d), v.mates(spark, d)), strict=True):
        writers.write_reads(reads.as_fastq(records), path)
    kept = reads.filter_pairs(*(readers.read_fastq(spark, p) for p in paths), _valid(spark, d), 6, read_ci=8)
    first, second = (x.select(F.lit(m).alias("mate"), F.col("read_id").cast("long").alias("read_id"), "sequence") for m, x in enumerate(kept, 1))
    return first.unionByName(second)


# files


@query(sql("select chr as name, 'derived' description, cast(length(sequence) as bigint) length from chrom", "chrom"))
def fasta_index(spark, d):
    """Names and lengths of the records of a FASTA file, none of which is ever one row."""
    return readers.fasta_index(v.fasta_lines(spark, d)).select("name", "description", "length")


@query(sql("select chr, t::bigint tile, substring(sequence, cast(t * 256 + 1 as integer), 511) as sequence from chrom, range(0, 4) r(t)", "chrom"))
def tiles_by_lines(spark, d):
    return genome.tiles_of_lines(v.fasta_lines(spark, d), TILE)


@query(sql("select kmer, cnt from c where cnt >= 2", "chrom", **_windows("w", "chrom", 8, turned=True), **_counts("c", "w")))
def count_chromosomes(spark, d):
    """K-mers of whole chromosomes, read by lines."""
    tiles = genome.tiles_of_lines(v.fasta_lines(spark, d), TILE)
    return kmers.count_kmers(genome.tile_windows(tiles, 8, TILE), 8, cs=1_000_000_000)


@query(sql("select kmer, cnt from c", "chrom", "seqs", "reads", w0="select sequence from chrom union all select sequence from seqs union all select sequence from reads union all select sequence from reads", **_windows("w", "w0", 25, turned=True), **_counts("c", "w")))
def count_by_minimizers(spark, d):
    """All k-mers of k = 25, counted by runs that share minimizers."""
    each = [v.chrom(spark, d), v.seqs(spark, d), v.reads(spark, d), v.reads(spark, d)]
    return kmers.count_kmers(joins.one_union([x.select("sequence") for x in each]), 25, ci=1, cs=1_000_000_000)


@query(sql("select a.kmer, least(a.cnt, b.cnt) cnt from ca a join cb b on a.kmer = b.kmer where a.cnt >= 40 and b.cnt >= 15", "seqs", "reads", **_AB))
def stored_tables_intersect(spark, d):
    """Two bucketed tables kept with their settings."""
    a = counted_table(v.seqs(spark, d), new_path(spark, "table"), Settings(k=6, ci=40, cs=1_000_000_000))
    b = counted_table(v.reads(spark, d), new_path(spark, "table"), Settings(k=6, ci=15, cs=1_000_000_000))
    return kmers.intersect(a, b)


_C = _windows("wc", "chrom", 6, turned=True) | _counts("cc", "wc") | {"c": "select * from cc where cnt >= 30"}
_THREE = {"n": "select coalesce(a.kmer, b.kmer, c.kmer) kmer, a.cnt a, b.cnt b, c.cnt c from a full join b on a.kmer = b.kmer full join c on c.kmer = coalesce(a.kmer, b.kmer)"}
_NWAY = """select kmer, l + coalesce(r, 0) cnt from (select kmer, least(a, b) l, case when c is not null and a is null then c end r from n where a is not null and b is not null)
  union all select kmer, case when a is not null and b is not null then least(a, b) else 0 end + c from n where not (a is not null and b is not null) and c is not null and a is null"""
_CHAINED = """select 'kept' output, kmer, greatest(a, c) cnt from n where a is not null and c is not null and b is null
  union all select 'more', kmer, coalesce(a, 0) + coalesce(b, 0) - coalesce(case when c >= 40 then c end, 0) from n where (a is not null or b is not null) and coalesce(a, 0) + coalesce(b, 0) - coalesce(case when c >= 40 then c end, 0) > 0"""


def _three(spark, d):
    c = kmers.count_kmers(genome.tile_windows(v.tiles(spark, d), 6, TILE), 6, ci=30, cs=1_000_000_000)
    return {"a": _a(spark, d), "b": _b(spark, d), "c": c}


@query(sql(_NWAY, "chrom", "seqs", "reads", **_AB, **_C, **_THREE))
def nway_expression(spark, d):
    """(a * b) + (c - a) over three tables in one aggregate."""
    a, b, c = Kmers("a"), Kmers("b"), Kmers("c")
    return evaluate(a * b + (c - a), _three(spark, d))


@query(sql(_CHAINED, "chrom", "seqs", "reads", **_AB, **_C, **_THREE))
def nway_outputs(spark, d):
    """(a * c by greatest counter) - b, and (a + b) ^ (c with counters of 40 or more), both from one aggregate."""
    a, b, c = Kmers("a"), Kmers("b"), Kmers("c")
    return evaluate_all({"kept": a.intersect(c, "max") - b, "more": (a + b) ^ Kmers("c", ci=40)}, _three(spark, d))


@query(sql("select 'compact' output, kmer, null::bigint cnt from a union all select 'reduced', kmer, cnt from a where cnt >= 50 union all select 'histogram', null, cast(count(*) as bigint) from a", "seqs", **_A))
def written_outputs(spark, d):
    """Three files from one count, which is deleted when they are written."""
    compact, reduced, bars = (new_path(spark, "output") for _ in range(3))
    write_outputs(_a(spark, d), {
        compact: lambda x, p: kmers.compact(x).write.parquet(p), reduced: lambda x, p: writers.write_kmer_table(kmers.reduce_counts(x, 50), p),
        bars: lambda x, p: kmers.histogram(x, cx=1_000_000_000).write.parquet(p),  # as far as counters go
    })
    none = lambda kind: F.lit(None).cast(kind)
    bars = spark.read.parquet(bars).agg(F.coalesce(F.sum("kmers"), F.lit(0)).cast("long").alias("cnt")).select(F.lit("histogram").alias("output"), none("string").alias("kmer"), "cnt")
    return spark.read.parquet(compact).select(F.lit("compact").alias("output"), "kmer", none("long").alias("cnt")).unionByName(spark.read.parquet(reduced).select(F.lit("reduced").alias("output"), "kmer", "cnt")).unionByName(bars)



@query(sql("select read_id::varchar as name, '' as description, sequence from reads", "reads"))
def fasta_round_trip(spark, d):
    path = new_path(spark, "fasta")
    writers.write_reads(reads.as_fasta(v.reads(spark, d)), path)
    return readers.read_fasta(spark, path)


@query(sql("select sequence, count(*) n from (select sequence from reads union all select sequence from seqs) group by sequence", "seqs", "reads"))
def multi_file_scan(spark, d):
    """Two sequence files that a list file names."""
    paths = [new_path(spark, "fasta") for _ in range(2)]
    for path, records in zip(paths, (v.reads(spark, d), v.seqs(spark, d).withColumnRenamed("seq_id", "read_id")), strict=True):
        writers.write_reads(reads.as_fasta(records), path)
    listed = new_path(spark, "list")
    spark.createDataFrame([(p,) for p in paths], "value string").coalesce(1).write.text(listed)
    return readers.read_fasta(spark, readers.read_list(spark, listed)).groupBy("sequence").agg(F.count(F.lit(1)).alias("n"))


@query(sql("select gene_id, transcript_id, chr, strand, e_start, e_end from exon", "gene", "exon"))
def gtf_exons(spark, d):
    path = new_path(spark, "gtf")
    line = F.concat_ws("\t", F.col("chr"), F.lit("sl"), F.lit("exon"), F.col("e_start").cast("string"), F.col("e_end").cast("string"), F.lit("."), "strand", F.lit("."), F.format_string('gene_id "%s"; transcript_id "%s"; tag "a"; tag "b";', "gene_id", "transcript_id"))
    v.exon(spark, d).select(line.alias("value")).write.text(path)
    return readers.exons_of(readers.read_gtf(spark, path))


@query(sql(f"select gene_id, site_id, chr, start, \"end\", strand, sequence from ({_PRE_SITES})", "chrom", "gene", **_k(_PRE, 16)))
def target_json_round_trip(spark, d):
    path = new_path(spark, "target")
    writers.write_target_json(_pre(spark, d), v.gene(spark, d), path)
    return readers.read_target_json(spark, path).select(*sites.COLUMNS)


@query(sql("select kmer, cnt from a where cnt between 45 and 80", "seqs", **_A))
def kmer_table_scan(spark, d):
    path = new_path(spark, "kmers")
    writers.write_kmer_table(_a(spark, d), path)
    writers.write_kmer_table(_a(spark, d).limit(0), path, reuse=True)  # the finished table stays
    return readers.read_kmer_table(spark, path, 45, 80)


@query(sql("select kmer, cnt::varchar cnt from a", "seqs", **_A))
def kmer_dump(spark, d):
    path = new_path(spark, "dump")
    kmers_of = _a(spark, d)
    writers.dump_kmers(kmers_of, path, in_order=True)
    return spark.read.option("sep", "\t").schema("kmer string, cnt string").csv(path)


@query(sql("""select gene_id, site_id, cast(length(sequence) - length(translate(sequence, 'GC', '')) as double) / length(sequence) "GC_content", 'SYN' assembly, 'all' target, 16 k, 'pre-mrna' region from (""" + _PRE_SITES + ")", "chrom", "gene", **_k(_PRE, 16)))
def analysis_round_trip(spark, d):
    path = new_path(spark, "analysis")
    found = analysis.analyze_sites(_pre(spark, d), {"GC_content": fs.gc_content})
    writers.write_analysis(found, path, "SYN", "all", 16, "pre-mrna")
    return spark.read.parquet(path).withColumns({"k": F.col("k").cast("int"), "assembly": F.col("assembly").cast("string")})


# analyses


@query(sql(f"""select s.gene_id, s.site_id, cast(length(sequence) - length(translate(sequence, 'GC', '')) as double) / length(sequence) gc, cast(start - g_start as bigint) offset_in_gene, coalesce(c.cnt, 0) genome_count
  from ({_PRE_SITES}) s join gene g on g.gene_id = s.gene_id left join c on c.kmer = s.sequence""", "chrom", "gene", **_k(_PRE, 24), **_windows("w", "chrom", 24), **_counts("c", "w")))
def gathered_analyses(spark, d):
    own, genes = _pre(spark, d, 24), v.gene(spark, d)
    site = analysis.analyze_sites(own, {"gc": fs.gc_content})
    target = analysis.analyze_targets(own, genes, {"offset_in_gene": lambda: F.col("start") - F.col("g_start")})
    whole = offtargets.site_counts_in(own, v.tiles(spark, d), 24, TILE)
    return analysis.gather([site, target, whole])


@query(sql(f"select gene_id, site_id, cast(length(sequence) as bigint) n from ({_PRE_SITES})", "chrom", "gene", **_k(_PRE, 16)))
def python_analysis(spark, d):
    def measure(it):
        for pdf in it:
            yield pdf[["gene_id", "site_id"]].assign(n=pdf["sequence"].str.len())

    return analysis.analyze_sites_python(_pre(spark, d).select("gene_id", "site_id", "sequence"), measure, "gene_id string, site_id string, n long")


# genome-wide joins


@query(sql(f"""select s.*, loci, array_to_string(starts, ',') starts
  from ({_PRE_SITES}) s
  join (select gene_id, sequence, cast(count(distinct w_start) as bigint) loci, list_sort(list(distinct w_start)) starts
  from pre
  group by gene_id, sequence
  having count(distinct w_start) > 1) g
  on g.gene_id = s.gene_id and g.sequence = s.sequence""", "chrom", "gene", **_k(_PRE, 6)))
def repeated_sites(spark, d):
    found = offtargets.repeated_sites(_pre(spark, d, 6))
    return found.withColumn("starts", F.array_join(F.col("starts").cast("array<string>"), ","))


@query(sql("""select gene_id, sequence, cast(count(distinct w_start) as bigint) loci, array_to_string(list_sort(list(distinct w_start)), ',') starts
  from pre group by gene_id, sequence having count(distinct w_start) > 1""", "chrom", "gene", **_k(_PRE, 6)))  # fmt: skip
def repeat_groups(spark, d):
    """Each repeated sequence of a gene once, with its places."""
    return offtargets.repeat_groups(_pre(spark, d, 6)).withColumn("starts", F.array_join(F.col("starts").cast("array<string>"), ","))


_OFF = _windows("gw", "chrom", 10, "chr") | {"q": f"select *, '+' hit_strand, sequence query from ps union all select *, '-' hit_strand, {_rc('sequence')} query from ps"}


@query(sql('select q.gene_id, q.site_id, gw.chr, gw.pos::bigint pos, q.hit_strand from q join gw on gw.kmer = q.query join gene g on g.gene_id = q.gene_id where not (gw.chr = g.chr and gw.pos >= g.g_start and gw.pos + 9 <= g.g_end)', "chrom", "gene", **_k(_PRE, 10), ps=_PRE_SITES, **_OFF))
def exact_off_targets(spark, d):
    windows = genome.genome_codes(v.tiles(spark, d), 10, TILE)
    return offtargets.exact_off_targets(_pre(spark, d, 10), windows, v.gene(spark, d), 10)


@query(ORACLE_SQL["exact_off_targets"])
def filtered_off_targets(spark, d):
    """The same, with a Bloom filter before the shuffle."""
    return offtargets.exact_off_targets_in(_pre(spark, d, 10), v.tiles(spark, d), v.gene(spark, d), 10, TILE)


_NEAR = _windows("gw", "chrom", 14, "chr") | {"q": f"""select *, '+' hit_strand, sequence query from wanted union all select *, '-' hit_strand, {_rc('sequence')} query from wanted"""}
_APART = "join gene g on g.gene_id = q.gene_id where not (gw.chr = g.chr and gw.pos >= g.g_start and gw.pos + 13 <= g.g_end)"
_NEAR_HITS = f"""select q.gene_id, q.site_id, gw.chr, gw.pos::bigint pos, q.hit_strand, cast(hamming(q.query, gw.kmer) as bigint) mismatches
  from q
  join gw
  on hamming(q.query, gw.kmer) <= 2 {_APART}"""
_HUNDREDTH = {"wanted": "select * from ps where cast(regexp_extract(site_id, '([0-9]+)$', 1) as bigint) % 100 = 0"}
_SUMMARY = """select n.gene_id, n.site_id, count(*) hits, count(distinct n.chr) chromosomes, any_value(coalesce(t.genes, 0)) genes, count(*) filter (mismatches = 0) mm0,
  count(*) filter (mismatches = 1) mm1, count(*) filter (mismatches = 2) mm2 from n left join t on t.gene_id = n.gene_id and t.site_id = n.site_id group by n.gene_id, n.site_id"""
_TOUCHED = {"t": """select n.gene_id, n.site_id, count(distinct o.gene_id) genes
  from n
  join gene o
  on o.chr = n.chr and n.pos <= o.g_end and o.g_start <= n.pos + 13
  group by n.gene_id, n.site_id"""}


def _near(spark, d, wanted: DataFrame):
    return offtargets.near_off_targets_in(wanted, v.tiles(spark, d), v.gene(spark, d), 14, 2, TILE)


def _hundredth(spark, d):
    """The queries of the search: sites whose number is divisible by 100, against all windows."""
    return _pre(spark, d, 14).where(F.regexp_extract("site_id", "([0-9]+)$", 1).cast("long") % 100 == 0)


@query(sql(_NEAR_HITS, "chrom", "gene", **_k(_PRE, 14), ps=_PRE_SITES, **_HUNDREDTH, **_NEAR))
def near_off_targets(spark, d):
    return _near(spark, d, _hundredth(spark, d))


# every site against every window; the SQL, too, finds candidates by parts of the strings
_PARTS = ((1, 3), (4, 4), (8, 3), (11, 4))
_SHARED = [" and ".join(f"substring(query, {a}, {n}) = substring(kmer, {a}, {n})" for a, n in pair) for pair in combinations(_PARTS, 2)]
_ALL_NEAR = {"wanted": "select * from ps", **_NEAR, "qd": "select distinct query from q", "near": " union ".join(f"""select query, chr, pos, kmer
  from qd
  join gw
  on {on}
  where hamming(query, kmer) <= 2""" for on in _SHARED)}
_ALL_HITS = f"""select q.gene_id, q.site_id, gw.chr, gw.pos::bigint pos, q.hit_strand, cast(hamming(q.query, gw.kmer) as bigint) mismatches
  from q
  join near gw
  on gw.query = q.query {_APART}"""


@query(sql(_ALL_HITS, "chrom", "gene", **_k(_PRE, 14), ps=_PRE_SITES, **_ALL_NEAR))
def all_near_off_targets(spark, d):
    return _near(spark, d, _pre(spark, d, 14))


@query(sql(_SUMMARY, "chrom", "gene", **_k(_PRE, 14), ps=_PRE_SITES, **_ALL_NEAR, n=_ALL_HITS, **_TOUCHED))
def all_off_target_summary(spark, d):
    return offtargets.off_target_summary_in(_pre(spark, d, 14), v.tiles(spark, d), v.gene(spark, d), 14, 2, TILE)


@query(ORACLE_SQL["all_off_target_summary"])
def off_target_summary(spark, d):
    """The same: a summary leaves no site out."""
    return all_off_target_summary(spark, d)


def _loci(spark, d):
    """Places along the chromosomes, from orders."""
    o = v._table(spark, d, "orders")
    n = v._table(spark, d, "supplier").count()
    start = (1 + F.col("o_orderkey") * 13 % 1000).cast("long")
    return o.select(F.col("o_orderkey").cast("long").alias("hit_id"), F.concat(F.lit("chr"), (F.col("o_custkey") % n).cast("string")).alias("chr"), start.alias("start"), (start + 15).alias("end"))


_LOCI = {"loci": """select o_orderkey::bigint hit_id, concat('chr', cast(o_custkey % (select count(*)
  from supplier) as varchar)) chr, cast(1 + o_orderkey * 13 % 1000 as bigint) as start, cast(16 + o_orderkey * 13 % 1000 as bigint) as \"end\"
  from orders"""}


@query(sql("""select h.*, case when hit_id in (select hit_id from loci l join exon e on e.chr = l.chr and l.start <= e.e_end and e.e_start <= l."end") then 'exonic'
  when hit_id in (select hit_id from loci l join gene g on g.chr = l.chr and l.start <= g.g_end and g.g_start <= l."end") then 'intronic' else 'intergenic' end as location from loci h""", "gene", "exon", **_LOCI))
def hit_locations(spark, d):
    return offtargets.classify_hits(_loci(spark, d), v.gene(spark, d), v.exon(spark, d), 128)


@query(sql("""select hit_id, l.chr, l.start, (select max(struct_pack(s := g_start, g := gene_id))
  from gene g
  where g.chr = l.chr and g.g_start <= l.start).g gene_id
  from loci l""", "gene", **_LOCI))
def nearest_genes(spark, d):
    return offtargets.nearest_gene(_loci(spark, d), v.gene(spark, d), 128)


@query(sql("select distinct kmer from wt where kmer not in (select kmer from wo)", "chrom", "gene", **_k(_PRE, 9), ps=_PRE_SITES,
    wt="select sequence kmer from ps where gene_id = 'G00000004'", g4="select * from gene where gene_id = 'G00000004'",
    wg="select chr, o + 1 pos, substring(sequence, cast(o + 1 as integer), 9) kmer from (select *, unnest(range(0, length(sequence) - 8)) o from chrom)",
    wo="select kmer from wg, g4 where not (wg.chr = g4.chr and pos >= g_start and pos + 8 <= g_end)"))
def unique_target_kmers(spark, d):
    g = v.gene(spark, d).where("gene_id = 'G00000004'").select("chr", F.col("g_start").alias("start"), F.col("g_end").alias("end"))
    own = _pre(spark, d, 9).where("gene_id = 'G00000004'").select(F.col("sequence").alias("kmer")).distinct()
    return offtargets.unique_in_genome(own, g, v.tiles(spark, d), 9, TILE)
