"""The queries of this subpackage, by name, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import filter_audit, neighbours
from .decontaminate import op7_decontaminate
from .filter_audit import op11_filter_audit
from .html_text import op3_html_text
from .importance import op12_resample
from .neighbours import op13_neighbours
from .pieces import op8_pieces
from .pii import op2_pii
from .quality_rank import op1_quality_rank
from .quality_rules import op6_quality_rules
from .quotes import op5_quotes
from .secrets import op10_secrets
from .simhash import op4_simhash
from .substrings import op9_substrings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_quality_rank, op2_pii, op3_html_text, op4_simhash, op5_quotes, op6_quality_rules, op7_decontaminate, op8_pieces, op9_substrings, op10_secrets, op11_filter_audit, op12_resample, op13_neighbours)}
ORACLE_SQL: dict[str, str] = {
    "op11_filter_audit": filter_audit.SQL,
    "op13_neighbours": neighbours.SQL,
    "op9_substrings": r"""with w as (select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') ws from documents),
      windows as (select doc_id, s, array_to_string(list_slice(ws, s, s + 19), ' ') k from (select doc_id, ws, unnest(range(1, len(ws) - 18)) s from w)),
      firsts as (select k, min(struct_pack(d := doc_id, s := s)) f from windows group by k having count(*) > 1),
      gone as (select distinct doc_id, s + o p from windows join firsts on windows.k = firsts.k, range(0, 20) t(o) where f < struct_pack(d := doc_id, s := s)),
      removed as (select doc_id, count(*) n, count(*) filter (begins) n_intervals from (select doc_id, p, coalesce(p - lag(p) over (partition by doc_id order by p), 2) > 1 begins from gone) group by doc_id),
      each as (select doc_id, unnest(ws) x, unnest(range(1, len(ws) + 1)) p from w),
      kept as (select doc_id, string_agg(x, ' ' order by p) t from each where not exists (select 1 from gone where gone.doc_id = each.doc_id and gone.p = each.p) group by doc_id)
      select w.doc_id, cast(len(ws) as bigint) n_words, cast(coalesce(n, 0) as bigint) n_removed, sha256(coalesce(t, '')) kept_sha256, cast(coalesce(n_intervals, 0) as integer) n_intervals
      from w left join removed on removed.doc_id = w.doc_id left join kept on kept.doc_id = w.doc_id""",
}
