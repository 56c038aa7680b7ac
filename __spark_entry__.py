"""

``queries()`` are the registered Spark queries (``concord.plans.workload``);
``oracle_sql()`` holds, for each, an independent DuckDB formulation over the
same tables. The oracle deliberately uses the six-query form — ``count(*)``,
``SELECT DISTINCT`` and ``EXCEPT ALL`` per side — so that it checks the fused
one-pass compare rather than restating it.
"""

from __future__ import annotations

import importlib.util
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from concord.plans import workload  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the verdict row of ``orders`` against its altered copy (fused compare)."""
    return workload.q_pair_verdict(spark, SMOKE_DIR)


def _llm() -> tuple[dict, dict]:
    """Queries and SQL of the ``llm`` subpackage and the pipeline; empty where they are not installed."""
    spec = importlib.util.find_spec("concord.llm")
    if spec is None or spec.origin is None:
        return {}, {}
    import corpus_pipeline
    from concord.llm import queries as llm

    sql = dict(llm.ORACLES)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**llm.QUERIES, "pipeline": corpus_pipeline.run}, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**workload.QUERIES, **_llm()[0]}


# ---------------------------------------------------------------- oracle SQL helpers

ORDERS_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
LINEITEM_COLS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
    "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
)
EVENTS_COLS = "event_id, ts, user_id, event_type, value, props"

B_ORDERS = f"""b_orders as (
  select o_orderkey, o_custkey, o_orderstatus,
         case when o_orderkey % 97 = 0 then o_totalprice + 1 else o_totalprice end as o_totalprice,
         o_orderdate, o_orderpriority
  from orders where o_orderkey % 101 <> 0
  union all
  select {ORDERS_COLS} from orders where o_orderkey % 103 = 0)"""

B_LINEITEM = f"b_lineitem as (select {LINEITEM_COLS} from lineitem where l_orderkey % 101 <> 0)"

C_LINEITEM = """c_lineitem as (
  select l_orderkey, l_partkey, l_suppkey, l_linenumber,
         case when l_orderkey % 7 = 0 and l_linenumber = 1 then l_quantity + 1 else l_quantity end as l_quantity,
         l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
  from lineitem where l_orderkey % 101 <> 0)"""

DOCS_COLS = "doc_id, text, lang, source, n_chars"
B_DOCS = f"""b_docs as (
  select doc_id, case when doc_id % 13 = 0 then text || '.' else text end as text, lang, source, n_chars
  from documents where doc_id % 11 <> 0
  union all
  select {DOCS_COLS} from documents where doc_id % 17 = 0)"""

EMB_COLS = "vec_id, embedding, label"
B_EMB = """b_emb as (
  select vec_id, embedding, case when vec_id % 9 = 0 then label + 1 else label end as label
  from embeddings where vec_id % 10 <> 0)"""

PAGES_COLS = "page_id, url, html"
B_PAGES = """b_pages as (
  select page_id, url, case when page_id % 9 = 0 then html || chr(10) else html end as html
  from pages where page_id % 13 <> 0)"""

CONV_COLS = "conv_id, turn, role, text"
B_CONV = """b_conv as (
  select conv_id, turn, role,
    case when conv_id % 5 = 0 and turn % 3 = 0 then substring(text, 1, length(text) - 1) else text end as text
  from conversations where not (conv_id % 7 = 0 and turn = 0))"""

B_EVENTS = f"b_events as (select {EVENTS_COLS} from events where ts < timestamp '2024-01-05 00:00:00')"


def _status(cond: str) -> str:
    return f"case when {cond} then 'Passed' else 'Failed' end"


def _six(a: str, b: str, fine: str, coarse: str | None = None) -> str:
    """Counts, distinct counts over ``fine`` and EXCEPT ALL sizes over ``coarse``, as separate queries."""
    coarse = coarse or fine
    return f"""select cast(c1 as bigint) as gen1_count, cast(c2 as bigint) as gen2_count,
  cast(d1 as bigint) as gen1_distinct_count, cast(d2 as bigint) as gen2_distinct_count,
  cast(e1 as bigint) as gen1_except_gen2, cast(e2 as bigint) as gen2_except_gen1,
  {_status('c1 = c2')} as count_validation,
  {_status('d1 = d2')} as dis_count_validation,
  {_status('e1 + e2 = 0')} as except_validation
from (select
  (select count(*) from {a}) as c1,
  (select count(*) from {b}) as c2,
  (select count(*) from (select distinct {fine} from {a})) as d1,
  (select count(*) from (select distinct {fine} from {b})) as d2,
  (select count(*) from (select {coarse} from {a} except all select {coarse} from {b})) as e1,
  (select count(*) from (select {coarse} from {b} except all select {coarse} from {a})) as e2) s"""


def _six_by(a: str, b: str, key: str, cols: str, sfx: str = "") -> str:
    """The same per value of ``key`` (keys present on either side); last CTE is ``verdicts{sfx}``."""
    n = {x: f"{x}{sfx}" for x in ("keys", "c1", "c2", "d1", "d2", "x1", "x2", "stats", "verdicts")}
    return f"""{n['keys']} as (select {key} from {a} union select {key} from {b}),
{n['c1']} as (select {key}, count(*) as n from {a} group by {key}),
{n['c2']} as (select {key}, count(*) as n from {b} group by {key}),
{n['d1']} as (select {key}, count(*) as n from (select distinct {cols} from {a}) group by {key}),
{n['d2']} as (select {key}, count(*) as n from (select distinct {cols} from {b}) group by {key}),
{n['x1']} as (select {key}, count(*) as n from (select {cols} from {a} except all select {cols} from {b}) group by {key}),
{n['x2']} as (select {key}, count(*) as n from (select {cols} from {b} except all select {cols} from {a}) group by {key}),
{n['stats']} as (
  select k.{key},
    cast(coalesce(c1.n, 0) as bigint) as gen1_count, cast(coalesce(c2.n, 0) as bigint) as gen2_count,
    cast(coalesce(d1.n, 0) as bigint) as gen1_distinct_count, cast(coalesce(d2.n, 0) as bigint) as gen2_distinct_count,
    cast(coalesce(x1.n, 0) as bigint) as gen1_except_gen2, cast(coalesce(x2.n, 0) as bigint) as gen2_except_gen1
  from {n['keys']} k
  left join {n['c1']} c1 on c1.{key} = k.{key} left join {n['c2']} c2 on c2.{key} = k.{key}
  left join {n['d1']} d1 on d1.{key} = k.{key} left join {n['d2']} d2 on d2.{key} = k.{key}
  left join {n['x1']} x1 on x1.{key} = k.{key} left join {n['x2']} x2 on x2.{key} = k.{key}),
{n['verdicts']} as (
  select *, {_status('gen1_count = gen2_count')} as count_validation,
    {_status('gen1_distinct_count = gen2_distinct_count')} as dis_count_validation,
    {_status('gen1_except_gen2 + gen2_except_gen1 = 0')} as except_validation
  from {n['stats']})"""


MANIFEST_SQL = """m as (
  select o_orderkey,
    case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'dev' else 'prod' end as env,
    'c' || cast(o_custkey as varchar) || '_' || case o_orderpriority
        when '1-URGENT' then 'streaming_daily' when '2-HIGH' then 'daily'
        when '3-MEDIUM' then 'weekly' when '4-NOT SPECIFIED' then 'monthly_weekly'
        else 'lowdaily' end as dag_id,
    '/lake1' || case when o_orderstatus = 'P'
        then '_test/priority2/' || printf('%03d', o_custkey % 1000) else '' end
      || '/orders/' || cast(o_orderkey as varchar) as gen1_path,
    '/lake2/orders/' || cast(o_orderkey as varchar) as gen2_path,
    cast(o_orderdate as timestamp) as ts
  from orders)"""

def _ledger_ctes() -> str:
    """``l1`` (lineitem vs C) and ``l2`` (lineitem vs B): per-order verdicts joined to the manifest."""
    parts = [B_LINEITEM, C_LINEITEM, MANIFEST_SQL]
    for run, other in ((1, "c_lineitem"), (2, "b_lineitem")):
        parts.append(_six_by("lineitem", other, "l_orderkey", LINEITEM_COLS, sfx=f"_{run}"))
        parts.append(
            f"""l{run} as (
  select m.env, m.dag_id, m.gen1_path, m.gen2_path, v.gen1_count, v.gen2_count,
    v.gen1_distinct_count, v.gen2_distinct_count, v.gen1_except_gen2, v.gen2_except_gen1,
    cast(null as varchar) as files_validation, v.count_validation, v.dis_count_validation,
    v.except_validation, cast(null as varchar) as schema_validation, cast(null as varchar) as schema_diff,
    cast(null as varchar) as error_msg, cast(null as varchar) as source_job, cast(null as varchar) as scope,
    cast(null as varchar) as gen1_partition, cast(null as varchar) as gen2_partition,
    cast(null as varchar) as partition_validation, cast(null as varchar) as run_id,
    m.ts
  from m join verdicts_{run} v on m.o_orderkey = v.l_orderkey)"""
        )
    return "with " + ",\n".join(parts)


def _normalize(col: str, weekly_cut: str) -> str:
    return f"""case when {col} like '%_daily%' then split_part({col}, '_daily', 1) || '_daily'
       when {col} like '%_weekly%' then split_part({col}, '{weekly_cut}', 1) || '_weekly'
       else {col} end"""


def _sweep(weekly_cut: str) -> str:
    keep = (
        "dag_id not like '%streaming%' and dag_id not like '%test%' and gen1_path not like '%test%' "
        "and gen2_path not like '%test%' and gen1_count > 0 and gen2_count > 0"
    )
    return f"""select distinct 'prod' as env, {_normalize('dag_id', weekly_cut)} as dag_id, gen1_path, gen2_path
from (select dag_id, gen1_path, gen2_path from l1 where {keep}
      union
      select dag_id, gen1_path, gen2_path from l2 where {keep} and env = 'prod') t
where dag_id like '%daily' or dag_id like '%weekly'"""


COMMITS = """commits as (
  select '/lake2/events/' || event_type as "table",
    case when event_type = 'error' then 'Cloud Migration'
         when event_type = 'signup' then 'my spark task'
         when value < 5 then null
         else 'load_' || event_type || '_u' || cast(user_id as varchar) end as job
  from events)"""

WRITER_FILTER = "job is not null and job not in ('Cloud Migration', 'Optimize_nzdata', 'my spark task')"


def _latest_day(rel: str) -> str:
    return f"(select {EVENTS_COLS} from {rel} where cast(ts as date) = (select max(cast(ts as date)) from {rel}))"


def _verdict_row(six: str, *, env, dag, p1, p2, schema, scope, e_override=None) -> str:
    e1, e2, ev = ("gen1_except_gen2", "gen2_except_gen1", "except_validation")
    if e_override:
        e1, e2, ev = "cast(0 as bigint)", "cast(0 as bigint)", "'NA'"
    return f"""select '{env}' as env, '{dag}' as dag_id, '{p1}' as gen1_path, '{p2}' as gen2_path,
  gen1_count, gen2_count, gen1_distinct_count, gen2_distinct_count,
  {e1} as gen1_except_gen2, {e2} as gen2_except_gen1,
  'NA' as files_validation, count_validation, dis_count_validation, {ev} as except_validation,
  '{schema}' as schema_validation, cast(null as varchar) as schema_diff, cast(null as varchar) as error_msg,
  'NA' as source_job, '{scope}' as scope, cast(null as varchar) as gen1_partition,
  cast(null as varchar) as gen2_partition, 'NA' as partition_validation, cast(null as varchar) as run_id
from ({six}) s"""


def _reconcile_tables_sql() -> str:
    """Each given table checked against itself: counts, distinct counts, empty differences."""
    parts = []
    for t in workload.TABLES:
        parts.append(f"""select 'prod' as env, '{t}_daily' as dag_id,
  cast(c as bigint) as gen1_count, cast(c as bigint) as gen2_count,
  cast(d as bigint) as gen1_distinct_count, cast(d as bigint) as gen2_distinct_count,
  cast(0 as bigint) as gen1_except_gen2, cast(0 as bigint) as gen2_except_gen1,
  'Passed' as files_validation, 'Passed' as count_validation, 'Passed' as dis_count_validation,
  'Passed' as except_validation, 'Passed' as schema_validation, cast(null as varchar) as schema_diff,
  cast(null as varchar) as error_msg, 'NA' as source_job, 'current' as scope,
  cast(null as varchar) as gen1_partition, cast(null as varchar) as gen2_partition,
  'NA' as partition_validation
from (select (select count(*) from {t}) as c, (select count(*) from (select distinct * from {t})) as d) s""")
    return "\nunion all\n".join(parts)


def _schema_diff_sql() -> str:
    """First column as text, last one gone, one more: from the engine's own description of every table."""
    parts = []
    for t in workload.TABLES:
        parts.append(f"""select '{t}' as "table", column_name, column_type,
  row_number() over () as k, count(*) over () as n from (describe {t})""")
    return f"""with d as ({" union all ".join(parts)}),
t as (
  select "table", column_name as "column", k, n, case column_type
    when 'BIGINT' then 'bigint' when 'INTEGER' then 'int' when 'DOUBLE' then 'double' when 'VARCHAR' then 'string'
    when 'TIMESTAMP' then 'timestamp_ntz' when 'FLOAT[]' then 'array<float>' else column_type end as left_type
  from d)
select "table", "column", left_type, true as left_nullable, 'string' as right_type, true as right_nullable
from t where k = 1 and left_type <> 'string'
union all
select "table", "column", left_type, true, null, null from t where k = n
union all
select distinct "table", 'zz_extra', cast(null as varchar), cast(null as boolean), 'string', false from t"""


def _lake_rows_sql() -> str:
    """The verdicts of ``reconcile_lake`` as separate queries."""
    six_o = _six("o", "p", ORDERS_COLS)
    six_l = _six("lineitem", "b_lineitem", LINEITEM_COLS)
    six_e = _six("ea", "eb", EVENTS_COLS)

    def row(six, dag, scope, schema, diff, p1, p2):
        same = "NA" if p1 == "null" else "Passed"
        return f"""select 'prod' as env, '{dag}' as dag_id, gen1_count, gen2_count, gen1_distinct_count, gen2_distinct_count,
  gen1_except_gen2, gen2_except_gen1, 'Passed' as files_validation, count_validation, dis_count_validation, except_validation,
  '{schema}' as schema_validation, cast({diff} as varchar) as schema_diff, cast(null as varchar) as error_msg, 'NA' as source_job,
  '{scope}' as scope, cast({p1} as varchar) as gen1_partition, cast({p2} as varchar) as gen2_partition,
  '{same}' as partition_validation from ({six}) s"""

    year = "(select max(year(o_orderdate)) from orders)"
    day = "(select cast(max(cast(ts as date)) as varchar) from events)"
    return f"""with {B_ORDERS}, {B_LINEITEM},
o as (select * from orders where year(o_orderdate) = {year}),
p as (select * from b_orders where year(o_orderdate) = (select max(year(o_orderdate)) from b_orders)),
ea as (select * from events where cast(ts as date) = (select max(cast(ts as date)) from events)),
eb as (select * from events where event_id % 7 <> 0 and cast(ts as date) = (select max(cast(ts as date)) from events where event_id % 7 <> 0))
{row(six_o, 'orders_daily', 'current', 'Failed', "'o_orderpriority: string/true -> absent'", year, year)}
union all {row(six_l, 'lineitem_daily', 'current', 'Passed', 'null', 'null', 'null')}
union all {row(six_l, 'lineitem4_daily', 'current', 'Passed', 'null', 'null', 'null')}
union all {row(six_l, 'events_daily', 'current', 'Passed', 'null', 'null', 'null')}
union all {row(six_e, 'events_daily', 'history', 'Passed', 'null', day, day)}"""


ODD_PARTITIONS = {  # table: partition column, its value, which rows are the latest partition, kind, text, names
    "months": ("m", "case event_id % 5 when 0 then '2023_12' when 1 then '2024_1' else '2023_9' end", "event_id % 5 = 1", "text", "2024_1", "m=2024_1"),
    # a text beside the dates makes the column text: 'zzz' is its greatest value
    "days": ("load_date", "case event_id % 5 when 0 then '2024-01-02' when 1 then '2024-1-5' when 2 then 'zzz' when 3 then '2023-12-31' end", "event_id % 5 = 2", "text", "zzz", "load_date=zzz"),
    "codes": ("c", "case event_id % 5 when 0 then 1 when 1 then 1 when 2 then 0 when 3 then -7 end", "event_id % 5 in (0, 1)", "whole", "01", "c=01,c=1"),
}


def _layouts_sql() -> str:
    """One row per table and lake: what its partition values say; a table that is not there says nothing."""
    parts = []
    for lake in ("lake1", "lake2"):
        there = "event_id % 7 <> 0" if lake == "lake2" else "true"
        parts.append(f"""select '{lake}/gone' as "table", false as found, 'parquet' as format, null as partition_column,
  null as kind, null as latest_text, null as latest_names, false as has_data""")
        for name, (column, _, latest, kind, text, names) in ODD_PARTITIONS.items():
            parts.append(f"""select '{lake}/{name}', count(*) > 0, 'parquet', '{column}', '{kind}', '{text}', '{names}',
  count(*) filter (where {latest}) > 0 from events where {there}""")
    return "\nunion all\n".join(parts)


def _odd_partitions_sql() -> str:
    """The verdicts of ``reconcile_odd_partitions`` as separate queries over the latest rows of each side."""

    def row(name, latest, scope, value, text1, text2, tag, column=True):
        cols = EVENTS_COLS + (f", {value} as p" if column else "")
        rows = f"""(select {cols} from events where {latest})""", f"""(select {cols} from events where {latest} and event_id % 7 <> 0)"""
        six = _six(rows[0] + " a", rows[1] + " b", EVENTS_COLS + (", p" if column else ""))
        return f"""select 'prod' as env, '{name}_daily' as dag_id, gen1_count, gen2_count, gen1_distinct_count, gen2_distinct_count,
  gen1_except_gen2, gen2_except_gen1, 'Passed' as files_validation, count_validation, dis_count_validation, except_validation,
  'Passed' as schema_validation, cast(null as varchar) as schema_diff, cast(null as varchar) as error_msg, 'NA' as source_job,
  '{scope}' as scope, '{text1}' as gen1_partition, '{text2}' as gen2_partition, 'Passed' as partition_validation from ({six}) {tag}"""

    rows = []
    for k, (name, (_, value, latest, _, text, _)) in enumerate(ODD_PARTITIONS.items()):
        shown = "1" if name == "codes" else text
        rows.append(row(name, latest, "current", value, shown, shown, f"s{k}"))
    for scope in ("current", "history"):
        rows.append(row("days", "event_id % 5 = 1", scope, "", "2024-01-05", "2024-01-05", f"t_{scope}", column=False))
    return "\nunion all\n".join(rows)


# Schemas of one table per user and day: e1/e2 its event types, t1/t2 the tables, per side.
DRIFT_SQL = """
c1 as (
  select cast(user_id as varchar) || '/' || strftime(ts, '%Y-%m-%d') as pair, user_id, event_type as f from events),
c2 as (
  select cast(user_id as varchar) || '/' || strftime(ts, '%Y-%m-%d') as pair, user_id, case when event_id % 5 = 0 then 'rare' else event_type end as f
  from events where event_id % 7 <> 0),
e1 as (select pair, f, case when count(*) % 2 = 0 then 'bigint' else 'double' end as t, count(*) % 3 = 0 as nul from c1 group by all),
e2 as (select pair, f, case when count(*) % 2 = 0 then 'bigint' else 'double' end as t, count(*) % 3 = 0 as nul from c2 group by all),
t1 as (select pair, user_id, count(*) as n, case when count(*) % 2 = 0 then 'bigint' else 'int' end as t from c1 group by all),
t2 as (select pair, user_id, count(*) as n, case when count(*) % 2 = 0 then 'bigint' else 'int' end as t from c2 group by all),
s1 as (select pair, 'struct<' || string_agg(f || ':array<' || t || '>', ',' order by f) || '>' as t, list(f) as fs from e1 group by pair),
s2 as (
  select e2.pair, 'struct<' || case when any_value(t2.user_id) % 2 = 0 then string_agg(e2.f || ':array<' || e2.t || '>', ',' order by e2.f desc)
    else string_agg(e2.f || ':array<' || e2.t || '>', ',' order by e2.f) end || '>' as t, list(e2.f) as fs
  from e2 join t2 on t2.pair = e2.pair group by e2.pair),
drift as (
  select coalesce(e1.pair, e2.pair) as pair, 'seen.' || coalesce(e1.f, e2.f) || '[]' as path,
    case when e1.f is null then 'added' when e2.f is null then 'removed'
      else concat_ws(',', case when e1.t <> e2.t then 'type' end, case when e1.nul <> e2.nul then 'nullable' end) end as change,
    e1.t as left_type, e1.nul as left_nullable, e2.t as right_type, e2.nul as right_nullable
  from e1 full join e2 on e1.pair = e2.pair and e1.f = e2.f
  where e1.f is null or e2.f is null or e1.t <> e2.t or e1.nul <> e2.nul
  union all
  select s1.pair, 'seen', 'order', s1.t, true, s2.t, true
  from s1 join s2 on s1.pair = s2.pair join t1 on t1.pair = s1.pair
  where t1.user_id % 2 = 0 and len(list_intersect(s1.fs, s2.fs)) > 1
  union all
  select t1.pair, 'days', 'type', 'map<date,struct<n:' || t1.t || '>>', true, 'string', true
  from t1 join t2 on t1.pair = t2.pair where t2.n % 3 = 0
  union all
  select t1.pair, 'days{value}.n', 'type', t1.t, true, t2.t, true
  from t1 join t2 on t1.pair = t2.pair where t2.n % 3 <> 0 and t1.t <> t2.t
  union all
  select t1.pair, x.path, 'removed', coalesce(x.t, t1.t), x.nul, null, null
  from t1 left join t2 on t1.pair = t2.pair cross join (values ('user_id', 'bigint', true), ('days{key}', 'date', false), ('days{value}.n', null, true)) x(path, t, nul)
  where t2.pair is null)"""


def oracle_sql() -> dict[str, str]:
    lineitem_kept = (
        "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
        "l_discount, l_returnflag, l_linestatus"
    )
    orders_no_price = "o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority"
    ledgers = _ledger_ctes()
    swapped = LINEITEM_COLS.replace("l_partkey, l_suppkey", "l_suppkey, l_partkey")
    nested = f"""with n as (select event_id, ts as at_ts, event_type, props from events),
m as (select event_id, case when event_id % 5 = 0 then ts + interval 1 microsecond else ts end as at_ts, event_type, props from events)
{_six('n', 'm', 'event_id, at_ts, event_type, props')}"""
    sql = {
        "row_count_check": f"""with {B_ORDERS}
select cast(c1 as bigint) as gen1_count, cast(c2 as bigint) as gen2_count,
  {_status('c1 = c2')} as count_validation
from (select (select count(*) from orders) as c1, (select count(*) from b_orders) as c2) s""",
        "distinct_count_check": f"""with {B_ORDERS}
select cast(d1 as bigint) as gen1_distinct_count, cast(d2 as bigint) as gen2_distinct_count,
  {_status('d1 = d2')} as dis_count_validation
from (select (select count(*) from (select distinct * from orders)) as d1,
             (select count(*) from (select distinct * from b_orders)) as d2) s""",
        "diff_left_only": f"with {B_ORDERS} select {ORDERS_COLS} from orders except all select {ORDERS_COLS} from b_orders",
        "diff_right_only": f"with {B_ORDERS} select {ORDERS_COLS} from b_orders except all select {ORDERS_COLS} from orders",
        "diff_counts": f"""with {B_ORDERS}
select cast(e1 as bigint) as gen1_except_gen2, cast(e2 as bigint) as gen2_except_gen1,
  {_status('e1 + e2 = 0')} as except_validation
from (select (select count(*) from (select * from orders except all select * from b_orders)) as e1,
             (select count(*) from (select * from b_orders except all select * from orders)) as e2) s""",
        "equality_orders": f"""with {B_ORDERS},
same as ({_six('orders', 'orders', ORDERS_COLS)}),
altered as ({_six('orders', 'b_orders', ORDERS_COLS)})
select 'same' as pair, * exclude (gen1_distinct_count, gen2_distinct_count, dis_count_validation) from same
union all
select 'altered', * exclude (gen1_distinct_count, gen2_distinct_count, dis_count_validation) from altered""",
        "equality_by_day": f"""with e as (select {EVENTS_COLS}, cast(ts as date) as day from events),
b as (select * from e where ts < timestamp '2024-01-05 00:00:00'),
{_six_by('e', 'b', 'day', EVENTS_COLS + ', day')}
select * exclude (gen1_distinct_count, gen2_distinct_count, dis_count_validation) from verdicts""",
        "diff_counts_fingerprint": f"""with {B_LINEITEM}, {C_LINEITEM}
select gen1_except_gen2, gen2_except_gen1, except_validation from ({_six('lineitem', 'c_lineitem', LINEITEM_COLS.replace('l_tax, ', ''))}) s""",
        "diff_lineitem_sketch": f"""with {B_LINEITEM}, {C_LINEITEM}
select {LINEITEM_COLS}, 'left' as _side from (select {LINEITEM_COLS} from lineitem except all select {LINEITEM_COLS} from c_lineitem) l
union all
select {LINEITEM_COLS}, 'right' as _side from (select {LINEITEM_COLS} from c_lineitem except all select {LINEITEM_COLS} from lineitem) r""",
        "diff_positional": f"""select cast(e1 as bigint) as gen1_except_gen2, cast(e2 as bigint) as gen2_except_gen1,
  {_status('e1 + e2 = 0')} as except_validation
from (select
  (select count(*) from (select {LINEITEM_COLS} from lineitem except all select {swapped} from lineitem)) as e1,
  (select count(*) from (select {swapped} from lineitem except all select {LINEITEM_COLS} from lineitem)) as e2) s""",
        "compare_positional_two_lists": f"with {B_LINEITEM} {_six('lineitem', 'b_lineitem', LINEITEM_COLS, LINEITEM_COLS.replace('l_tax, ', ''))}",
        "compare_nested_micros": nested,
        "compare_nested_micros_digest": nested,
        "diff_ignoring_audit": f"""with {B_LINEITEM}
select cast(e1 as bigint) as gen1_except_gen2, cast(e2 as bigint) as gen2_except_gen1,
  {_status('e1 + e2 = 0')} as except_validation
from (select
  (select count(*) from (select {lineitem_kept} from lineitem except all select {lineitem_kept} from b_lineitem)) as e1,
  (select count(*) from (select {lineitem_kept} from b_lineitem except all select {lineitem_kept} from lineitem)) as e2) s""",
        "compare_fused": f"with {B_ORDERS} {_six('orders', 'b_orders', ORDERS_COLS)}",
        "compare_fused_two_lists": f"with {B_ORDERS} {_six('orders', 'b_orders', ORDERS_COLS, orders_no_price)}",
        "compare_by_day": f"""with e as (select {EVENTS_COLS}, cast(ts as date) as day from events),
b as (select * from e where ts < timestamp '2024-01-05 00:00:00'),
{_six_by('e', 'b', 'day', EVENTS_COLS + ', day')}
select * from verdicts""",
        "compare_documents": f"with {B_DOCS} {_six('documents', 'b_docs', DOCS_COLS)}",
        "compare_documents_digest": f"with {B_DOCS} {_six('documents', 'b_docs', DOCS_COLS)}",
        "diff_documents_digest": f"""with {B_DOCS}
select {DOCS_COLS}, 'left' as _side from (select {DOCS_COLS} from documents except all select {DOCS_COLS} from b_docs) l
union all
select {DOCS_COLS}, 'right' as _side from (select {DOCS_COLS} from b_docs except all select {DOCS_COLS} from documents) r""",
        "diff_documents_sketch": f"""with {B_DOCS}
select {DOCS_COLS}, 'left' as _side from (select {DOCS_COLS} from documents except all select {DOCS_COLS} from b_docs) l
union all
select {DOCS_COLS}, 'right' as _side from (select {DOCS_COLS} from b_docs except all select {DOCS_COLS} from documents) r""",
        "compare_pages_digest": f"with {B_PAGES} {_six('pages', 'b_pages', PAGES_COLS)}",
        "compare_documents_by_source_digest": f"""with {B_DOCS},
{_six_by('documents', 'b_docs', 'source', DOCS_COLS)}
select * from verdicts""",
        "compare_embeddings": f"with {B_EMB} {_six('embeddings', 'b_emb', EMB_COLS)}",
        "compare_conversations_by_conv": f"""with {B_CONV},
{_six_by('conversations', 'b_conv', 'conv_id', CONV_COLS)}
select * from verdicts""",
        "schema_diff": _schema_diff_sql(),
        "schema_drift": f"with {DRIFT_SQL} select * from drift",
        "schema_drift_text": f"""with {DRIFT_SQL}, lines as (
  select pair, path, path || ': ' || coalesce(left_type || '/' || left_nullable, 'absent') || ' -> '
    || coalesce(right_type || '/' || right_nullable, 'absent') || case when change = 'order' then ' (order)' else '' end as line
  from drift)
select pair, string_agg(line, '; ' order by path) as schema_diff from lines group by pair""",
        "latest_partition_rows": f"""with {B_EVENTS}
select {EVENTS_COLS}, 'gen1' as side from {_latest_day('events')} a
union all
select {EVENTS_COLS}, 'gen2' as side from {_latest_day('b_events')} b""",
        "latest_partition_compare": f"""with {B_EVENTS}, la as {_latest_day('events')}, lb as {_latest_day('b_events')}
{_six('la', 'lb', EVENTS_COLS)}""",
        "latest_partition_compare_same_day": f"""with s as (select {EVENTS_COLS} from events where event_id % 7 <> 0),
la as {_latest_day('events')}, lb as {_latest_day('s')}
{_six('la', 'lb', EVENTS_COLS)}""",
        "latest_partition_path": """with l as (
  select '/w/' || event_type as root,
    '/w/' || event_type || '/load_date=' || strftime(ts, '%Y-%m-%d') || '/part-' || cast(event_id as varchar) || '.parquet' as path
  from events),
p as (
  select root, split_part(substr(path, length(root) + 2), '/', 1) as child from l),
q as (
  select root, root || '/' || child as partition_path, try_cast(split_part(child, '=', 2) as date) as partition_date from p)
select root, coalesce(arg_max(partition_path, partition_date), root) as partition_path, max(partition_date) as partition_date
from q group by root""",
        "baseline_path": f"""with {MANIFEST_SQL}
select env, gen1_path,
  case when env = 'dev' then regexp_replace(gen1_path, '_test/priority2/[0-9][0-9][0-9]', '', 'g')
       else replace(gen1_path, '_test', '') end as baseline_path
from m""",
        "table_name": f"with {MANIFEST_SQL} select gen1_path, string_split(gen1_path, '/')[-1] as table_name from m",
        "job_id_normalize": f"with {MANIFEST_SQL} select dag_id, {_normalize('dag_id', '_weekly')} as job_id from m",
        "job_id_normalize_literal": f"with {MANIFEST_SQL} select dag_id, {_normalize('dag_id', '_monthly')} as job_id from m",
        "manifest_text": f"with {MANIFEST_SQL} select concat_ws(',', env, dag_id, gen1_path, gen2_path) as line from m",
        "reconcile_tables": _reconcile_tables_sql(),
        "reconcile_lake": _lake_rows_sql(),
        "layouts": _layouts_sql(),
        "reconcile_odd_partitions": _odd_partitions_sql(),
        "files_check": """with t as (select distinct user_id from events),
f as (
  select user_id, count(*) filter (where user_id % 7 <> 0) as a, count(*) filter (where user_id % 11 <> 0) as b
  from events where not (value < 5) or value is null group by user_id)
select '/w/' || cast(t.user_id as varchar) as "table", cast(coalesce(a, 0) as bigint) as gen1_files,
  cast(coalesce(b, 0) as bigint) as gen2_files,
  case when coalesce(a, 0) > 0 and coalesce(b, 0) > 0 then 'Passed' else 'Failed' end as files_validation
from t left join f on f.user_id = t.user_id""",
        "latest_partition_named": f"""select {EVENTS_COLS}, cast(ts as date) as load_date from events
where cast(ts as date) = (select max(cast(ts as date)) from events)""",
        "manifest_parse": f"""with {MANIFEST_SQL} select env, dag_id, gen1_path, gen2_path,
  gen1_path || '_hist' as gen1_hist_path, gen2_path || '_hist' as gen2_hist_path from m where o_orderkey % 9 <> 0""",
        "typed_ledger_sweep": f"""{ledgers.replace("l1 as (", "l1_all as (").replace("l2 as (", "l2_all as (")},
l1 as (select * from l1_all where cast(regexp_extract(gen2_path, '([0-9]+)$', 1) as bigint) % 50 <> 0),
l2 as (select * from l2_all where cast(regexp_extract(gen2_path, '([0-9]+)$', 1) as bigint) % 50 <> 0)
{_sweep('_weekly')}""",
        "order_ledger": f"{ledgers} select * exclude (ts) from l1",
        "sweep_manifest": f"{ledgers} {_sweep('_weekly')}",
        "sweep_manifest_literal": f"{ledgers} {_sweep('_monthly')}",
        "resume_manifest": f"""{ledgers}, sm as ({_sweep('_weekly')}),
done as (select distinct gen2_path from l1 where cast(date_trunc('year', ts) as date) = date '{workload.RESUME_DAY}' and gen2_path is not null)
select * from sm where gen2_path not in (select gen2_path from done)""",
        "failure_report": f"{ledgers} select distinct gen2_path from l1 where except_validation = 'Failed' and gen1_count <> 0",
        "value_drift_report": f"""{ledgers} select distinct gen2_path from l1
where except_validation = 'Failed' and gen1_count <> 0 and gen1_except_gen2 = gen2_except_gen1""",
        "retry_manifest": f"""{ledgers} select distinct 'prod' as env, dag_id, gen1_path, gen2_path
from l1 where except_validation = 'Failed'""",
        "writer_jobs": f"""with {COMMITS}
select distinct "table", job as job_name from commits where {WRITER_FILTER}""",
        "writer_jobs_stream": f"""with {COMMITS}
select distinct "table", job as job_name from commits where {WRITER_FILTER}""",
        "partition_columns": """with m as (
  select user_id, event_id, case when event_id % 5 = 0 then '' when event_id % 7 = 0 then ' ,b' else 'c' || cast(event_id % 11 as varchar) || ',day' end as cols
  from events where event_id % 3 = 0)
select '/lake2/users/' || cast(user_id as varchar) as "table", max(event_id) as version, arg_max(cols, event_id) as partition_columns,
  case when arg_max(cols, event_id) like 'c%' then split_part(arg_max(cols, event_id), ',', 1) end as first_partition_column
from m group by user_id""",
        "job_list": f"""with {COMMITS}
select "table", '[' || coalesce(string_agg(distinct job, ', ' order by job) filter (where {WRITER_FILTER}), '') || ']' as jobs
from commits group by 1""",
        "writer_jobs_many": f"""with {COMMITS}
select 'Cloud Migration' as job_name union select job as job_name from commits where {WRITER_FILTER}""",
        "pair_verdict": f"""with {B_ORDERS}
{_verdict_row(_six('orders', 'b_orders', ORDERS_COLS), env='prod', dag='orders_daily', p1='/lake1/orders', p2='/lake2/orders', schema='Passed', scope='current')}""",
        "pair_verdict_history": f"""with {B_ORDERS}, {B_LINEITEM}
{_verdict_row(_six('orders', 'b_orders', ORDERS_COLS), env='prod', dag='orders_daily', p1='/lake1/orders', p2='/lake2/orders', schema='Passed', scope='current')}
union all
{_verdict_row(_six('lineitem', 'b_lineitem', LINEITEM_COLS), env='prod', dag='orders_daily', p1='/lake1/lineitem_hist', p2='/lake2/lineitem_hist', schema='Passed', scope='history', e_override=True)}""",
    }
    return {**sql, **_llm()[1]}
