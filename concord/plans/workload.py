"""The registered query catalogue, over the test tables.

Every query reads the given tables (or frames Spark derives from them) and
grows with them. Altered copies ("B" tables) carry changed, missing and
duplicated rows; ledgers for the sweep queries are produced by a grouped
compare of ``lineitem`` against an altered copy, one verdict row per order,
with manifest fields derived from ``orders`` — a lake of one "table" per
order, so the ledger queries run over as many pairs as there are orders.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.functions.job_ids import normalize_job_id
from concord.functions.paths import baseline_path, table_name
from concord.operators.compare import (
    compare,
    diff_counts,
    diff_rows,
    distinct_count_check,
    row_count_check,
)
from concord.operators.partition import latest_partition
from concord.operators.schema import schema_diffs
from concord.operators.schema_tree import drift_text, schema_drift
from concord.operators.sketch import equality
from concord.plans import sweep
from concord.plans.profiles import CURRENT_HISTORY, FINAL, PHASE2, PHASE4, Profile
from concord.plans.reconcile import reconcile
from concord.plans.verdict import verdict_frame
from concord.sources import commit_log, files, layout_source, ledger
from concord.session import ensure_checkpoint_dir
from concord.sources.ledger import conform, typed_counts
from concord.sources.manifest import HISTORY_MANIFEST, manifest_frame, manifest_text, parse_manifest_lines
from concord.streaming import lineage, run_lineage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- altered copies


def orders_b(orders: DataFrame) -> DataFrame:
    """Changed prices (key % 97), missing rows (key % 101), duplicated rows (key % 103)."""
    k = F.col("o_orderkey")
    kept = orders.where(k % 101 != 0).withColumn(
        "o_totalprice",
        F.when(k % 97 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
    )
    return kept.unionByName(orders.where(k % 103 == 0))


def lineitem_b(lineitem: DataFrame) -> DataFrame:
    """Missing rows: every line of orders with key % 101 = 0."""
    return lineitem.where(F.col("l_orderkey") % 101 != 0)


def lineitem_c(lineitem: DataFrame) -> DataFrame:
    """As :func:`lineitem_b`, plus a changed quantity on line 1 of orders with key % 7 = 0."""
    drift = (F.col("l_orderkey") % 7 == 0) & (F.col("l_linenumber") == 1)
    return lineitem_b(lineitem).withColumn(
        "l_quantity", F.when(drift, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    )


def events_b(events: DataFrame) -> DataFrame:
    """A copy that lags behind: nothing from 2024-01-05 on."""
    return events.where(F.col("ts") < F.lit("2024-01-05 00:00:00").cast("timestamp_ntz"))


def documents_b(documents: DataFrame) -> DataFrame:
    """Whole-text edits at the end of the text (id % 13), missing (id % 11), duplicated (id % 17)."""
    k = F.col("doc_id")
    kept = documents.where(k % 11 != 0).withColumn(
        "text", F.when(k % 13 == 0, F.concat(F.col("text"), F.lit("."))).otherwise(F.col("text"))
    )
    return kept.unionByName(documents.where(k % 17 == 0))


def embeddings_b(embeddings: DataFrame) -> DataFrame:
    """Relabelled vectors (id % 9) and missing vectors (id % 10)."""
    k = F.col("vec_id")
    return embeddings.where(k % 10 != 0).withColumn(
        "label", F.when(k % 9 == 0, F.col("label") + 1).otherwise(F.col("label"))
    )


def pages_b(pages: DataFrame) -> DataFrame:
    """Whole-page edits: a trailing newline on pages with id % 9 = 0, pages with id % 13 = 0 missing."""
    k = F.col("page_id")
    return pages.where(k % 13 != 0).withColumn(
        "html", F.when(k % 9 == 0, F.concat(F.col("html"), F.lit("\n"))).otherwise(F.col("html"))
    )


def conversations_b(conversations: DataFrame) -> DataFrame:
    """Last character of every third turn of every fifth conversation dropped; turn 0 of id % 7 missing."""
    drop_last = (F.col("conv_id") % 5 == 0) & (F.col("turn") % 3 == 0)
    text = F.when(drop_last, F.expr("substring(text, 1, length(text) - 1)")).otherwise(F.col("text"))
    return conversations.where(~((F.col("conv_id") % 7 == 0) & (F.col("turn") == 0))).withColumn("text", text)


# ---------------------------------------------------------------- derived manifest / ledgers


def order_manifest(orders: DataFrame) -> DataFrame:
    """One manifest row per order (``o_orderkey`` kept as the join key)."""
    pri = F.col("o_orderpriority")
    tail = (
        F.when(pri == "1-URGENT", "streaming_daily")
        .when(pri == "2-HIGH", "daily")
        .when(pri == "3-MEDIUM", "weekly")
        .when(pri == "4-NOT SPECIFIED", "monthly_weekly")
        .otherwise("lowdaily")
    )
    cust = F.col("o_custkey").cast("string")
    key = F.col("o_orderkey").cast("string")
    test_dir = F.when(
        F.col("o_orderstatus") == "P", F.concat(F.lit("_test/priority2/"), F.format_string("%03d", F.col("o_custkey") % 1000))
    ).otherwise(F.lit(""))
    return orders.select(
        "o_orderkey",
        F.when(pri.isin("1-URGENT", "2-HIGH"), "dev").otherwise("prod").alias("env"),
        F.concat(F.lit("c"), cust, F.lit("_"), tail).alias("dag_id"),
        F.concat(F.lit("/lake1"), test_dir, F.lit("/orders/"), key).alias("gen1_path"),
        F.concat(F.lit("/lake2/orders/"), key).alias("gen2_path"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
    )


def order_ledger(spark: SparkSession, sf_dir: str, run: int = 1) -> DataFrame:
    """Verdict rows per order of ``lineitem`` against an altered copy (run 1: C, run 2: B).

    The grouped compare gives every order's counts in one job; the manifest
    side joins on the order key (both sides hash-partitioned on it).
    """
    li = table(spark, sf_dir, "lineitem")
    other = lineitem_c(li) if run == 1 else lineitem_b(li)
    stats = compare(li, other, by="l_orderkey")
    m = order_manifest(table(spark, sf_dir, "orders"))
    joined = m.join(stats, m["o_orderkey"] == stats["l_orderkey"], "inner")
    return conform(joined, keep=("ts",))


# ---------------------------------------------------------------- queries


def q_row_count_check(spark, sf):
    o = table(spark, sf, "orders")
    return row_count_check(o, orders_b(o))


def q_distinct_count_check(spark, sf):
    o = table(spark, sf, "orders")
    return distinct_count_check(o, orders_b(o))


def q_diff_left_only(spark, sf):
    o = table(spark, sf, "orders")
    d = diff_rows(o, orders_b(o))
    return d.where(F.col("_side") == "left").drop("_side")


def q_diff_right_only(spark, sf):
    o = table(spark, sf, "orders")
    d = diff_rows(o, orders_b(o))
    return d.where(F.col("_side") == "right").drop("_side")


def q_diff_counts(spark, sf):
    o = table(spark, sf, "orders")
    return diff_counts(o, orders_b(o))


def _swapped(df: DataFrame, a: str, b: str) -> DataFrame:
    """``df`` with two columns in each other's place."""
    return df.select(*[{a: b, b: a}.get(c, c) for c in df.columns])


def q_equality_orders(spark, sf):
    """Two equal tables in another order, and two that differ, by their fingerprints."""
    o = table(spark, sf, "orders")
    same = equality(o, o.orderBy(F.desc("o_orderkey"))).withColumn("pair", F.lit("same"))
    return same.unionByName(equality(o, orders_b(o)).withColumn("pair", F.lit("altered")))


def q_equality_by_day(spark, sf):
    """Per day of ``events``: the days that the copy lacks are the only ones that are compared in full."""
    e = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    return equality(e, events_b(e), by="day")


def q_diff_counts_fingerprint(spark, sf):
    li = table(spark, sf, "lineitem")
    return diff_counts(li, lineitem_c(li), ignore=["l_tax"], method="fingerprint")


def q_diff_lineitem_sketch(spark, sf):
    """Both differences of ``lineitem`` from an invertible table sized by the difference."""
    li = table(spark, sf, "lineitem")
    return diff_rows(li, lineitem_c(li), method="sketch")


def q_diff_documents_sketch(spark, sf):
    d = table(spark, sf, "documents")
    return diff_rows(d, documents_b(d), method="sketch")


def q_diff_positional(spark, sf):
    li = table(spark, sf, "lineitem")
    return diff_counts(li, _swapped(li, "l_partkey", "l_suppkey"), align_by="position")


def q_compare_positional_two_lists(spark, sf):
    """By position, the two lists pair columns differently: only the data list leaves out the moved one."""
    li = table(spark, sf, "lineitem")
    right = _swapped(lineitem_b(li), "l_discount", "l_tax")
    return compare(li, right, ignore=["l_tax"], ignore_distinct=[], align_by="position")


def _nested_events(events: DataFrame, shift: bool) -> DataFrame:
    ts = F.col("ts")
    if shift:
        ts = F.when(F.col("event_id") % 5 == 0, ts + F.expr("interval 1 microsecond")).otherwise(ts)
    return events.select("event_id", F.struct(ts.alias("at"), F.array("event_type", "props").alias("tags")).alias("what"))


def q_compare_nested_micros(spark, sf):
    ev = table(spark, sf, "events")
    return compare(_nested_events(ev, False), _nested_events(ev, True))


def q_compare_nested_micros_digest(spark, sf):
    ev = table(spark, sf, "events")
    return compare(_nested_events(ev, False), _nested_events(ev, True), method="digest")


def q_diff_ignoring_audit(spark, sf):
    li = table(spark, sf, "lineitem")
    return diff_counts(li, lineitem_b(li), ignore=["l_tax", "L_SHIPDATE", "no_such_column"])


def q_compare_fused(spark, sf):
    o = table(spark, sf, "orders")
    return compare(o, orders_b(o))


def q_compare_fused_two_lists(spark, sf):
    o = table(spark, sf, "orders")
    return compare(o, orders_b(o), ignore=["o_totalprice"], ignore_distinct=[])


def q_compare_by_day(spark, sf):
    e = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    return compare(e, events_b(e), by="day")


def q_compare_documents(spark, sf):
    d = table(spark, sf, "documents")
    return compare(d, documents_b(d))


def q_compare_documents_digest(spark, sf):
    d = table(spark, sf, "documents")
    return compare(d, documents_b(d), method="digest")


def q_diff_documents_digest(spark, sf):
    d = table(spark, sf, "documents")
    return diff_rows(d, documents_b(d), method="digest")


def q_compare_pages_digest(spark, sf):
    p = table(spark, sf, "pages")
    return compare(p, pages_b(p), method="digest")


def q_compare_documents_by_source_digest(spark, sf):
    d = table(spark, sf, "documents")
    return compare(d, documents_b(d), by="source", method="digest")


def q_compare_embeddings(spark, sf):
    e = table(spark, sf, "embeddings")
    return compare(e, embeddings_b(e))


def q_compare_conversations_by_conv(spark, sf):
    c = table(spark, sf, "conversations")
    return compare(c, conversations_b(c), by="conv_id")


def q_schema_diff(spark, sf):
    """Every given table against a copy with its first column as text, its last one gone, one renamed in case, one more."""
    pairs = {}
    for name in TABLES:
        t = table(spark, sf, name)
        first, last = t.columns[0], t.columns[-1]
        changed = t.withColumn(first, F.col(first).cast("string")).drop(last).withColumnRenamed(first, first.upper())
        pairs[name] = (t, changed.withColumn("zz_extra", F.lit("x")))
    return schema_diffs(spark, pairs)


def event_schemas(events: DataFrame, lake: str) -> DataFrame:
    """``table, schema`` of one nested table per user and day, whose fields and types follow from the events of that day.

    ``seen`` has one array per type of event, ``days`` counts them all; on ``lake2`` the
    fields come in another order for even users, and where the count is a
    multiple of three ``days`` is text.
    """
    name = F.concat_ws("/", F.lit(f"/{lake}"), F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd"))
    n = F.col("n")
    element = F.concat(
        F.lit('{"name":"'), F.col("event_type"), F.lit('","type":{"type":"array","elementType":"'), F.when(n % 2 == 0, "long").otherwise("double"),
        F.lit('","containsNull":'), (n % 3 == 0).cast("string"), F.lit('},"nullable":true,"metadata":{}}'),
    )
    per_type = events.groupBy(name.alias("table"), "user_id", "event_type").agg(F.count("*").alias("n"))
    per_table = per_type.groupBy("table", "user_id").agg(F.sum("n").alias("n"), F.sort_array(F.collect_list(element)).alias("seen"))
    seen = F.when((F.lit(lake) == "lake2") & (F.col("user_id") % 2 == 0), F.reverse("seen")).otherwise(F.col("seen"))
    counted = F.concat(
        F.lit('{"type":"map","keyType":"date","valueType":{"type":"struct","fields":[{"name":"n","type":"'),
        F.when(n % 2 == 0, "long").otherwise("integer"), F.lit('","nullable":true,"metadata":{}}]},"valueContainsNull":true}'),
    )
    days = F.when((F.lit(lake) == "lake2") & (n % 3 == 0), '"string"').otherwise(counted)
    field = lambda of, t: F.concat(F.lit(f'{{"name":"{of}","type":'), t, F.lit(',"nullable":true,"metadata":{}}'))
    fields = [
        field("USER_ID" if lake == "lake2" else "user_id", F.lit('"long"')),
        field("seen", F.concat(F.lit('{"type":"struct","fields":['), F.array_join(seen, ","), F.lit("]}"))),
        field("days", days),
    ]
    return per_table.select("table", F.concat(F.lit('{"type":"struct","fields":['), F.concat_ws(",", *fields), F.lit("]}")).alias("schema"))


def event_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift of every pair of such tables; a seventh of the events is missing on ``lake2``, and some have another type."""
    ev = table(spark, sf_dir, "events")
    changed = ev.where("event_id % 7 <> 0").withColumn("event_type", F.when(F.col("event_id") % 5 == 0, "rare").otherwise(F.col("event_type")))
    name = F.concat_ws("/", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd"))
    side = lambda lake: F.concat(F.lit(f"/{lake}/"), "pair")
    pairs = ev.select(name.alias("pair")).distinct().select("pair", side("lake1").alias("left"), side("lake2").alias("right"))
    return schema_drift(pairs, event_schemas(ev, "lake1").unionByName(event_schemas(changed, "lake2")))


def q_schema_drift(spark, sf):
    return event_drift(spark, sf).drop("left", "right")


def q_schema_drift_text(spark, sf):
    return drift_text(event_drift(spark, sf)).drop("left", "right")


def q_latest_partition_rows(spark, sf):
    e = table(spark, sf, "events")
    day = F.to_date("ts")
    a = latest_partition(e, day).withColumn("side", F.lit("gen1"))
    b = latest_partition(events_b(e), day).withColumn("side", F.lit("gen2"))
    return a.unionByName(b)


def q_latest_partition_compare(spark, sf):
    e = table(spark, sf, "events")
    day = F.to_date("ts")
    return compare(latest_partition(e, day), latest_partition(events_b(e), day))


def q_latest_partition_compare_same_day(spark, sf):
    e = table(spark, sf, "events")
    day = F.to_date("ts")
    return compare(latest_partition(e, day), latest_partition(e.where(F.col("event_id") % 7 != 0), day))


def events_listing(events: DataFrame) -> DataFrame:
    """The file listing ``events`` would have if written per type and day (``root, path``)."""
    root = F.concat(F.lit("/w/"), F.col("event_type"))
    path = F.concat(
        root,
        F.lit("/load_date="),
        F.date_format("ts", "yyyy-MM-dd"),
        F.lit("/part-"),
        F.col("event_id").cast("string"),
        F.lit(".parquet"),
    )
    return events.select(root.alias("root"), path.alias("path"))


def q_latest_partition_path(spark, sf):
    return files.latest_partition_dirs(events_listing(table(spark, sf, "events")))


def q_files_check(spark, sf):
    """One table per user: the files that its events would be on either side, markers and lost files included."""
    ev, key = table(spark, sf, "events"), F.col("event_id")
    name = F.concat(F.lit("/w/"), F.col("user_id").cast("string"))

    def files_of(side: str, lost: int):
        marker = F.when(F.col("value") < 5, F.lit("/_SUCCESS")).otherwise(F.concat(F.lit("/part-"), key.cast("string"), F.lit(".parquet")))
        there = ev.where(F.col("user_id") % lost != 0)
        return there.select(name.alias("table"), F.lit(side).alias("side"), F.concat(name, marker).alias("path"))

    tables = ev.select(name.alias("table")).distinct()
    return files.files_verdict(tables, files_of("gen1", 7).unionByName(files_of("gen2", 11)))


def q_latest_partition_named(spark, sf):
    """The latest partition by a column whose name is only known at run time."""
    ev = table(spark, sf, "events").withColumn("load date", F.to_date("ts"))
    return latest_partition(ev, ev.columns[-1]).withColumnRenamed("load date", "load_date")


def q_baseline_path(spark, sf):
    m = order_manifest(table(spark, sf, "orders"))
    return m.select("env", "gen1_path", baseline_path("env", "gen1_path").alias("baseline_path"))


def q_table_name(spark, sf):
    m = order_manifest(table(spark, sf, "orders"))
    return m.select("gen1_path", table_name("gen1_path").alias("table_name"))


def q_job_id_normalize(spark, sf):
    m = order_manifest(table(spark, sf, "orders"))
    return m.select("dag_id", normalize_job_id("dag_id").alias("job_id"))


def q_job_id_normalize_literal(spark, sf):
    m = order_manifest(table(spark, sf, "orders"))
    return m.select("dag_id", normalize_job_id("dag_id", "literal").alias("job_id"))


def q_manifest_text(spark, sf):
    m = order_manifest(table(spark, sf, "orders")).drop("o_orderkey", "ts")
    return manifest_text(m)


def q_manifest_parse(spark, sf):
    """Six-field manifest lines, some without a separator, read back into columns."""
    m = order_manifest(table(spark, sf, "orders"))
    hist = [F.concat(c, F.lit("_hist")) for c in ("gen1_path", "gen2_path")]
    line = F.concat_ws(",", "env", "dag_id", "gen1_path", "gen2_path", *hist)
    lines = m.select(F.when(F.col("o_orderkey") % 9 == 0, F.col("dag_id")).otherwise(line).alias("value"))
    return parse_manifest_lines(lines, HISTORY_MANIFEST)


TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def q_reconcile_tables(spark, sf):
    """The path-level runner over every given table (each against itself), without paths in the output."""
    base = sf.rstrip("/")
    rows = [("prod", f"{t}_daily", f"{base}/{t}.parquet", f"{base}/{t}.parquet") for t in TABLES]
    verdicts = reconcile(spark, manifest_frame(spark, rows), PHASE2, concurrency=4)
    return verdicts.drop("gen1_path", "gen2_path", "run_id")


def q_reconcile_lake(spark, sf):
    """The path-level runner over pairs that differ: written copies, latest partitions, schema drift, history."""
    root = f"{ensure_checkpoint_dir(spark)}/concord-lake-{uuid.uuid4().hex}"
    o, li, ev = (table(spark, sf, t) for t in ("orders", "lineitem", "events"))
    year, day = F.year("o_orderdate").alias("load_year"), F.to_date("ts").alias("load_date")
    o.select("*", year).write.partitionBy("load_year").parquet(f"{root}/lake1_test/orders")
    orders_b(o).select("*", year).write.partitionBy("load_year").parquet(f"{root}/lake2/orders")
    o.select("*", year).drop("o_orderpriority").write.partitionBy("load_year").parquet(f"{root}/lake1/orders")
    li.write.parquet(f"{root}/lake1/lineitem")
    lineitem_b(li).write.parquet(f"{root}/lake2/lineitem")
    ev.select("*", day).write.partitionBy("load_date").parquet(f"{root}/lake1/events")
    ev.select("*", day).where("event_id % 7 <> 0").write.partitionBy("load_date").parquet(f"{root}/lake2/events")

    def run(profile, *rows, history=False):
        paths = [("prod", f"{a}_daily", *[f"{root}/{p}" for p in ps]) for a, ps in rows]
        return reconcile(spark, manifest_frame(spark, paths, history=history), profile, history=history)

    final = run(FINAL, ("orders", ("lake1_test/orders", "lake2/orders")), ("lineitem", ("lake1/lineitem", "lake2/lineitem")))
    phase4 = run(PHASE4, ("lineitem4", ("lake1/lineitem", "lake2/lineitem")))
    both = run(CURRENT_HISTORY, ("events", ("lake1/lineitem", "lake2/lineitem", "lake1/events", "lake2/events")), history=True)
    return final.unionByName(phase4).unionByName(both).drop("gen1_path", "gen2_path", "run_id")


def odd_partitions(spark: SparkSession, sf_dir: str) -> str:
    """Tables of ``events`` on two lakes whose latest partitions are easily missed; returns the folder.

    ``months``: text months whose order is not that of numbers; ``days``: days
    without leading zeros, beside a non-date and a null day; ``codes``: one number
    written in two ways. On the second lake a seventh of the rows is missing.
    """
    root = f"{ensure_checkpoint_dir(spark)}/concord-odd-{uuid.uuid4().hex}"
    ev = table(spark, sf_dir, "events")
    k = F.col("event_id") % 5
    columns = {
        "months": ("m", F.when(k == 0, "2023_12").when(k == 1, "2024_1").otherwise("2023_9")),
        "days": ("load_date", F.when(k == 0, "2024-01-02").when(k == 1, "2024-1-5").when(k == 2, "zzz").when(k == 3, "2023-12-31")),
        "codes": ("c", F.when(k == 0, "1").when(k == 1, "01").when(k == 2, "0").when(k == 3, "-7")),
    }
    for lake, rows in (("lake1", ev), ("lake2", ev.where("event_id % 7 <> 0"))):
        for name, (column, value) in columns.items():
            rows.withColumn(column, value).write.partitionBy(column).parquet(f"{root}/{lake}/{name}")
    return root


def q_layouts(spark, sf):
    """Format, partition column, latest partition and presence of data of written tables, in one job for all roots."""
    root = odd_partitions(spark, sf)
    roots = [f"{root}/{lake}/{t}" for lake in ("lake1", "lake2") for t in ("months", "days", "codes", "gone")]
    listing = layout_source.children(spark, roots, per_task=2)
    wanted = spark.createDataFrame([(r, r) for r in roots], "lead string, root string")
    found = layout_source.resolved(spark, listing, wanted)
    folders = found.where("found").select(F.concat("root", F.lit("/"), F.get("latest_names", 0)).alias("folder"))
    with_data = layout_source.first_files(spark, [r["folder"] for r in folders.collect()])  # one row per table
    first = with_data.select(F.regexp_replace("root", "/[^/]*$", "").alias("root"), F.col("first_file").isNotNull().alias("has_data"))
    return found.join(first, "root", "left").select(
        F.regexp_extract("root", "(lake.*)$", 1).alias("table"),
        "found",
        "format",
        F.col("column").alias("partition_column"),
        "kind",
        "latest_text",
        F.array_join("latest_names", ",").alias("latest_names"),
        F.coalesce("has_data", F.lit(False)).alias("has_data"),
    )


def q_reconcile_odd_partitions(spark, sf):
    """The runner over the same tables, by partition column and by date: unequal latest partitions are reported."""
    root = odd_partitions(spark, sf)

    def run(profile, tables, history=False):
        paths = [("prod", f"{t}_daily", *[f"{root}/{lake}/{t}" for lake in ("lake1", "lake2")] * (2 if history else 1)) for t in tables]
        return reconcile(spark, manifest_frame(spark, paths, history=history), profile, history=history)

    columns = run(PHASE2, ("months", "days", "codes"))
    dates = run(CURRENT_HISTORY, ("days",), history=True)
    return columns.unionByName(dates).drop("gen1_path", "gen2_path", "run_id")


def q_order_ledger(spark, sf):
    return order_ledger(spark, sf, 1).drop("ts")


def q_sweep_manifest(spark, sf):
    return sweep.sweep_manifest(order_ledger(spark, sf, 1), order_ledger(spark, sf, 2))


def q_typed_ledger_sweep(spark, sf):
    """The sweep over ledgers that hold counts as text, some of them no numbers."""

    def as_text(ledger: DataFrame) -> DataFrame:
        lost = F.regexp_extract("gen2_path", r"(\d+)$", 1).cast("bigint") % 50 == 0
        text = {c: F.when(lost, F.lit("n/a")).otherwise(F.col(c).cast("string")) for c in ("gen1_count", "gen2_count")}
        return ledger.withColumns(text)

    first, second = (typed_counts(as_text(order_ledger(spark, sf, run))) for run in (1, 2))
    return sweep.sweep_manifest(first, second)


def q_sweep_manifest_literal(spark, sf):
    return sweep.sweep_manifest(order_ledger(spark, sf, 1), order_ledger(spark, sf, 2), rules="literal")


RESUME_DAY = "1996-01-01"  # ledgers are stamped with the first day of the order's year: a day holds a seventh


def q_resume_manifest(spark, sf):
    """The sweep without the pairs of one day, over a ledger that is written by day and read back."""
    path = f"{ensure_checkpoint_dir(spark)}/concord-by-day-{uuid.uuid4().hex}"
    ledger.write_by_day(order_ledger(spark, sf, 1).withColumn("ts", F.date_trunc("year", "ts")), path)
    first = ledger.read(spark, path)
    manifest = sweep.sweep_manifest(first, order_ledger(spark, sf, 2))
    return sweep.resume_manifest(manifest, first, RESUME_DAY)


def q_failure_report(spark, sf):
    return sweep.failure_report(order_ledger(spark, sf, 1))


def q_value_drift_report(spark, sf):
    return sweep.value_drift_report(order_ledger(spark, sf, 1))


def q_retry_manifest(spark, sf):
    return sweep.retry_manifest(order_ledger(spark, sf, 1))


def event_commits(events: DataFrame) -> DataFrame:
    """A commit log shaped like Delta's, one commit per event (``table, version_file, commitInfo``)."""
    et = F.col("event_type")
    job = (
        F.when(et == "error", F.lit("Cloud Migration"))
        .when(et == "signup", F.lit("my spark task"))
        .when(F.col("value") < 5, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("load_"), et, F.lit("_u"), F.col("user_id").cast("string")))
    )
    return events.select(
        F.concat(F.lit("/lake2/events/"), et).alias("table"),
        F.format_string("%020d.json", F.col("event_id")).alias("version_file"),
        F.struct(
            F.col("event_id").alias("timestamp"),
            F.lit("WRITE").alias("operation"),
            F.struct(job.alias("jobName")).alias("job"),
        ).alias("commitInfo"),
    )


def q_writer_jobs(spark, sf):
    return commit_log.writer_jobs(event_commits(table(spark, sf, "events")))


def event_metadata(events: DataFrame) -> DataFrame:
    """Log actions of one table per user: every third sets its partition columns, in commits and checkpoints of two parts."""
    k = F.col("event_id")
    name = F.format_string("%020d", k)
    file = F.when(k % 2 == 0, F.concat(name, F.lit(".json"))).otherwise(F.concat(name, F.lit(".checkpoint.0000000001.0000000002.parquet")))
    columns = F.when(k % 5 == 0, F.array().cast("array<string>")).when(k % 7 == 0, F.array(F.lit(" "), F.lit("b"))).otherwise(F.array(F.concat(F.lit("c"), (k % 11).cast("string")), F.lit("day")))
    return events.select(
        F.concat(F.lit("/lake2/users/"), F.col("user_id").cast("string")).alias("table"),
        file.alias("version_file"),
        F.when(k % 3 == 0, F.struct(columns.alias("partitionColumns"))).alias("metaData"),
    )


def q_partition_columns(spark, sf):
    """Current partition columns of every table by one reduction over its log."""
    found = commit_log.table_metadata(event_metadata(table(spark, sf, "events")))
    return found.withColumn("partition_columns", F.array_join("partition_columns", ","))


def q_job_list(spark, sf):
    """Writer jobs of every table as text."""
    return commit_log.job_lists(event_commits(table(spark, sf, "events")))


def q_writer_jobs_many(spark, sf):
    return commit_log.writer_jobs_many(event_commits(table(spark, sf, "events")))


def q_writer_jobs_stream(spark, sf):
    """Writer jobs by the stream over written commit logs, which grow between its two runs."""
    root = f"{ensure_checkpoint_dir(spark)}/concord-logs-{uuid.uuid4().hex}"
    commits = event_commits(table(spark, sf, "events"))
    tables = [r["table"] for r in commits.select("table").distinct().collect()]  # one per type of event
    for part in (0, 1):
        for t in tables:
            own = commits.where((F.col("table") == t) & (F.col("commitInfo.timestamp") % 2 == part))
            own.select("commitInfo").write.mode("append").json(f"{root}{t}/_delta_log")
        run_lineage(spark, f"{root}/lake2/events/*", f"{root}/report")
    found = lineage(spark, f"{root}/report")
    return found.withColumn("table", F.regexp_extract("table", "(/lake2/.*)$", 1))


def q_pair_verdict(spark, sf):
    o = table(spark, sf, "orders")
    return verdict_frame(
        o,
        orders_b(o),
        profile=FINAL,
        env="prod",
        dag_id="orders_daily",
        gen1_path="/lake1/orders",
        gen2_path="/lake2/orders",
        baseline=o,
    )


def q_pair_verdict_history(spark, sf):
    o = table(spark, sf, "orders")
    li = table(spark, sf, "lineitem")
    profile: Profile = CURRENT_HISTORY
    cur = verdict_frame(
        o, orders_b(o), profile=profile, env="prod", dag_id="orders_daily",
        gen1_path="/lake1/orders", gen2_path="/lake2/orders", baseline=o, scope="current",
    )
    hist = verdict_frame(
        li, lineitem_b(li), profile=profile, env="prod", dag_id="orders_daily",
        gen1_path="/lake1/lineitem_hist", gen2_path="/lake2/lineitem_hist", baseline=li,
        scope="history", data_check=False,
    )
    return cur.unionByName(hist)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "row_count_check": q_row_count_check,
    "distinct_count_check": q_distinct_count_check,
    "diff_left_only": q_diff_left_only,
    "diff_right_only": q_diff_right_only,
    "diff_counts": q_diff_counts,
    "equality_orders": q_equality_orders,
    "equality_by_day": q_equality_by_day,
    "diff_counts_fingerprint": q_diff_counts_fingerprint,
    "diff_lineitem_sketch": q_diff_lineitem_sketch,
    "diff_documents_sketch": q_diff_documents_sketch,
    "diff_positional": q_diff_positional,
    "compare_positional_two_lists": q_compare_positional_two_lists,
    "compare_nested_micros": q_compare_nested_micros,
    "compare_nested_micros_digest": q_compare_nested_micros_digest,
    "diff_ignoring_audit": q_diff_ignoring_audit,
    "compare_fused": q_compare_fused,
    "compare_fused_two_lists": q_compare_fused_two_lists,
    "compare_by_day": q_compare_by_day,
    "compare_documents": q_compare_documents,
    "compare_documents_digest": q_compare_documents_digest,
    "diff_documents_digest": q_diff_documents_digest,
    "compare_pages_digest": q_compare_pages_digest,
    "compare_documents_by_source_digest": q_compare_documents_by_source_digest,
    "compare_embeddings": q_compare_embeddings,
    "compare_conversations_by_conv": q_compare_conversations_by_conv,
    "schema_diff": q_schema_diff,
    "schema_drift": q_schema_drift,
    "schema_drift_text": q_schema_drift_text,
    "latest_partition_rows": q_latest_partition_rows,
    "latest_partition_compare": q_latest_partition_compare,
    "latest_partition_compare_same_day": q_latest_partition_compare_same_day,
    "latest_partition_path": q_latest_partition_path,
    "files_check": q_files_check,
    "latest_partition_named": q_latest_partition_named,
    "baseline_path": q_baseline_path,
    "table_name": q_table_name,
    "job_id_normalize": q_job_id_normalize,
    "job_id_normalize_literal": q_job_id_normalize_literal,
    "manifest_text": q_manifest_text,
    "manifest_parse": q_manifest_parse,
    "reconcile_tables": q_reconcile_tables,
    "reconcile_lake": q_reconcile_lake,
    "layouts": q_layouts,
    "reconcile_odd_partitions": q_reconcile_odd_partitions,
    "order_ledger": q_order_ledger,
    "sweep_manifest": q_sweep_manifest,
    "typed_ledger_sweep": q_typed_ledger_sweep,
    "sweep_manifest_literal": q_sweep_manifest_literal,
    "resume_manifest": q_resume_manifest,
    "failure_report": q_failure_report,
    "value_drift_report": q_value_drift_report,
    "retry_manifest": q_retry_manifest,
    "writer_jobs": q_writer_jobs,
    "writer_jobs_many": q_writer_jobs_many,
    "writer_jobs_stream": q_writer_jobs_stream,
    "partition_columns": q_partition_columns,
    "job_list": q_job_list,
    "pair_verdict": q_pair_verdict,
    "pair_verdict_history": q_pair_verdict_history,
}
