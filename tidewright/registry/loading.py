"""Sources, sinks, loading jobs, data checks and notes. Written tables go to the shared folder and are read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import notes as nt, quality as ql, risk as rk
from ..plans import etl
from ..session import scratch_path
from ..sources import readers, writers
from . import Tables, register
from .fixtures import FUNNEL_SQL, funnel_raw
from .monitoring import ENRICHED_SQL, RUN, _CALLS, enriched, scoring_calls

_MONTH = "CAST(date_trunc('month', o_orderdate) AS DATE)"


def month(col="o_orderdate"):
    return F.trunc(F.col(col).cast("date"), "month")


# ---- sources ----------------------------------------------------------------

@register("scan_csv_text", f"SELECT user_id, plano, device, etapa, timestamp FROM ({FUNNEL_SQL})")
def _(t: Tables):
    path = scratch_path(t.spark, "funnel_csv")
    writer = funnel_raw(t).write.option("header", True).option("ignoreLeadingWhiteSpace", False)
    writer.option("ignoreTrailingWhiteSpace", False).option("escape", '"').csv(path)
    return readers.csv_text(t.spark, path)


@register("scan_csv_records", "SELECT cast(doc_id AS VARCHAR) AS doc_id, text, lang, source, CASE WHEN doc_id % 2 = 0 THEN cast(n_chars AS VARCHAR) END AS n_chars FROM documents")
def _(t: Tables):
    """Whole texts with their line breaks and quotes, in files whose headers name the columns in different orders; one kind lacks a column."""
    path = scratch_path(t.spark, "texts_csv")
    even, odd = t.documents.where("doc_id % 2 = 0"), t.documents.where("doc_id % 2 = 1")
    for rows in (even.select("doc_id", "text", "lang", "source", "n_chars"), odd.select("source", "text", "doc_id", "lang")):
        rows.write.mode("append").option("header", True).option("escape", '"').option("quoteAll", True).option("emptyValue", "").option(
            "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return readers.csv_records(t.spark, path, ["doc_id", "text", "lang", "source", "n_chars"], split_bytes=1 << 18)


@register("scan_parquet", "SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' GROUP BY ALL")
def _(t: Tables):
    rows = readers.parquet(t.spark, t.path("lineitem")).filter(F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"))


_JSON = "event_id long, user_id long, event_type string, value double"


@register("scan_ndjson", "SELECT event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d') AS dt FROM events")
def _(t: Tables):
    path = scratch_path(t.spark, "events_json")
    dated = t.events.select("event_id", "user_id", "event_type", "value", F.col("ts").cast("date").alias("dt"))
    writers.by_partition(dated, "dt").write.partitionBy("dt").json(path)
    return readers.ndjson(t.spark, path, _JSON).withColumn("dt", F.date_format("dt", "yyyy-MM-dd"))


@register("scan_text_documents", "SELECT concat('kind', item_id % 3, '/', item_id) AS doc_id, concat('kind', item_id % 3) AS type, text AS content FROM benchmark")
def _(t: Tables):
    # One folder per passage: a text file per note is what this reader is for.
    path = scratch_path(t.spark, "notes")
    rows = t.benchmark.select(F.concat(F.lit("kind"), F.col("item_id") % 3).alias("category"), F.col("item_id").alias("stem"), "text")
    rows.write.partitionBy("category", "stem").text(path)
    docs = readers.text_documents(t.spark, path, r"category=([^/]+)/stem=([^/]+)/")
    return docs.select("doc_id", "type", F.regexp_replace("content", "\n$", "").alias("content"))


@register("scan_unprocessed", "SELECT event_id, user_id, event_type FROM events WHERE event_type NOT IN ('view', 'click') ORDER BY ts, event_id LIMIT 10")
def _(t: Tables):
    done = t.events.filter(F.col("event_type").isin("view", "click"))
    return readers.unprocessed(t.events, done, 10).select("event_id", "user_id", "event_type")


# ---- sinks ------------------------------------------------------------------

@register("sink_mark_processed", "SELECT event_type, count(*) AS events, count(*) FILTER (WHERE event_type IN ('view', 'error')) AS processed FROM events GROUP BY event_type")
def _(t: Tables):
    ledger = scratch_path(t.spark, "ledger")
    done = t.events.filter(F.col("event_type").isin("view", "error"))
    writers.mark_processed(done, ledger)
    writers.mark_processed(done, ledger)
    marked = writers.read_ledger(t.spark, ledger).withColumn("_m", F.lit(True))
    return t.events.join(marked, "event_id", "left").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.count("_m").alias("processed")
    )


_STORED = "event_id, source, service, event_type, severity, risk_score, risk_level"


@register("sink_enriched_append", f"{ENRICHED_SQL} SELECT {_STORED}, concat('[\"', replace(recs, '|', '\",\"'), '\"]') AS recommendations FROM enr")
def _(t: Tables):
    path = scratch_path(t.spark, "enriched")
    writers.append(writers.enriched_rows(enriched(t)), path)
    return t.spark.read.parquet(path).select(*_STORED.split(", "), "recommendations")


@register("udf_event_store", f"{ENRICHED_SQL} SELECT service, risk_level, count(*) AS n FROM enr GROUP BY ALL")
def _(t: Tables):
    # An event store is a path handed to the same readers and writers.
    path = scratch_path(t.spark, "store")
    writers.overwrite_table(writers.enriched_rows(enriched(t)), path)
    return readers.parquet(t.spark, path).groupBy("service", "risk_level").agg(F.count(F.lit(1)).alias("n"))


@register("sink_llm_calls_append", f"{_CALLS} SELECT step, model_id, count(*) AS calls, CAST(sum(input_tokens) AS BIGINT) AS tokens FROM calls GROUP BY ALL")
def _(t: Tables):
    path = scratch_path(t.spark, "calls")
    writers.append(scoring_calls(t), path)
    return t.spark.read.parquet(path).groupBy("step", "model_id").agg(F.count(F.lit(1)).alias("calls"), F.sum("input_tokens").alias("tokens"))


def _orders_by_month(t: Tables):
    return t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus", month().alias("dt"))


_BY_MONTH = f"SELECT strftime({_MONTH}, '%Y-%m-%d') AS dt, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1"


def _per_month(df):
    return df.groupBy(F.date_format("dt", "yyyy-MM-dd").alias("dt")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


def _raw_in_turns(t: Tables, fmt: str) -> str:
    """The raw layer in two loads of different dates; the second is repeated and replaces its own dates only."""
    base, rows = scratch_path(t.spark, "lake"), _orders_by_month(t)
    for part in (F.month("dt") <= 6, F.month("dt") > 6, F.month("dt") > 6):
        path = writers.save_raw(rows.filter(part), base, "orders", fmt)
    return path


@register("sink_raw_dated", _BY_MONTH)
def _(t: Tables):
    path = _raw_in_turns(t, "parquet")
    return _per_month(t.spark.read.parquet(path))


@register("sink_raw_format", _BY_MONTH)
def _(t: Tables):
    path = _raw_in_turns(t, "json")
    return _per_month(t.spark.read.schema("o_orderkey long, o_totalprice double, o_orderstatus string, dt date").json(path))


@register("sink_overwrite_table", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def _(t: Tables):
    path = scratch_path(t.spark, "replaced")
    writers.overwrite_table(_orders_by_month(t).withColumn("o_orderstatus", F.lit("old")), path)
    writers.overwrite_table(_orders_by_month(t), path)
    return t.spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@register("sink_overwrite_partition", f"SELECT strftime({_MONTH}, '%Y-%m-%d') AS dt, count(*) AS n, round(sum(CASE WHEN month(o_orderdate) = 3 THEN 2 * o_totalprice ELSE o_totalprice END), 2) AS total FROM orders GROUP BY 1")
def _(t: Tables):
    path = scratch_path(t.spark, "partitions")
    writers.overwrite_partitions(_orders_by_month(t), path)
    march = _orders_by_month(t).filter(F.month("dt") == 3).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    for _ in range(2):  # a rerun replaces the same partitions
        writers.overwrite_partitions(march, path)
    return _per_month(t.spark.read.parquet(path))


_ALERTS = f"{ENRICHED_SQL} SELECT sink, service, count(*) AS alerts, max(risk_score) AS max_score FROM enr, (VALUES ('a'), ('b')) v(sink) WHERE risk_score >= 60 GROUP BY ALL"


def _to_two_sinks(t: Tables, sinks):
    alerts = rk.build_alerts(enriched(t), RUN)
    outcome = writers.emit(alerts, 0, {name: make for name, make in sinks.items()})
    return outcome


@register("sink_alerts", _ALERTS)
def _(t: Tables):
    paths = {name: scratch_path(t.spark, f"alerts_{name}") for name in ("a", "b")}
    outcome = _to_two_sinks(t, {n: writers.table_sink(p) for n, p in paths.items()})
    if any(outcome.values()):
        raise RuntimeError(str(outcome))
    both = [t.spark.read.parquet(p).withColumn("sink", F.lit(n)) for n, p in paths.items()]
    return both[0].unionByName(both[1]).groupBy("sink", "service").agg(F.count(F.lit(1)).alias("alerts"), F.max("risk_score").alias("max_score"))


@register("udf_alert_sink", _ALERTS.replace("('a'), ('b')", "('a')"))
def _(t: Tables):
    path = scratch_path(t.spark, "alerts")

    def refuse(alerts, batch_id):
        raise ConnectionError("no route")

    outcome = _to_two_sinks(t, {"broken": refuse, "a": writers.table_sink(path)})
    if outcome["a"] or not outcome["broken"]:
        raise RuntimeError(str(outcome))
    return t.spark.read.parquet(path).groupBy(F.lit("a").alias("sink"), "service").agg(F.count(F.lit(1)).alias("alerts"), F.max("risk_score").alias("max_score"))


# ---- checks, dead letters, logs ---------------------------------------------

def order_rules():
    return {
        "status": F.col("o_orderstatus").isin("O", "F"),
        "price": F.col("o_totalprice").between(2000.0, 450000.0),
        "priority": F.col("o_orderpriority").rlike("^[1-4]-"),
    }


_ERR = (
    "WITH e AS (SELECT *, list_filter([CASE WHEN o_orderstatus NOT IN ('O', 'F') THEN 'status' END, CASE WHEN NOT (o_totalprice BETWEEN 2000 AND 450000) THEN 'price' END, "
    "CASE WHEN NOT regexp_matches(o_orderpriority, '^[1-4]-') THEN 'priority' END], lambda x: x IS NOT NULL) AS errors FROM orders)"
)


def checked(t: Tables):
    return ql.check(t.orders, order_rules())


@register("validate_records", f"{_ERR} SELECT o_orderkey, array_to_string(errors, ',') AS errors, len(errors) = 0 AS valid FROM e")
def _(t: Tables):
    return checked(t).select("o_orderkey", F.array_join("errors", ",").alias("errors"), (F.size("errors") == 0).alias("valid"))


@register("dead_letter_queue", f"{_ERR} SELECT cast(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, o_orderpriority, array_to_string(errors, ',') AS errors FROM e WHERE len(errors) > 0")
def _(t: Tables):
    return ql.dead_letters(checked(t)).select("o_orderkey", "o_orderstatus", "o_orderpriority", F.array_join("errors", ",").alias("errors"))


@register("job_log_entry", f"{_ERR} SELECT concat('orders_', o_orderstatus) AS job, strftime({_MONTH}, '%Y-%m-%d') AS dt, count(*) FILTER (WHERE len(errors) = 0) AS valid_records, count(*) FILTER (WHERE len(errors) > 0) AS dlq_records, 'ingest_complete' AS event, count(*) FILTER (WHERE len(errors) > 0) = 0 AS success FROM e GROUP BY ALL")
def _(t: Tables):
    rows = checked(t).withColumn("dt", F.date_format(month(), "yyyy-MM-dd"))
    return ql.job_log(rows, "ingest_complete", F.concat(F.lit("orders_"), F.col("o_orderstatus")), "dt")


@register(
    "job_log_written",
    f"{_ERR} SELECT 'load_complete' AS event, 'orders' AS job, count(*) FILTER (WHERE len(errors) = 0) AS valid_records, count(*) FILTER (WHERE len(errors) > 0) AS dlq_records, "
    "count(*) FILTER (WHERE len(errors) > 0) = 0 AS success, true AS compliant, 0 AS missing FROM e",
)
def _(t: Tables):
    """What a job logs of itself while it writes, checked by the rules for log lines."""
    entry = ql.write_checked(checked(t), scratch_path(t.spark, "trusted"), scratch_path(t.spark, "dlq"), "load_complete", "orders")
    judged = ql.log_compliance(entry.withColumn("line", ql.log_line()).drop("job"))
    return judged.select("event", "job", "valid_records", "dlq_records", "success", "compliant", F.size("missing").alias("missing"))


# Log lines of one job per day, some without duration, some claiming success too early.
@register(
    "job_log_compliance",
    f"{_ERR}, l AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS n, count(*) FILTER (WHERE len(errors) > 0) AS dlq FROM e GROUP BY 1) "
    "SELECT concat('orders_', day) AS job, CASE WHEN n % 5 = 0 THEN 'duration_seconds' ELSE '' END AS missing, (dlq < 3) <> (dlq = 0) AS wrong_success, "
    "n % 5 <> 0 AND (dlq < 3) = (dlq = 0) AS compliant FROM l",
)
def _(t: Tables):
    daily = ql.job_log(checked(t).withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd")), "ingest_complete", F.lit("orders"), "day")
    n = F.col("valid_records") + F.col("dlq_records")
    line = F.to_json(F.struct(
        "event", F.concat(F.lit("orders_"), F.col("day")).alias("job"), F.concat("day", F.lit("T07:00:00Z")).alias("timestamp"),
        "valid_records", "dlq_records", F.when(n % 5 != 0, n / 10.0).alias("duration_seconds"), (F.col("dlq_records") < 3).alias("success"),
    ))
    found = ql.log_compliance(daily.select(line.alias("line")))
    return found.select("job", F.array_join("missing", ",").alias("missing"), "wrong_success", "compliant")


@register("enforce_types", "SELECT TRY_CAST(cast(o_orderkey AS VARCHAR) AS BIGINT) AS o_orderkey, TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE cast(o_totalprice AS VARCHAR) END AS DOUBLE) AS o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS dt FROM orders")
def _(t: Tables):
    texts = t.orders.select(
        F.col("o_orderkey").cast("string"), F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt"), "o_orderpriority",
    )
    typed = ql.enforce_types(texts, {"o_orderkey": "bigint", "o_totalprice": "double", "dt": "date"})
    return typed.withColumn("dt", F.date_format("dt", "yyyy-MM-dd"))


@register("add_lineage_columns", "SELECT o_orderkey, 'orders' AS _source, strftime(o_orderdate, '%Y-%m-%d') AS dt, true AS stamped FROM orders")
def _(t: Tables):
    rows = ql.add_lineage(t.orders, "orders", F.col("o_orderdate"))
    return rows.select("o_orderkey", "_source", F.date_format("dt", "yyyy-MM-dd").alias("dt"), F.col("_processed_at").isNotNull().alias("stamped"))


# ---- loading jobs -----------------------------------------------------------

@register("lookup_dimensions", "SELECT o_orderkey, c_mktsegment, c_nationkey FROM orders LEFT JOIN customer ON c_custkey = o_custkey")
def _(t: Tables):
    dim = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey")
    return etl.lookup(t.orders, dim, "o_custkey").select("o_orderkey", "c_mktsegment", "c_nationkey")


def _staging(t: Tables):
    a = t.orders.select(F.col("o_orderkey").alias("orderkey"), F.lit("orders").alias("origin"), F.col("o_totalprice").alias("amount"), F.col("o_custkey"))
    b = t.lineitem.select(F.col("l_orderkey").alias("orderkey"), F.lit("lineitem").alias("origin"), F.col("l_extendedprice").alias("amount"))
    return [a, b]


_STAGE = "SELECT o_orderkey AS orderkey, 'orders' AS origin, o_totalprice AS amount, o_custkey FROM orders UNION ALL SELECT l_orderkey, 'lineitem', l_extendedprice, NULL FROM lineitem"


@register("load_staging_union", f"SELECT origin, count(*) AS n, count(o_custkey) AS with_customer, round(sum(amount), 2) AS amount FROM ({_STAGE}) GROUP BY origin")
def _(t: Tables):
    return etl.load_staging(_staging(t)).groupBy("origin").agg(
        F.count(F.lit(1)).alias("n"), F.count("o_custkey").alias("with_customer"), F.round(F.sum("amount"), 2).alias("amount")
    )


@register("business_day_offset", "SELECT strftime(min(d), '%Y-%m-%d') AS reference_date FROM (SELECT DISTINCT o_orderdate AS d FROM orders WHERE o_orderdate < (SELECT max(o_orderdate) FROM orders) AND isodow(o_orderdate) < 6 ORDER BY d DESC LIMIT 2)")
def _(t: Tables):
    calendar = t.orders.select(F.col("o_orderdate").cast("date").alias("day"))
    calendar = calendar.withColumn("is_business_day", F.weekday("day") < 5)
    today = calendar.select(F.max("day")).scalar()
    return etl.reference_date(calendar, today).select(F.date_format("reference_date", "yyyy-MM-dd").alias("reference_date"))


@register(
    "etl_ingest",
    f"{_ERR} SELECT strftime({_MONTH}, '%Y-%m-%d') AS dt, count(*) AS raw, count(*) FILTER (WHERE len(errors) = 0 OR month(o_orderdate) = 3) AS trusted, "
    "count(*) FILTER (WHERE len(errors) > 0 AND month(o_orderdate) <> 3) AS dlq FROM e GROUP BY 1",
)
def _(t: Tables):
    """Odd months, then even ones, then every March again with its rows mended: only its partitions change."""
    schema = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double"}
    base, of_month = scratch_path(t.spark, "lake"), F.month("o_orderdate")
    mended = t.orders.filter(of_month == 3).withColumns(
        {"o_orderstatus": F.lit("O"), "o_totalprice": F.lit(3000.0), "o_orderpriority": F.lit("1-URGENT")}
    )
    for load in (t.orders.filter(of_month % 2 == 1), t.orders.filter(of_month % 2 == 0), mended):
        paths = etl.ingest(load, base, "orders", order_rules(), schema, month())

    def counts(path, name):
        rows = t.spark.read.parquet(path)
        return rows.groupBy(F.date_format("dt", "yyyy-MM-dd").alias("dt")).agg(F.count(F.lit(1)).alias(name))

    both = counts(paths["raw"], "raw").join(counts(paths["trusted"], "trusted"), "dt", "left").join(counts(paths["dlq"], "dlq"), "dt", "left")
    return both.fillna(0, ["trusted", "dlq"])


_UNDATED = f"CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE {_MONTH} END"


@register(
    "etl_ingest_undated",
    f"{_ERR}, d AS (SELECT *, {_UNDATED} AS dt FROM e), k AS (SELECT * FROM d WHERE dt IS NULL OR dt <> (SELECT min(dt) FROM d)) "
    "SELECT coalesce(strftime(dt, '%Y-%m-%d'), 'none') AS dt, count(*) AS raw, count(*) FILTER (WHERE len(errors) = 0) AS trusted, count(*) FILTER (WHERE len(errors) > 0) AS dlq FROM k GROUP BY 1",
)
def _(t: Tables):
    """Orders without a date among the others, in two loads, the second one twice; then the first month is loaded again and has no rows left."""
    schema = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double"}
    base, odd = scratch_path(t.spark, "lake"), F.month("o_orderdate") % 2 == 1
    dt = F.when(F.col("o_orderkey") % 50 != 0, month())
    first = t.orders.select(F.date_format(F.min(dt), "yyyy-MM-dd")).first()[0]
    for load, dates in ((t.orders.filter(odd), None), (t.orders.filter(~odd), None), (t.orders.filter(~odd), None), (t.orders.filter("false"), [first])):
        paths = etl.ingest(load, base, "orders", order_rules(), schema, dt, dates=dates)

    def counts(path, name):
        rows = t.spark.read.parquet(path)
        return rows.groupBy(F.coalesce(F.date_format("dt", "yyyy-MM-dd"), F.lit("none")).alias("dt")).agg(F.count(F.lit(1)).alias(name))

    both = counts(paths["raw"], "raw").join(counts(paths["trusted"], "trusted"), "dt", "left").join(counts(paths["dlq"], "dlq"), "dt", "left")
    return both.fillna(0, ["trusted", "dlq"])


@register("etl_transform", f"SELECT c_mktsegment, origin, round(sum(amount), 2) AS amount, count(*) AS n FROM ({_STAGE}) LEFT JOIN customer ON c_custkey = o_custkey GROUP BY ALL")
def _(t: Tables):
    dim = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")

    def measures(df):
        return df.groupBy("c_mktsegment", "origin").agg(F.round(F.sum("amount"), 2).alias("amount"), F.count(F.lit(1)).alias("n"))

    return etl.refine(_staging(t), [(dim, "o_custkey")], measures, {"c_mktsegment": "string", "origin": "string", "amount": "double", "n": "bigint"})


# ---- notes ------------------------------------------------------------------

_LINKS = "l AS (SELECT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS target FROM pages)"


def _page_path(url: str) -> str:
    p = f"regexp_replace(regexp_replace(regexp_replace({url}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', ''), '[?#].*$', ''), '/+$', '')"
    return f"CASE WHEN {p} = '' THEN '/' ELSE {p} END"


@register("notes_links", f"WITH {_LINKS} SELECT page_id, target, {_page_path('target')} AS path, count(*) AS n FROM l GROUP BY ALL")
def _(t: Tables):
    found = nt.links(t.pages, "page_id", "html", nt.HREF)
    return found.groupBy("page_id", "target", nt.url_path(F.col("target")).alias("path")).agg(F.count(F.lit(1)).alias("n"))


# The generated pages rarely link to each other by path, so a page is addressed by its section (first path part).
_SECTION = "lower(regexp_extract({}, '^/?([^/]*)', 1))"


@register(
    "notes_orphans",
    f"WITH {_LINKS}, p AS (SELECT page_id, {_SECTION.format('regexp_extract(html, $$<title>(\\S+)$$, 1)')} AS address FROM pages), "
    f"k AS (SELECT page_id, {_SECTION.format('target')} AS address FROM l) SELECT page_id, address FROM p WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.address = p.address AND k.page_id <> p.page_id)",
)
def _(t: Tables):
    first_word = F.lower(F.regexp_extract(F.regexp_extract("html", r"<title>(\S+)", 1), r"^/?([^/]*)", 1))
    pages = t.pages.select("page_id", first_word.alias("address"))
    found = nt.links(t.pages, "page_id", "html", nt.HREF)
    sections = found.select("page_id", F.lower(F.regexp_extract("target", r"^/?([^/]*)", 1)).alias("target"))
    return nt.orphans(pages, "page_id", F.col("address"), sections)


# Notes made of the documents: a path, a title, an alias, and links to other notes in all their forms, one of them broken.
_NOTE_EXPRS = [
    "doc_id", "concat(source, '/', lang, '/Note ', cast(doc_id AS string), '.md') AS path", "concat('Title of ', cast(doc_id AS string)) AS title",
    "concat('N', cast(doc_id AS string)) AS alias",
    "concat(text, ' [[note ', cast((doc_id * 7) % 1009 AS string), '|see]] and [[', source, '/', lang, '/Note ', cast(doc_id - 8 AS string), '#Part 2|', lang, ']], ![[N', "
    "cast((doc_id * 3) % 500 AS string), ']] [[ Title  of ', cast(doc_id AS string), ' ]] [[#Own part]] [[Lost ', source, ']]') AS body",
]
_NOTES_SQL = f"nt AS (SELECT {', '.join(_NOTE_EXPRS)} FROM documents)"
_KEY = "regexp_replace(regexp_replace(trim(regexp_replace(lower({}), '\\s+', ' ', 'g')), '^(\\./|/)+', ''), '\\.md$', '')"
_STEM = "regexp_extract(path, '([^/]*)$', 1)"
_WIKI_SQL = (
    f"WITH {_NOTES_SQL}, f AS (SELECT doc_id, unnest(regexp_extract_all(body, '(!?\\[\\[[^\\[\\]\\n]+\\]\\])', 1)) AS link FROM nt), "
    "g AS (SELECT doc_id, regexp_extract(link, '^(!?)\\[\\[([^#|]*)(?:#([^|]*))?(?:\\|(.*))?\\]\\]$', ['bang', 'target', 'part', 'alias']) AS x FROM f), "
    "l AS (SELECT doc_id, trim(x.target) AS target, nullif(trim(x.part), '') AS part, nullif(trim(x.alias), '') AS alias, x.bang = '!' AS embedded FROM g), "
    f"c AS (SELECT {_KEY.format('path')} AS name, 0 AS rank, doc_id AS page FROM nt UNION ALL SELECT {_KEY.format(_STEM)}, 1, doc_id FROM nt "
    f"UNION ALL SELECT {_KEY.format('title')}, 2, doc_id FROM nt UNION ALL SELECT {_KEY.format('alias')}, 3, doc_id FROM nt), "
    "n AS (SELECT name, page FROM c QUALIFY row_number() OVER (PARTITION BY name ORDER BY rank, page) = 1), "
    f"r AS (SELECT l.*, CASE WHEN {_KEY.format('target')} = '' THEN doc_id ELSE n.page END AS page FROM l LEFT JOIN n ON n.name = {_KEY.format('target')})"
)


def notes(t: Tables):
    return t.documents.selectExpr(*_NOTE_EXPRS)


def resolved_links(t: Tables):
    pages = notes(t).withColumn("aliases", F.array("alias"))
    return nt.resolve(nt.wiki_links(pages, "doc_id", "body"), nt.page_names(pages, "doc_id", "path", "title", "aliases"), "doc_id")


@register("notes_wiki_links", f"{_WIKI_SQL} SELECT doc_id, target, part, alias, embedded, page, count(*) AS n FROM r GROUP BY ALL")
def _(t: Tables):
    return resolved_links(t).groupBy("doc_id", "target", "part", "alias", "embedded", "page").agg(F.count(F.lit(1)).alias("n"))


@register("notes_broken_links", f"{_WIKI_SQL} SELECT target, count(*) AS links, count(DISTINCT doc_id) AS pages FROM r WHERE page IS NULL GROUP BY target")
def _(t: Tables):
    return resolved_links(t).where("page IS NULL").groupBy("target").agg(F.count(F.lit(1)).alias("links"), F.count_distinct("doc_id").alias("pages"))


@register("notes_wiki_orphans", f"{_WIKI_SQL} SELECT doc_id, title FROM nt WHERE doc_id NOT IN (SELECT page FROM r WHERE page IS NOT NULL AND page <> doc_id)")
def _(t: Tables):
    return nt.without_inbound(notes(t), "doc_id", resolved_links(t)).select("doc_id", "title")


_LINE = "CASE WHEN event_type = 'error' THEN concat('note ', event_type) ELSE concat('## [', substr(cast(ts AS string), 1, 10), '] ', event_type, ' | user ', cast(user_id AS string), ' | ', props) END"


@register("notes_log_parse", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, event_type AS operation, concat('user ', user_id, ' | ', props) AS title FROM events WHERE event_type <> 'error'")
def _(t: Tables):
    lines = t.events.selectExpr("event_id", f"{_LINE} AS line")
    return nt.parse_log(lines).drop("line")
