"""Inputs the test tables do not carry, derived row by row from the ones they do.

Each derivation is a list of SQL expressions that read the same in Spark and in
the checking engine, so both sides start from identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from . import Tables

# ---- funnel: one unit per user and day, all columns as text -----------------

_TS = "cast(ts AS string)"
_Y, _M, _D = (f"substr({_TS}, {a}, {n})" for a, n in ((1, 4), (6, 2), (9, 2)))
_HMS, _HM = f"substr({_TS}, 12, 8)", f"substr({_TS}, 12, 5)"
_K = "cast(regexp_extract(props, '[0-9]+', 0) AS int)"

FUNNEL_EXPRS = [
    f"concat(' ', cast(user_id AS string), '-', {_Y}, {_M}, {_D}, '  ') AS user_id",
    "concat(' ', c_mktsegment) AS plano",
    f"CASE {_K} % 4 WHEN 0 THEN ' Web' WHEN 1 THEN 'IOS ' WHEN 2 THEN 'android' ELSE ' ' END AS device",
    "CASE event_type WHEN 'signup' THEN ' Cadastro' WHEN 'view' THEN 'onboarding_inicio ' "
    "WHEN 'click' THEN 'ONBOARDING_COMPLETO' WHEN 'purchase' THEN 'ativacao' "
    "ELSE CASE WHEN value < 60 THEN 'exportacao' ELSE 'falha' END END AS etapa",
    f"CASE event_id % 8 WHEN 0 THEN concat({_D}, '/', {_M}, '/', {_Y}, ' ', {_HMS}) "
    f"WHEN 1 THEN concat({_Y}, '-', {_M}, '-', {_D}, ' ', {_HMS}) "
    f"WHEN 2 THEN concat({_Y}, '-', {_M}, '-', {_D}, 'T', {_HMS}) "
    f"WHEN 3 THEN concat({_Y}, '/', {_M}, '/', {_D}, ' ', {_HM}) "
    f"WHEN 4 THEN concat({_D}, '/', {_M}, '/', {_Y}) "
    f"WHEN 5 THEN concat({_Y}, '-', {_M}, '-', {_D}) "
    f"WHEN 6 THEN concat({_Y}, '/', {_M}, '/', {_D}) ELSE NULL END AS timestamp",
]

FUNNEL_SQL = f"SELECT {', '.join(FUNNEL_EXPRS)} FROM events JOIN customer ON user_id = c_custkey"


def funnel_raw(t: Tables) -> DataFrame:
    from pyspark.sql import functions as F

    customer = t.customer.select("c_custkey", "c_mktsegment")
    joined = t.wide("events", "event_id").join(customer, F.col("user_id") == F.col("c_custkey"))
    return joined.selectExpr(*FUNNEL_EXPRS)


# ---- monitoring: raw events -------------------------------------------------

_SERVICES = ["checkout", "payments", "auth", "inventory", "api-gateway", "frontend", "search-indexer"]
_SOURCES = ["cloud_logging", "application", "deploy"]
_PAYLOADS = [
    "ERROR worker raised NullPointerException while pricing a cart",
    "CRITICAL gateway timeout after 9000 ms, answered HTTP 504",
    "CRITICAL container OOMKilled: memory limit of 2 GiB exceeded",
    "Deploy of build 4127 finished, rollback is not needed",
    "INFO health check passed, all replicas ready",
    "warning: p99 latency above target for five minutes",
    "cpu usage at 97 percent, requests are slow",
    "request failed with HTTP 500, upstream answered ECONNREFUSED",
    "nightly report was written to storage",
    "FATAL panic in scheduler loop; the stack was dumped to the log and the process was restarted by the "
    "supervisor, after which the queue of pending jobs was read again from the last saved position and "
    "all workers were told to reconnect before they accept new work",
]


def _case(index: str, values: list[str]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {index} {arms} END"


RAW_EVENT_EXPRS = [
    "event_id",
    "ts",
    f"{_case('event_id % 3', _SOURCES)} AS source",
    f"{_case('user_id % 7', _SERVICES)} AS service",
    f"concat({_case('(event_id + user_id) % 10', _PAYLOADS)}, ' [', event_type, ']') AS raw_payload",
    "props AS metadata",
]

RAW_EVENT_SQL = f"SELECT {', '.join(RAW_EVENT_EXPRS)} FROM events"


def raw_events(t: Tables) -> DataFrame:
    return t.wide("events", "event_id").selectExpr(*RAW_EVENT_EXPRS)


# ---- card transactions ------------------------------------------------------

TX_EXPRS = [
    "cast(l_orderkey * 8 + l_linenumber AS bigint) AS tx_id",
    "l_returnflag AS perfil_simulado",
    "s_name AS merchant",
    "p_name AS descricao",
    "CASE l_linestatus WHEN 'O' THEN 'online' ELSE 'pos' END AS canal",
    "CASE WHEN l_discount > 0.05 THEN 'nao' ELSE 'sim' END AS cartao_presente",
    "CASE WHEN l_tax > 0.04 THEN 'alto' ELSE 'baixo' END AS risco_device",
    "n_name AS pais",
    "p_brand AS cidade",
    "cast((l_linenumber * 5 + l_partkey) % 24 AS int) AS hora",
    "l_extendedprice AS valor",
]

TX_SQL = (
    f"SELECT {', '.join(TX_EXPRS)} FROM lineitem JOIN part ON l_partkey = p_partkey "
    "JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"
)


def transactions(t: Tables) -> DataFrame:
    from pyspark.sql import functions as F

    return (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .selectExpr(*TX_EXPRS)
    )


# ---- clustered vectors: given label as cluster, a made-up fraud flag ---------

CLUSTERED_EXPRS = [
    "vec_id",
    "label AS cluster",
    "CASE WHEN vec_id % 10 < label THEN 1 ELSE 0 END AS fraude",
    "concat('merchant ', cast(vec_id % 37 AS string)) AS merchant",
    "cast((vec_id * 37) % 1009 AS double) AS valor",
    "embedding",
]
CLUSTERED_SQL = f"SELECT {', '.join(CLUSTERED_EXPRS)} FROM embeddings"


def clustered(t: Tables) -> DataFrame:
    return t.embeddings.selectExpr(*CLUSTERED_EXPRS)


def values_sql(rows: list[tuple], columns: str) -> str:
    """Catalogue rows as a VALUES list for the checking SQL."""

    def cell(v):
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return f"CAST({v!r} AS DOUBLE)" if isinstance(v, float) else repr(v)

    body = ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)
    return f"(SELECT * FROM (VALUES {body}) AS v({columns}))"
