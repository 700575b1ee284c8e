"""Clustering queries. Clusters are the given labels, centres their mean vectors, so results are repeatable."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import vectors as vx
from ..functions.text import narrative
from ..operators import clustering as cg
from ..operators.layout import first_values
from ..operators.sizes import broadcast_if_small
from ..plans import fraud
from ..session import scratch_path
from . import Tables, register
from .fixtures import CLUSTERED_SQL, TX_SQL, clustered, transactions
from .scalars import _CENTRE, NARRATIVE_SQL, centres, unit_sql

_BASE = (
    f"WITH {_CENTRE}, tx AS ({CLUSTERED_SQL}), d AS (SELECT tx.*, centre, list_distance(embedding::DOUBLE[], centre) AS distancia_centroide "
    "FROM tx JOIN c ON c.label = tx.cluster)"
)
_PCT = (
    "p AS (SELECT *, (rank() OVER (PARTITION BY cluster ORDER BY distancia_centroide) + (count(*) OVER (PARTITION BY cluster, distancia_centroide) - 1) / 2.0::DOUBLE) "
    "/ count(*) OVER (PARTITION BY cluster) AS percentil_distancia FROM d)"
)
_SUSP = "s AS (SELECT cluster FROM tx GROUP BY cluster HAVING avg(fraude) >= 0.6)"
_ALERT = "a AS (SELECT *, CASE WHEN cluster IN (SELECT cluster FROM s) OR percentil_distancia >= 0.98 THEN 1 ELSE 0 END AS alerta FROM p)"


def _centres(t: Tables):
    return centres(t).withColumnRenamed("label", "cluster")


def distanced(t: Tables):
    return cg.centre_distance(clustered(t), _centres(t))


@register("join_centroid", f"{_BASE} SELECT vec_id, cluster, round(centre[1], 6) AS c_first, round(centre[64], 6) AS c_last FROM d")
def _(t: Tables):
    return clustered(t).join(broadcast_if_small(_centres(t)), "cluster").select(
        "vec_id", "cluster", F.round(F.col("centre")[0], 6).alias("c_first"), F.round(F.col("centre")[63], 6).alias("c_last")
    )


@register("centroid_distance", f"{_BASE} SELECT vec_id, cluster, round(distancia_centroide, 6) AS distance FROM d")
def _(t: Tables):
    return distanced(t).select("vec_id", "cluster", F.round("distancia_centroide", 6).alias("distance"))


@register(
    "assign_nearest_centroid",
    f"{_BASE}, n AS (SELECT vec_id, c.label AS cluster, round(list_distance(embedding::DOUBLE[], c.centre), 9) AS dist FROM embeddings, c) "
    "SELECT vec_id, arg_min(cluster, (dist, cluster)) AS cluster FROM n GROUP BY vec_id",
)
def _(t: Tables):
    return cg.assign_nearest(t.embeddings, _centres(t), "vec_id")


@register("percentile_rank_in_group", f"{_BASE}, {_PCT} SELECT vec_id, cluster, round(percentil_distancia, 6) AS pct FROM p")
def _(t: Tables):
    ranked = cg.distance_percentile(distanced(t))
    return ranked.select("vec_id", "cluster", F.round("percentil_distancia", 6).alias("pct"))


@register(
    "cluster_summary",
    f"{_BASE}, m AS (SELECT cluster, string_agg(merchant, ', ' ORDER BY merchant) AS merchant_exemplo FROM (SELECT DISTINCT cluster, merchant FROM tx QUALIFY dense_rank() OVER (PARTITION BY cluster ORDER BY merchant) <= 3) GROUP BY cluster) "
    "SELECT cluster, count(*) AS volume, round(avg(fraude), 6) AS fraude_rate, round(avg(valor), 4) AS ticket_medio, round(avg(distancia_centroide), 6) AS distancia_media, merchant_exemplo FROM d JOIN m USING (cluster) GROUP BY cluster, merchant_exemplo",
)
def _(t: Tables):
    told = cg.summary(distanced(t))
    return told.withColumns({"fraude_rate": F.round("fraude_rate", 6), "ticket_medio": F.round("ticket_medio", 4), "distancia_media": F.round("distancia_media", 6)})


@register("filter_in_set", f"{_BASE}, {_SUSP} SELECT vec_id, cluster, fraude, valor FROM tx WHERE cluster IN (SELECT cluster FROM s)")
def _(t: Tables):
    rows = clustered(t)
    return cg.rows_in(rows, cg.suspicious_clusters(rows)).select("vec_id", "cluster", "fraude", "valor")


@register("suspicious_rows_top", f"{_BASE}, {_SUSP} SELECT vec_id, cluster, fraude, merchant, valor FROM tx WHERE cluster IN (SELECT cluster FROM s) ORDER BY cluster, valor DESC, vec_id LIMIT 20")
def _(t: Tables):
    rows = clustered(t)
    return cg.suspicious_top(rows, cg.suspicious_clusters(rows)).select("vec_id", "cluster", "fraude", "merchant", "valor")


@register("outliers_top", f"{_BASE} SELECT vec_id, cluster, merchant, round(distancia_centroide, 6) AS distance FROM d ORDER BY distancia_centroide DESC, vec_id LIMIT 15")
def _(t: Tables):
    return cg.outliers_top(distanced(t)).select("vec_id", "cluster", "merchant", F.round("distancia_centroide", 6).alias("distance"))


def alerted(t: Tables):
    rows = cg.distance_percentile(distanced(t))
    return cg.flag_alerts(rows, cg.suspicious_clusters(clustered(t)))


@register("flag_union", f"{_BASE}, {_PCT}, {_SUSP}, {_ALERT} SELECT vec_id, cluster, alerta FROM a")
def _(t: Tables):
    return alerted(t).select("vec_id", "cluster", "alerta")


def _report_sql(source: str, truth: str, pred: str) -> str:
    per = " UNION ALL ".join(
        f"SELECT '{c}' AS label, coalesce(tp{c} / nullif(pred{c}, 0), 0)::DOUBLE AS p, coalesce(tp{c} / nullif(sup{c}, 0), 0)::DOUBLE AS r, "
        f"coalesce(2 * tp{c} / nullif(sup{c} + pred{c}, 0), 0)::DOUBLE AS f, sup{c} AS support FROM cm" for c in (0, 1)
    )
    counts = ", ".join(
        f"count(*) FILTER (WHERE {truth} = {c} AND {pred} = {c}) AS tp{c}, count(*) FILTER (WHERE {truth} = {c}) AS sup{c}, count(*) FILTER (WHERE {pred} = {c}) AS pred{c}"
        for c in (0, 1)
    )
    return (
        f"cm AS (SELECT {counts}, count(*) AS total, count(*) FILTER (WHERE {truth} = {pred}) AS ok FROM {source}), per AS ({per}), "
        "allrows AS (SELECT * FROM per UNION ALL SELECT 'accuracy', ok / total, ok / total, ok / total, total FROM cm UNION ALL "
        "SELECT 'macro avg', avg(p), avg(r), avg(f), CAST(sum(support) AS BIGINT) FROM per UNION ALL "
        "SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support), sum(f * support) / sum(support), CAST(sum(support) AS BIGINT) FROM per) "
        "SELECT label, round(p, 3) AS precision, round(r, 3) AS recall, round(f, 3) AS f1, support FROM allrows"
    )


@register("fraud_clusters", f"{_BASE}, {_PCT}, {_SUSP}, {_ALERT}, " + _report_sql("a", "fraude", "alerta"))
def _(t: Tables):
    return cg.classification_report(alerted(t), "fraude", "alerta", [0, 1])


# ---- the whole fraud job: sentences of transactions, embedded and clustered -----------------

_MARK = "CASE WHEN risco_device = 'alto' AND (hora < 8 OR canal = 'online') THEN 1 ELSE 0 END AS fraude"
_JOB = (
    f"WITH tx AS (SELECT *, {_MARK} FROM ({TX_SQL})), said AS MATERIALIZED (SELECT *, {NARRATIVE_SQL} AS narrativa, row_number() OVER () AS row_id FROM tx), "
    f"emb AS MATERIALIZED ({unit_sql('said', 'row_id', 'narrativa', ', narrativa, fraude, merchant, valor')}), "
    "cen AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY narrativa) - 1 AS INTEGER) AS cluster, any_value(emb) AS centre FROM emb GROUP BY narrativa ORDER BY narrativa LIMIT 7), "
    "near AS MATERIALIZED (SELECT row_id, any_value(fraude) AS fraude, any_value(merchant) AS merchant, any_value(valor) AS valor, arg_min(cluster, (round(list_distance(emb, centre), 9), cluster)) AS cluster, "
    "arg_min(list_distance(emb, centre), (round(list_distance(emb, centre), 9), cluster)) AS distancia_centroide FROM emb, cen GROUP BY row_id), "
    "r AS (SELECT *, round(distancia_centroide, 9) AS dist FROM near), "
    "p AS (SELECT *, (rank() OVER (PARTITION BY cluster ORDER BY distancia_centroide) + (count(*) OVER (PARTITION BY cluster, distancia_centroide) - 1) / 2.0::DOUBLE) "
    "/ count(*) OVER (PARTITION BY cluster) AS percentil_distancia FROM r), s AS (SELECT cluster FROM near GROUP BY cluster HAVING avg(fraude) >= 0.2), "
    "a AS (SELECT *, CASE WHEN cluster IN (SELECT cluster FROM s) OR percentil_distancia >= 0.98 THEN 1 ELSE 0 END AS alerta FROM p)"
)


def card_transactions(t: Tables):
    return transactions(t).selectExpr("*", _MARK)


def fraud_run(t: Tables):
    """With the first sentences as centres, so that SQL can follow; the share of frauds that makes a cluster suspicious fits the made-up marks."""
    tx = card_transactions(t)
    first = first_values(tx.select(narrative().alias("narrativa")), "narrativa", 7)
    seeds = first.select((F.row_number().over(Window.orderBy("narrativa")) - 1).alias("cluster"), vx.hash_embedding(F.col("narrativa")).alias("centre"))
    return fraud.run(tx, scratch_path(t.spark, "fraud"), centres=seeds, rate=0.2)


@register("fraud_job_report", f"{_JOB}, " + _report_sql("a", "fraude", "alerta"))
def _(t: Tables):
    return fraud_run(t).report()


@register("fraud_job_summary", f"{_JOB} SELECT cluster, count(*) AS volume, round(avg(fraude), 6) AS fraude_rate, round(avg(valor), 2) AS ticket_medio, round(avg(distancia_centroide), 6) AS distancia_media FROM near GROUP BY cluster")
def _(t: Tables):
    told = fraud_run(t).table("summary")
    return told.select(
        "cluster", "volume", F.round("fraude_rate", 6).alias("fraude_rate"), F.round("ticket_medio", 2).alias("ticket_medio"), F.round("distancia_media", 6).alias("distancia_media")
    )


@register(
    "fraud_job_fitted",
    f"WITH tx AS (SELECT *, {_MARK} FROM ({TX_SQL})) SELECT count(*) AS transactions, CAST(sum(fraude) AS BIGINT) AS frauds, 0::BIGINT AS unexplained, 0::BIGINT AS misplaced, 7::BIGINT AS clusters, true AS alerted FROM tx",
)
def _(t: Tables):
    """The job with its own k-means: what must hold of its tables, whatever the fit."""
    told = fraud.check(fraud.run(card_transactions(t), scratch_path(t.spark, "fraud")))
    return told.select("transactions", "frauds", "unexplained", "misplaced", "clusters", (F.col("alerts") > 0).alias("alerted"))


@register("classification_report", "WITH l AS (SELECT quality, 1 - toxic AS predicted FROM labels), " + _report_sql("l", "quality", "predicted"))
def _(t: Tables):
    judged = t.labels.select("quality", (1 - F.col("toxic")).alias("predicted"))
    return cg.classification_report(judged, "quality", "predicted", [0, 1])


@register("class_proportions", "SELECT quality, round(count(*) / (SELECT count(*) FROM labels)::DOUBLE, 6) AS proportion FROM labels GROUP BY quality")
def _(t: Tables):
    return cg.class_proportions(t.labels, "quality").withColumn("proportion", F.round("proportion", 6))


@register("add_constant_flags", f"WITH tx AS ({CLUSTERED_SQL}) SELECT vec_id AS tx_id, CASE fraude WHEN 0 THEN 'legítima' WHEN 1 THEN 'fraude' END AS fraude_label FROM tx")
def _(t: Tables):
    label = F.when(F.col("fraude") == 0, "legítima").when(F.col("fraude") == 1, "fraude")
    return clustered(t).select(F.col("vec_id").alias("tx_id"), label.alias("fraude_label"))


@register("kmeans_fit_assign")
def _(t: Tables):
    rows, centre = cg.kmeans(t.embeddings)
    return cg.centre_distance(rows, centre).select("vec_id", "cluster", F.round("distancia_centroide", 4).alias("distance"))


@register("kmeans_certificate", f"SELECT count(*) AS rows, 0::BIGINT AS misplaced, {cg.CLUSTERS}::BIGINT AS clusters, 0::BIGINT AS empty, true AS settled FROM embeddings")
def _(t: Tables):
    """Every row lies at its nearest centre; centres are the means of their rows up to what the last step of the fit moved."""
    rows, centre = cg.kmeans(t.embeddings)
    told = cg.kmeans_certificate(rows, centre)
    return told.select("rows", "misplaced", "clusters", "empty", (F.col("drift") < 0.2).alias("settled"))


_DIMS = "(SELECT unnest(range(1, len(embedding) + 1)) AS d, embedding::DOUBLE[] AS e FROM embeddings)"


@register(
    "pca_certificate",
    f"SELECT (SELECT count(*) FROM embeddings) AS rows, 12 AS components, round(sum(v), 6) AS total_variance, true AS exact, true AS orthogonal, true AS explained FROM (SELECT var_samp(e[d]) AS v FROM {_DIMS} GROUP BY d)",
)
def _(t: Tables):
    """The components are eigenvectors of the rows' covariance, orthogonal, and explain what the fit says."""
    told = cg.Projection(t.embeddings, 12).certificate()
    return told.select(
        "rows", "components", F.round("total_variance", 6).alias("total_variance"), (F.col("residual") < 1e-9).alias("exact"),
        (F.col("skew") < 1e-9).alias("orthogonal"), ((F.col("told") < 1e-9) & F.col("explained").between(0.0, 1.0)).alias("explained"),
    )


@register("pca_project")
def _(t: Tables):
    xy = cg.Projection(t.embeddings, 2).coordinates(2)
    return xy.select("vec_id", F.round(F.col("coordinates")[0], 4).alias("x"), F.round(F.col("coordinates")[1], 4).alias("y"))


@register("pca_explained_variance")
def _(t: Tables):
    return cg.compression_report(t.embeddings, "vec_id")
