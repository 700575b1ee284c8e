"""Clusters of vectors: fitting, distances, suspicious groups, and the report on their alerts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from ..functions.vectors import l2_distance
from ..sources.literals import literal_table
from .knn import mean_overlap, top_k
from .kmeans_blocks import fit
from .knn_blocks import TIE_DIGITS, columns, matrix, score_block, squares
from .layout import percentile_rank
from .sizes import broadcast_if_small

# Cluster count, seed and thresholds of the fraud job.
CLUSTERS, SEED = 7, 42
SUSPICIOUS_RATE, OUTLIER_PERCENTILE = 0.6, 0.98
MAX_CENTRES = 10_000  # centres a task holds; with vectors of a thousand numbers 80 MB
MEASURED = "_distance"  # column of distances that ``place`` leaves to ``centre_distance``
BLOCK_ROWS = 4096  # vectors a task looks at at once


def kmeans(df: DataFrame, vec: str = "embedding", k: int = CLUSTERS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Rows with their cluster, and the centres (cluster, centre).

    Spark's own fit holds a copy of all vectors, in memory or on disk. Vectors that are bytes (``hash_bytes``) are fitted by passes over a table instead, of
    which sums alone leave a task; rows without a vector take no part in that, and lie in the first cluster.
    """
    if packed(df, vec):
        table = literal_table(df.sparkSession, [(i, c.tolist()) for i, c in enumerate(fit(df.select(vec), k, seed))], "cluster int, centre array<double>")
        return place(df, table, vec, measured=True), table
    rows = df.withColumn("_v", array_to_vector(F.col(vec).cast("array<double>")))
    model = KMeans(k=k, seed=seed, featuresCol="_v", predictionCol="cluster").fit(rows)
    centres = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]  # k rows
    table = df.sparkSession.createDataFrame(centres, "cluster int, centre array<double>")
    return model.transform(rows).drop("_v"), table


def assign_nearest(df: DataFrame, centres: DataFrame, key: str, vec: str = "embedding") -> DataFrame:
    """Nearest given centre of every row, as (key, cluster); lower cluster wins ties."""
    items = centres.select(F.col("cluster").alias("item_id"), F.col("centre").alias(vec))
    found = top_k(df, items, 1, query_id=key, vec=vec, metric="l2")
    return found.select(F.col("query_id").alias(key), F.col("item_id").alias("cluster"))


def place(df: DataFrame, centres: DataFrame, vec: str = "embedding", name: str = "cluster", measured: bool = False) -> DataFrame:
    """``df`` with the nearest given centre of every row as a column; lower cluster wins ties. Rows need no key, and no join takes place.

    The centres are few and are held by every task; their size is checked. Vectors alone leave the JVM, and may be bytes (``hash_bytes``). ``measured``
    rows get the distance from that centre in the same pass, in a column for ``centre_distance``.
    """
    shared = held(centres)

    def near(vectors: pa.Array) -> pa.Array:
        clusters, m = shared.value
        own, far = np.empty(len(vectors), int), np.empty(len(vectors))
        done = 0
        for x in _blocks(vectors, m):
            at = _nearest(x, m)
            own[done : done + len(at)], far[done : done + len(at)] = clusters[at], _distances(x, m, at) if measured else 0.0
            done += len(at)
        return pa.StructArray.from_arrays([pa.array(own, pa.int32()), pa.array(far, from_pandas=True)], names=["own", "far"])

    found = df.withColumn("_near", F.arrow_udf(near, "own int, far double")(vec)).withColumn(name, F.col("_near.own"))
    return (found.withColumn(MEASURED, F.col("_near.far")) if measured else found).drop("_near")


def packed(df: DataFrame, vec: str) -> bool:
    return isinstance(df.schema[vec].dataType, BinaryType)


def held(centres: DataFrame) -> Broadcast:
    """Clusters in their order and the matrix of their centres, for tasks."""
    table = centres.select("cluster", F.col("centre").cast("array<double>").alias("centre")).orderBy("cluster").limit(MAX_CENTRES + 1).toArrow()
    if table.num_rows > MAX_CENTRES:
        raise ValueError(f"more than {MAX_CENTRES} centres; look them up by assign_nearest")
    return centres.sparkSession.sparkContext.broadcast((table["cluster"].to_numpy(), matrix(table["centre"])))


def _blocks(vectors: pa.Array, m: np.ndarray) -> Iterator[np.ndarray]:
    """Vectors side by side, as many as make a small block and small scores with the centres."""
    step = max(1, min(BLOCK_ROWS, (1 << 22) // max(1, len(m))))
    return (columns(vectors[i : i + step], m.shape[1]) for i in range(0, len(vectors), step))


def _nearest(x: np.ndarray, m: np.ndarray) -> np.ndarray:
    return np.round(-score_block(x.T, m, "l2"), TIE_DIGITS).argmin(axis=1)


def _distances(x: np.ndarray, m: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Distances of vectors (columns) from the centres of the given numbers, to the last bit as the JVM finds them."""
    return np.sqrt(squares(x - m.T[:, at]))


def centre_distance(df: DataFrame, centres: DataFrame, vec: str = "embedding") -> DataFrame:
    """Distance of each row to the centre of its cluster; ``place`` may have measured it, as it must where vectors are bytes."""
    if MEASURED in df.columns:
        return df.withColumnRenamed(MEASURED, "distancia_centroide")
    near = df.join(broadcast_if_small(centres), "cluster")
    return near.withColumn("distancia_centroide", l2_distance(F.col(vec), F.col("centre"))).drop("centre")


def distance_percentile(df: DataFrame) -> DataFrame:
    return percentile_rank(df, "cluster", "distancia_centroide", "percentil_distancia")


def summary(df: DataFrame) -> DataFrame:
    """Per cluster: volume, fraud rate, mean value, mean distance, the three first merchants by name.

    Merchants are made distinct and cut to three before they are gathered, so a
    large cluster never collects its names in one place.
    """
    numbers = df.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("volume"), F.avg("fraude").alias("fraude_rate"),
        F.avg("valor").alias("ticket_medio"), F.avg("distancia_centroide").alias("distancia_media"),
    )
    names = df.select("cluster", "merchant").distinct()
    first = Window.partitionBy("cluster").orderBy("merchant")
    three = names.withColumn("_n", F.row_number().over(first)).filter("_n <= 3").groupBy("cluster").agg(
        F.array_join(F.array_sort(F.collect_list("merchant")), ", ").alias("merchant_exemplo")
    )
    return numbers.join(three, "cluster").orderBy(F.col("fraude_rate").desc(), F.col("volume").desc(), "cluster")


def suspicious_clusters(df: DataFrame, rate: float = SUSPICIOUS_RATE) -> DataFrame:
    return df.groupBy("cluster").agg(F.avg("fraude").alias("_rate")).filter(F.col("_rate") >= rate).select("cluster")


def rows_in(df: DataFrame, clusters: DataFrame) -> DataFrame:
    """Rows of the listed clusters; the list is never collected."""
    return df.join(clusters, "cluster", "left_semi")


def suspicious_top(df: DataFrame, clusters: DataFrame, n: int = 20, tie: str = "vec_id") -> DataFrame:
    return rows_in(df, clusters).orderBy("cluster", F.col("valor").desc(), tie).limit(n)


def outliers_top(df: DataFrame, n: int = 15, tie: str = "vec_id") -> DataFrame:
    return df.orderBy(F.col("distancia_centroide").desc(), tie).limit(n)


def flag_alerts(df: DataFrame, clusters: DataFrame, percentile: float = OUTLIER_PERCENTILE) -> DataFrame:
    """1 for rows of suspicious clusters or far from their centre."""
    marked = df.join(clusters.withColumn("_s", F.lit(True)), "cluster", "left")
    alert = F.coalesce("_s", F.lit(False)) | (F.col("percentil_distancia") >= percentile)
    return marked.withColumn("alerta", alert.cast("int")).drop("_s")


def class_proportions(df: DataFrame, label: str) -> DataFrame:
    total = df.select(F.count(F.lit(1))).scalar()
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).select(label, (F.col("n") / total).alias("proportion"))


def classification_report(df: DataFrame, truth: str, predicted: str, classes: Sequence, digits: int = 3) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted means.

    One pass over the rows gives the confusion counts; the rest is arithmetic on
    one row per pair of classes.
    """
    confusion = df.groupBy(truth, predicted).agg(F.count(F.lit(1)).alias("n"))

    def count(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))

    parts = []
    for i, c in enumerate(classes):
        is_true, is_pred = F.col(truth) == c, F.col(predicted) == c
        parts += [count(is_true & is_pred).alias(f"tp{i}"), count(is_true).alias(f"sup{i}"), count(is_pred).alias(f"pred{i}")]
    one = confusion.agg(F.sum("n").alias("total"), count(F.col(truth) == F.col(predicted)).alias("right"), *parts)
    rows, zero = [], F.lit(0.0)

    def safe(a: Column, b: Column) -> Column:
        return F.coalesce(a / F.nullif(b, F.lit(0)), zero)

    per = []
    for i, c in enumerate(classes):
        tp, sup, pred = F.col(f"tp{i}"), F.col(f"sup{i}"), F.col(f"pred{i}")
        per.append((safe(tp, pred), safe(tp, sup), safe(2 * tp, sup + pred), sup))
        rows.append((str(c), *per[-1]))
    k = len(per)
    macro = [sum((p[j] for p in per), zero) / k for j in range(3)]
    weighted = [safe(sum((p[j] * p[3] for p in per), zero), F.col("total")) for j in range(3)]
    accuracy = safe(F.col("right"), F.col("total"))
    rows += [
        ("accuracy", accuracy, accuracy, accuracy, F.col("total")),
        ("macro avg", *macro, F.col("total")), ("weighted avg", *weighted, F.col("total")),
    ]
    return one.select(F.inline(F.array(*[
        F.struct(
            F.lit(name).alias("label"), F.round(p, digits).alias("precision"), F.round(r, digits).alias("recall"),
            F.round(f, digits).alias("f1"), s.cast("long").alias("support"),
        )
        for name, p, r, f, s in rows
    ])))


class Projection:
    """Principal components of a vector column, centred first; fit once, read any leading part."""

    def __init__(self, df: DataFrame, dims: int, vec: str = "embedding"):
        rows = df.withColumn("_v", array_to_vector(F.col(vec).cast("array<double>")))
        self.centre = StandardScaler(withMean=True, withStd=False, inputCol="_v", outputCol="_c").fit(rows)
        self.model = PCA(k=dims, inputCol="_c", outputCol="_p").fit(self.centre.transform(rows))
        self.rows, self.vec = rows, vec

    def coordinates(self, dims: int) -> DataFrame:
        projected = self.model.transform(self.centre.transform(self.rows))
        return projected.withColumn("coordinates", F.slice(vector_to_array("_p"), 1, dims)).drop("_v", "_c", "_p")

    def variance(self, dims: int) -> float:
        return float(sum(self.model.explainedVariance.toArray()[:dims]))


    def certificate(self) -> DataFrame:
        """Whether the components are what they claim, from the rows alone: one row of numbers.

        ``total_variance`` is the trace of the covariance; ``explained`` the sum of the components' variances over it; ``residual`` the largest distance of
        the covariance's image of a component from its multiple, as a share of the trace; ``skew`` the largest product of two components.
        """
        components = self.model.pc.toArray()  # dims x k numbers
        centred = self.centre.transform(self.rows).select(vector_to_array("_c").alias("v"))
        parts = centred.mapInArrow(_second_moments, "n long, sums array<double>")
        n, sums = 0, None
        for row in parts.collect():  # dims squared numbers per task
            n += row["n"]
            part = np.array(row["sums"])
            sums = part if sums is None else sums + part
        covariance = sums.reshape(len(components), -1) / (n - 1)
        trace, image = float(np.trace(covariance)), covariance @ components
        values = (components * image).sum(axis=0)
        residual = float(np.sqrt(((image - components * values) ** 2).sum(axis=0)).max()) / trace
        skew = float(np.abs(components.T @ components - np.eye(components.shape[1])).max())
        told = float(np.abs(values / trace - self.model.explainedVariance.toArray()).max())
        row = (n, components.shape[1], trace, float(values.sum()) / trace, residual, skew, told)
        names = "rows long, components int, total_variance double, explained double, residual double, skew double, told double"
        return literal_table(self.rows.sparkSession, [row], names)


def _second_moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of rows and sums of products of a task's vectors."""
    n, sums = 0, None
    for b in batches:
        if b.num_rows:
            m = matrix(b.column(0))
            n, sums = n + len(m), m.T @ m if sums is None else sums + m.T @ m
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([sums.ravel().tolist()], pa.list_(pa.float64()))], names=["n", "sums"])


def kmeans_certificate(rows: DataFrame, centres: DataFrame, vec: str = "embedding", tolerance: float = 1e-6) -> DataFrame:
    """Whether a clustering is what it claims, from the rows: one row of numbers.

    ``misplaced`` counts rows nearer (by more than the tolerance) to another centre than to their own, ``empty`` centres without rows, and ``drift`` is the largest
    distance of a centre from the mean of its rows.
    """
    shared = held(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clusters, m = shared.value
        seen, misplaced, sums, counts = 0, 0, np.zeros(m.shape), np.zeros(len(m))
        for b in batches:
            b = b.filter(pc.is_in(b.column(1), pa.array(clusters, b.column(1).type)))
            own, seen = np.searchsorted(clusters, np.asarray(b.column(1))), seen + b.num_rows
            for x in _blocks(b.column(0), m):
                at, own = own[: x.shape[1]], own[x.shape[1] :]
                gap = _distances(x, m, at) - _distances(x, m, _nearest(x, m))
                misplaced += int((gap > tolerance).sum())
                known = ~np.isnan(x).any(axis=0)
                member = (at[known] == np.arange(len(m))[:, None]).astype(float)
                sums, counts = sums + member @ x[:, known].T, counts + member.sum(axis=1)
        yield pa.RecordBatch.from_arrays([pa.array([seen]), pa.array([misplaced]), pa.array([sums.tobytes()]), pa.array([counts.tobytes()])], names=["n", "misplaced", "sums", "counts"])

    parts = rows.select(vec, "cluster").mapInArrow(run, "n long, misplaced long, sums binary, counts binary").collect()  # sums per cluster of each task
    clusters, m = shared.value
    counts = sum((np.frombuffer(p["counts"]) for p in parts), np.zeros(len(m)))
    sums = sum((np.frombuffer(p["sums"]).reshape(m.shape) for p in parts), np.zeros(m.shape))
    full = counts > 0
    drift = float(np.sqrt(((m[full] - sums[full] / counts[full][:, None]) ** 2).sum(axis=1)).max()) if full.any() else None
    row = (sum(p["n"] for p in parts), sum(p["misplaced"] for p in parts), len(m), int((~full).sum()), drift)
    return literal_table(rows.sparkSession, [row], "rows long, misplaced long, clusters long, empty long, drift double")


def compression_report(df: DataFrame, key: str, dims: Sequence[int] = (2, 4, 8, 12), k: int = 3, vec: str = "embedding") -> DataFrame:
    """Variance kept and neighbour overlap for several target dimensions; one fit serves all."""
    fit = Projection(df, max(dims), vec)
    same = {"query_id": key, "item_id": key, "metric": "cosine", "skip_self": True}
    full = top_k(df, df, k, vec=vec, **same)
    out = None
    for d in dims:
        low = fit.coordinates(d).select(key, F.col("coordinates").alias(vec))
        row = mean_overlap(full, top_k(low, low, k, vec=vec, **same), k).select(
            F.lit(d).alias("dimensions"), F.round(F.lit(fit.variance(d)), 4).alias("variance"), "overlap"
        )
        out = row if out is None else out.unionByName(row)
    return out
