"""Semantic layer: a small graph of entities, stages and metrics that drives the queries.

The catalogue is generated from the stage list. It has tens of rows, so it is
the one thing the driver may read; all measures run on the user table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import ratio_pct
from ..sources.literals import literal_table
from .funnel import DEFAULT, FunnelSpec
from .metric_index import settled

NODE_SCHEMA = "node_id string, node_type string, label string, physical_ref string, description string"
EDGE_SCHEMA = "source_id string, relation string, target_id string, confidence double, description string"
METRIC_SCHEMA = (
    "metric_id string, label string, numerator_node string, denominator_node string, grain string, "
    "default_segments string, business_question string, interpretation_warning string"
)
RULE_SCHEMA = "rule_id string, rule_type string, expression string, description string, severity string"


def _metric_defs(spec: FunnelSpec) -> list[tuple[str, str, str, str]]:
    """(metric id, physical column, numerator stage, denominator stage)."""
    first, last = spec.stages[0], spec.stages[-1]
    rates = [(f"metric_{s}_rate", f"pct_{s}", s, first) for s in spec.stages[1:]]
    a, b = spec.stages[-2], last
    return rates + [(f"metric_transicao_{a}_{b}", f"trans_{a}_to_{b}", b, a)]


def node_rows(spec: FunnelSpec = DEFAULT) -> list[tuple]:
    rows = [
        ("entity_user", "entity", "User", f"dim_usuario.{spec.user}", "Grain of the analysis: one user."),
        ("entity_event", "entity", "Funnel event", f"silver_funnel_eventos.{spec.stage}", "One event of one user."),
        (f"dim_{spec.plan}", "dimension", "Plan", f"dim_usuario.{spec.plan}", "Commercial plan of the user."),
        (f"dim_{spec.device}", "dimension", "Device", f"dim_usuario.{spec.device}", "Device of the user."),
        ("dim_event_date", "dimension", "Event date", "silver_funnel_eventos.event_ts", "Parsed event time."),
    ]
    rows += [
        (f"stage_{s}", "stage", s.replace("_", " "), f"{spec.stage} = '{s}'", f"Stage {i} of the funnel.")
        for i, s in enumerate(spec.stages, start=1)
    ]
    rows += [
        (m, "metric", m.replace("_", " "), f"mart_funnel_segmentado.{col}", f"Users with {num} over users with {den}.")
        for m, col, num, den in _metric_defs(spec)
    ]
    return rows


def edge_rows(spec: FunnelSpec = DEFAULT) -> list[tuple]:
    rows = [
        ("entity_user", "HAS_DIMENSION", f"dim_{spec.plan}", 1.0, "Every user has a plan."),
        ("entity_user", "HAS_DIMENSION", f"dim_{spec.device}", 1.0, "Every user should have a device."),
        ("entity_user", "EMITS", "entity_event", 1.0, "Users emit events."),
    ]
    rows += [
        (f"stage_{b}", "HAPPENS_AFTER", f"stage_{a}", 1.0, f"{b} follows {a}.") for a, b in spec.transitions()
    ]
    for metric, _, num, den in _metric_defs(spec):
        # Fixed value: the device edge weighs less unless the metric looks at the last stage.
        device_weight = 1.0 if num == spec.stages[-1] else 0.9
        rows += [
            (metric, "NUMERATOR_IS", f"stage_{num}", 1.0, f"Users that reached {num}."),
            (metric, "DENOMINATOR_IS", f"stage_{den}", 1.0, f"Users that reached {den}."),
            (metric, "SHOULD_SEGMENT_BY", f"dim_{spec.plan}", 1.0, "Plans differ."),
            (metric, "SHOULD_SEGMENT_BY", f"dim_{spec.device}", device_weight, "Devices differ."),
        ]
    return rows


def metric_rows(spec: FunnelSpec = DEFAULT) -> list[tuple]:
    return [
        (
            metric, metric.replace("_", " "), f"stage_{num}", f"stage_{den}", spec.user,
            f"{spec.plan}, {spec.device}", f"Of users with {den}, how many have {num}?",
            "Read by plan and device first.",
        )
        for metric, _, num, den in _metric_defs(spec)
    ]


def rule_rows(spec: FunnelSpec = DEFAULT) -> list[tuple]:
    chain = " > ".join(spec.stages)
    return [
        ("rule_stage_order", "event_sequence", chain, "A later stage implies the earlier ones.", "warning"),
        ("rule_metric_denominator", "metric_definition", "rates are over users", "Not over events.", "critical"),
        ("rule_segment_before_conclusion", "analysis", "segment first", "A total can hide a gap.", "critical"),
        ("rule_device_required", "data_quality", "device is not null", "Nulls read as unknown.", "warning"),
        ("rule_timestamp_mixed_formats", "data_quality", "timestamp parses", "Formats are mixed.", "warning"),
    ]


def nodes(spark: SparkSession, spec: FunnelSpec = DEFAULT) -> DataFrame:
    return literal_table(spark, node_rows(spec), NODE_SCHEMA)


def edges(spark: SparkSession, spec: FunnelSpec = DEFAULT) -> DataFrame:
    return literal_table(spark, edge_rows(spec), EDGE_SCHEMA)


def metrics(spark: SparkSession, spec: FunnelSpec = DEFAULT) -> DataFrame:
    return literal_table(spark, metric_rows(spec), METRIC_SCHEMA)


def rules(spark: SparkSession, spec: FunnelSpec = DEFAULT) -> DataFrame:
    return literal_table(spark, rule_rows(spec), RULE_SCHEMA)


def resolve_edges(edge_df: DataFrame, node_df: DataFrame) -> DataFrame:
    """Both ends of every edge with their node columns. The node table is a catalogue of tens of rows."""
    source = node_df.select(
        F.col("node_id").alias("source_id"), F.col("label").alias("source_label"), F.col("node_type").alias("source_type")
    )
    target = node_df.select(
        F.col("node_id").alias("target_id"), F.col("label").alias("target_label"),
        F.col("node_type").alias("target_type"), "physical_ref", F.col("description").alias("target_description"),
    )
    return edge_df.join(source, "source_id").join(target, "target_id")


def describe_metric(edge_df: DataFrame, node_df: DataFrame, metric_id: str) -> DataFrame:
    """Everything the graph says about one metric."""
    return resolve_edges(edge_df.filter(F.col("source_id") == metric_id), node_df).orderBy("relation", "target_label")


def recommended_segments(edge_df: DataFrame, node_df: DataFrame, metric_id: str) -> DataFrame:
    wanted = (F.col("source_id") == metric_id) & (F.col("relation") == "SHOULD_SEGMENT_BY")
    return resolve_edges(edge_df.filter(wanted), node_df).select("target_id", "target_label", "physical_ref")


def rule_lookup(rule_df: DataFrame, rule_id: str) -> DataFrame:
    return rule_df.filter(F.col("rule_id") == rule_id)


def observed_nodes(users: DataFrame, spec: FunnelSpec = DEFAULT) -> DataFrame:
    """What the data holds for each node: users per stage, distinct values per dimension.

    One pass over the users; the few segment rows are unpivoted afterwards.
    """
    seg = users.groupBy(spec.plan, spec.device).agg(
        F.count(F.lit(1)).alias("n"), F.sum("total_events").alias("events"),
        *[F.sum(f"has_{s}").alias(s) for s in spec.stages],
    )
    one = seg.agg(
        F.sum("n").alias("entity_user"), F.sum("events").alias("entity_event"),
        F.count_distinct(spec.plan).alias(f"dim_{spec.plan}"),
        F.count_distinct(spec.device).alias(f"dim_{spec.device}"),
        *[F.sum(s).alias(f"stage_{s}") for s in spec.stages],
    )
    return one.unpivot([], one.columns, "node_id", "observed")


def metric_values(users: DataFrame, metric_df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """All catalogue metrics in one aggregation, built from the catalogue rows.

    ``by`` overrides the segments; the catalogue's own ``default_segments`` apply
    when the metric rows agree on them.
    """
    rows = metric_df.select("metric_id", "numerator_node", "denominator_node", "default_segments").collect()
    if not by:
        declared = {r.default_segments for r in rows}
        if len(declared) != 1:
            raise ValueError("metrics declare different segments: pass them in 'by'")
        by = [c.strip() for c in declared.pop().split(",")]
    stages = sorted({n.removeprefix("stage_") for r in rows for n in (r.numerator_node, r.denominator_node)})
    counts = users.groupBy(*by).agg(*[F.sum(f"has_{s}").alias(f"n_{s}") for s in stages])
    parts = [
        F.struct(
            F.lit(r.metric_id).alias("metric_id"),
            F.col("n_" + r.numerator_node.removeprefix("stage_")).alias("numerator"),
            F.col("n_" + r.denominator_node.removeprefix("stage_")).alias("denominator"),
        )
        for r in rows
    ]
    long = counts.select(*by, F.inline(F.array(*parts)))
    return long.withColumn("rate", ratio_pct(F.col("numerator"), F.col("denominator")))


def segment_gaps(values: DataFrame) -> DataFrame:
    """Distance of each segment's rate from the overall rate of its metric."""
    total = values.groupBy("metric_id").agg(
        ratio_pct(F.sum("numerator"), F.sum("denominator")).alias("overall_rate")
    )
    gap = F.round(F.col("rate") - F.col("overall_rate"), 1)
    return values.join(total, "metric_id").withColumn("gap", gap)


def stage_order_violations(users: DataFrame, edge_df: DataFrame) -> DataFrame:
    """Users that reached a stage without the one it follows, with the broken pairs."""
    pairs = [
        (r.source_id.removeprefix("stage_"), r.target_id.removeprefix("stage_"))
        for r in edge_df.filter(F.col("relation") == "HAPPENS_AFTER").orderBy("source_id").collect()
    ]
    broken = F.filter(
        F.array(*[
            F.when((F.col(f"has_{later}") == 1) & (F.col(f"has_{earlier}") == 0), F.lit(f"{later}<{earlier}"))
            for later, earlier in pairs
        ]),
        lambda x: x.isNotNull(),
    )
    return users.withColumn("broken", broken).filter(F.size("broken") > 0)


def stage_chain(edge_df: DataFrame) -> DataFrame:
    """All (stage, ancestor, distance) of the stage graph, with the shortest distance; a cycle is an error that names its stages.

    A fixpoint by doubling: each step joins the pairs known with themselves, so paths twice as long are known after it, and a
    chain of n stages takes log n steps. It ends when a step finds no new pair.
    """
    step = edge_df.filter(F.col("relation") == "HAPPENS_AFTER").select(F.col("source_id").alias("stage"), F.col("target_id").alias("ancestor"))
    known, size = settled(step.distinct().withColumn("distance", F.lit(1)), "stages"), -1
    while True:
        names = known.filter(F.col("stage") == F.col("ancestor")).select("stage").orderBy("stage").limit(20).collect()  # enough to name
        if names:
            raise ValueError(f"stage graph has a cycle through {', '.join(r.stage for r in names)}")
        before, size = size, known.count()
        if size == before:
            return known
        a, b = known.alias("a"), known.alias("b")
        longer = a.join(b, F.col("a.ancestor") == F.col("b.stage")).select(
            "a.stage", "b.ancestor", (F.col("a.distance") + F.col("b.distance")).alias("distance")
        )
        known = settled(known.unionByName(longer).groupBy("stage", "ancestor").agg(F.min("distance").alias("distance")), "stages")
