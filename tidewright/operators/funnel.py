"""Funnel: text events to typed events, to one row per user, to a segmented mart.

Everything is generated from an ordered list of stages. User level facts and
dimensions come out of one ``groupBy(user)``: the mart needs one shuffle of the
events (after partial aggregation) and one of the few segment rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import ratio_pct
from ..functions.text import clean, clean_or_null, parse_mixed_timestamp

# Stage names as they occur in the data, in order.
STAGES = ("cadastro", "onboarding_inicio", "onboarding_completo", "ativacao", "exportacao")


@dataclass(frozen=True)
class FunnelSpec:
    """Column names and stages; the defaults are those of the raw file."""

    stages: Sequence[str] = STAGES
    user: str = "user_id"
    plan: str = "plano"
    device: str = "device"
    stage: str = "etapa"
    when: str = "timestamp"
    users: str = "usuarios"

    @property
    def text_schema(self) -> str:
        return ", ".join(f"`{c}` string" for c in (self.user, self.plan, self.device, self.stage, self.when))

    def transitions(self) -> list[tuple[str, str]]:
        return list(zip(self.stages, self.stages[1:]))


DEFAULT = FunnelSpec()


def stage_order(stage: Column, stages: Sequence[str] = STAGES) -> Column:
    """1-based position of a stage, null for unknown names."""
    known = F.array(*[F.lit(s) for s in stages])
    return F.nullif(F.array_position(known, clean(stage)), F.lit(0)).cast("int")


def silver(raw: DataFrame, spec: FunnelSpec = DEFAULT) -> DataFrame:
    """Typed events from all-text ones; nothing is dropped."""
    return raw.select(
        F.trim(F.col(spec.user)).alias(spec.user),
        clean(F.col(spec.plan)).alias(spec.plan),
        clean_or_null(F.col(spec.device)).alias(spec.device),
        clean(F.col(spec.stage)).alias(spec.stage),
        F.col(spec.when).alias("timestamp_raw"),
        parse_mixed_timestamp(F.col(spec.when)).alias("event_ts"),
        stage_order(F.col(spec.stage), spec.stages).alias("stage_order"),
    )


def _dimension_aggs(spec: FunnelSpec) -> list[Column]:
    return [
        F.min(spec.plan).alias(spec.plan),
        F.coalesce(F.max(spec.device), F.lit("unknown")).alias(spec.device),
        F.min("event_ts").alias("first_event_ts"),
        F.max("event_ts").alias("last_event_ts"),
        F.count(F.lit(1)).alias("total_events"),
    ]


def _stage_aggs(spec: FunnelSpec) -> list[Column]:
    at = {s: F.col(spec.stage) == s for s in spec.stages}
    flags = [F.max(F.when(at[s], 1).otherwise(0)).alias(f"has_{s}") for s in spec.stages]
    firsts = [F.min(F.when(at[s], F.col("event_ts"))).alias(f"{s}_ts") for s in spec.stages]
    return flags + firsts


def dim_user(events: DataFrame, spec: FunnelSpec = DEFAULT) -> DataFrame:
    return events.groupBy(spec.user).agg(*_dimension_aggs(spec))


def fct_user_funnel(events: DataFrame, spec: FunnelSpec = DEFAULT) -> DataFrame:
    return events.groupBy(spec.user).agg(*_stage_aggs(spec))


def user_funnel(events: DataFrame, spec: FunnelSpec = DEFAULT) -> DataFrame:
    """Fact and dimension of a user in one row and one shuffle; null users drop out."""
    return (
        events.filter(F.col(spec.user).isNotNull())
        .groupBy(spec.user)
        .agg(*_dimension_aggs(spec), *_stage_aggs(spec))
    )


def join_fact_dimension(fact: DataFrame, dimension: DataFrame, spec: FunnelSpec = DEFAULT) -> DataFrame:
    """Inner join of separately stored fact and dimension tables."""
    return fact.join(dimension, spec.user, "inner")


def _measures(users: DataFrame, spec: FunnelSpec, by: Sequence[str], transitions: bool) -> DataFrame:
    grouped = users.groupBy(*by).agg(
        F.count(F.lit(1)).alias(spec.users),
        *[F.sum(f"has_{s}").alias(s) for s in spec.stages],
    )
    first = F.col(spec.stages[0])
    rates = [ratio_pct(F.col(s), first).alias(f"pct_{s}") for s in spec.stages[1:]]
    if transitions:
        rates += [ratio_pct(F.col(b), F.col(a)).alias(f"trans_{a}_to_{b}") for a, b in spec.transitions()]
    return grouped.select(*by, spec.users, *spec.stages, *rates)


def mart_segmented(users: DataFrame, spec: FunnelSpec = DEFAULT) -> DataFrame:
    """Counts and rates by plan and device."""
    return _measures(users, spec, [spec.plan, spec.device], transitions=True)


def funnel_overall(users: DataFrame, spec: FunnelSpec = DEFAULT) -> DataFrame:
    return _measures(users, spec, [], transitions=False)


def missing_counts(events: DataFrame, spec: FunnelSpec = DEFAULT) -> DataFrame:
    """Rows, rows without device, rows whose timestamp did not parse."""
    return events.agg(
        F.count(F.lit(1)).alias("linhas"),
        F.count_if(F.col(spec.device).isNull()).alias("linhas_sem_device"),
        F.count_if(F.col("event_ts").isNull()).alias("linhas_sem_timestamp_parseado"),
    )
