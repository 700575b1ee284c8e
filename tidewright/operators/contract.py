"""Model answers under a contract: what an answer must be, and what became of every row that was asked."""

from __future__ import annotations

import json
import math
import time
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .classify import EVENT_TYPES, LIST_LIMITS, SEVERITIES, TEXT_LIMITS
from .scorer import Score, with_retry

CALL_SCHEMA = (
    "struct<asked_at:timestamp,provider:string,model_id:string,latency_ms:double,attempts:int,"
    "success:boolean,parse_success:boolean,error_type:string,error:string,raw:string>"
)
MAX_RAW = 2000  # characters of a refused answer that its dead letter keeps


class Malformed(ValueError):
    """An answer that breaks its contract."""


def _text(value) -> str:
    if not isinstance(value, str):
        raise TypeError
    return value


def _number(value) -> float:
    if isinstance(value, bool) or not math.isfinite(value := float(value)):
        raise TypeError
    return value


def _texts(value) -> list[str]:
    if isinstance(value, str):
        raise TypeError
    return [_text(x) for x in value]


KINDS: dict[str, Callable] = {"string": _text, "double": _number, "array<string>": _texts}


@dataclass(frozen=True)
class Contract:
    """Fields of an answer with their types (string, double, array<string>), allowed values and limits.

    Lists may be cut instead of refused: ``cut_lists`` are cut to their limit, and their items to ``item_chars``.
    """

    fields: Mapping[str, str]
    required: tuple[str, ...] = ()
    texts: Mapping[str, int] = field(default_factory=dict)
    lists: Mapping[str, int] = field(default_factory=dict)
    choices: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    cut_lists: tuple[str, ...] = ()
    item_chars: int = 200

    @property
    def struct(self) -> str:
        return "struct<" + ",".join(f"{n}:{k}" for n, k in self.fields.items()) + ">"

    def read(self, answer: Mapping) -> dict:
        """The answer with its declared types; ``Malformed`` names the first field that breaks a rule."""
        out = {}
        for name, kind in self.fields.items():
            value = answer.get(name)
            if value is None or (isinstance(value, float) and math.isnan(value)):
                if name in self.required:
                    raise Malformed(f"{name} is missing")
                out[name] = None
                continue
            try:
                value = KINDS[kind](value)
            except (TypeError, ValueError):
                raise Malformed(f"{name} is not a {kind}") from None
            if name in self.cut_lists:
                value = [x[: self.item_chars] for x in value[: self.lists.get(name)]]
            if name in self.texts and len(value) > self.texts[name]:
                raise Malformed(f"{name} has more than {self.texts[name]} characters")
            if name in self.lists and len(value) > self.lists[name]:
                raise Malformed(f"{name} has more than {self.lists[name]} items")
            if name in self.choices and value not in self.choices[name]:
                raise Malformed(f"{name} is none of {', '.join(self.choices[name])}")
            if name in self.ranges and not self.ranges[name][0] <= value <= self.ranges[name][1]:
                raise Malformed(f"{name} is not from {self.ranges[name][0]} to {self.ranges[name][1]}")
            out[name] = value
        return out


def _limits(names: tuple[str, ...], table: Mapping[str, int]) -> dict[str, int]:
    return {n: table[n] for n in names if n in table}


def _contract(fields: dict[str, str], **more) -> Contract:
    names = tuple(fields)
    return Contract(fields, texts=_limits(names, TEXT_LIMITS), lists=_limits(names, LIST_LIMITS), **more)


CONTRACTS = {
    "classify": _contract(
        {"event_type": "string", "severity": "string", "confidence": "double", "reasoning": "string"},
        required=("event_type", "severity", "confidence"), choices={"event_type": EVENT_TYPES, "severity": SEVERITIES}, ranges={"confidence": (0.0, 1.0)},
    ),
    "extract": _contract(
        {"summary": "string", "affected_component": "string", "error_code": "string", "user_impact": "string"}, required=("summary",),
    ),
    "root_cause": _contract(
        {"root_cause": "string", "confidence": "double", "contributing_factors": "array<string>", "recommendations": "array<string>",
         "similar_incidents": "array<string>"},
        required=("root_cause", "confidence"), ranges={"confidence": (0.0, 1.0)}, cut_lists=("contributing_factors", "recommendations"),
    ),
}


@dataclass(frozen=True)
class Model:
    """A user's model: ``score`` gets a frame with the named columns and returns one row per row.

    It may return a column ``error``: rows with a text there have failed, the others stand, and nothing is asked again. If it raises instead,
    the batch is asked again ``attempts`` times, then in halves, until the rows it fails on are found.
    """

    score: Score
    provider: str = "custom"
    model_id: str = "custom"
    attempts: int = 2
    wait: float = 1.0
    batch: int = 256


def _raw(answer: Mapping) -> str:
    return json.dumps({k: v for k, v in answer.items()}, default=str, sort_keys=True)[:MAX_RAW]


class _Asking:
    """Asks a model about the rows of one frame and reports per row: (answer or None, call)."""

    def __init__(self, model: Model, contract: Contract):
        self.model, self.contract = model, contract

    def rows(self, pdf: pd.DataFrame) -> list[tuple[dict | None, dict]]:
        return [r for at in range(0, len(pdf), self.model.batch) for r in self._ask(pdf.iloc[at : at + self.model.batch], self.model.attempts)]

    def _ask(self, pdf: pd.DataFrame, attempts: int) -> list[tuple[dict | None, dict]]:
        tries, start, at = 0, time.perf_counter(), datetime.now(timezone.utc)

        def once() -> pd.DataFrame:
            nonlocal tries
            tries += 1
            found = self.model.score(pdf)
            if len(found) != len(pdf):
                raise Malformed(f"{len(found)} answers to {len(pdf)} rows")
            return found

        def call(**more) -> dict:
            spent = (time.perf_counter() - start) * 1000 / len(pdf)  # a batch's time is shared by its rows
            facts = {"asked_at": at, "provider": self.model.provider, "model_id": self.model.model_id, "latency_ms": round(spent, 2), "attempts": tries}
            return facts | {"success": True, "parse_success": True, "error_type": None, "error": None, "raw": None} | more

        try:
            answers = with_retry(once, attempts, self.model.wait).to_dict("records")
        except Exception as e:  # noqa: BLE001 - recorded per row
            if len(pdf) == 1:
                return [(None, call(success=False, parse_success=False, error_type=type(e).__name__, error=str(e)))]
            half = len(pdf) // 2
            return self._ask(pdf.iloc[:half], 1 if half > 1 else self.model.attempts) + self._ask(
                pdf.iloc[half:], 1 if len(pdf) - half > 1 else self.model.attempts
            )
        out = []
        for answer in answers:
            error = answer.pop("error", None)
            if isinstance(error, str):
                kind, _, text = error.partition(": ")
                out.append((None, call(success=False, parse_success=False, error_type=kind if text else "ModelError", error=text or error)))
                continue
            try:
                out.append((self.contract.read(answer), call()))
            except Malformed as e:
                out.append((None, call(success=False, parse_success=False, error_type=type(e).__name__, error=str(e), raw=_raw(answer)) | {"success": True}))
        return out


def ask(df: DataFrame, model: Model, contract: Contract, name: str) -> DataFrame:
    """``df`` with ``<name>``, the answer or null, and ``<name>_call``, what became of the call.

    ``success`` is false where the model failed, ``parse_success`` where there is no usable answer. What is asked is part of the
    plan: store the result before several steps read it, or the model is asked once for each.
    """
    asking = _Asking(model, contract)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            told = asking.rows(pdf)
            yield pdf.assign(**{
                name: pd.Series([a for a, _ in told], index=pdf.index, dtype=object), f"{name}_call": pd.Series([c for _, c in told], index=pdf.index, dtype=object)
            })

    own = df.schema.simpleString()[len("struct<"):-1]
    out = df.mapInPandas(run, f"struct<{own},{name}:{contract.struct},{name}_call:{CALL_SCHEMA}>")
    return out.select(*[F.col(c) for c in df.columns], name, f"{name}_call")
