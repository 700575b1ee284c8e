"""Plug point for a user's scoring function."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Score = Callable[[pd.DataFrame], pd.DataFrame]


def with_retry(call: Callable, attempts: int = 2, wait: float = 1.0, ceiling: float = 10.0):
    """Run a call again after an exponentially growing wait; the last error is raised.

    This is for a flaky service behind the function. Lost tasks are Spark's to retry.
    """
    for attempt in range(attempts):
        try:
            return call()
        except Exception:
            if attempt == attempts - 1:
                raise
            time.sleep(min(ceiling, wait * 2**attempt))


def score_with(df: DataFrame, score: Score, schema: str, name: str = "answer", attempts: int = 2, wait: float = 1.0) -> DataFrame:
    """Add a struct column of scored fields, null for rows the function fails on.

    ``score`` gets a batch and returns one row per input row with the columns of
    ``schema``. A failing batch is split until the rows it fails on are found,
    so a bad row costs only its own answer.

    The rows of a failing batch are tried in parts by the length of their texts, as rows a function refuses are often alike. A part is as long as
    the last stretch without a bad row, and twice as long after each success, so a run of bad rows costs one call per row and a run of good ones few.
    """
    fields = [c.split()[0] for c in schema.split(",")]

    def ask(pdf: pd.DataFrame, tries: int) -> list | None:
        try:
            told = with_retry(lambda: score(pdf), tries, wait)[fields].to_dict("records")
        except Exception:
            return None
        if len(told) != len(pdf):
            raise ValueError(f"{len(told)} answers to {len(pdf)} rows")
        return told

    def in_parts(pdf: pd.DataFrame) -> list:
        order = np.argsort([sum(len(x) for x in row if isinstance(x, str)) for row in pdf.itertuples(index=False)], kind="stable").astype(int)
        rows, found = pdf.iloc[order], [None] * len(pdf)
        at, part, last, wall = 0, max(1, len(pdf) // 8), 0, 0  # between at and wall there is a bad row
        while at < len(pdf):
            end = at + max(1, (wall - at) // 2) if wall > at else min(len(pdf), at + part)
            told = ask(rows.iloc[at:end], attempts if end - at == 1 else 1)
            if told is not None:
                for i, answer in zip(order[at:end], told):
                    found[i] = answer
                at = end
                part = part if wall > at else 2 * part
            elif end - at == 1:
                at, part, last, wall = end, max(1, at - last), end, 0
            else:
                wall = end
        return found

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        failed = False  # once a batch of a task has failed, the next ones are not tried whole
        for pdf in batches:
            found = None if failed else ask(pdf, attempts)
            if found is None:
                failed = failed or len(pdf) > 1
                found = in_parts(pdf) if len(pdf) > 1 or failed else [None] * len(pdf)
            yield pdf.assign(**{name: pd.Series(found, index=pdf.index, dtype=object)})

    struct = f"struct<{','.join(':'.join(c.split()) for c in schema.split(','))}>"
    out = df.schema.simpleString()[len("struct<"):-1]
    whole = f"struct<{out},{name}:{struct}>"
    return df.mapInPandas(run, whole).select(*[F.col(c) for c in df.columns], name)
