"""CSV records from splits of large files, with line breaks inside quoted fields. A header must lie within the first split of its file."""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch_path

MAX_HEADERS = 100  # different headers among the files of one read


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the split they come from; lines end with a line feed, and a carriage return before it is kept for now."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], list[str]]]:
    """Runs of lines of one split: a task may read several splits one after the other, and a split may come in several batches."""
    for b in batches:
        if not b.num_rows:
            continue
        files, starts, values = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        cuts = [0, *(np.flatnonzero((files[1:] != files[:-1]) | (starts[1:] != starts[:-1])) + 1), len(files)]
        for x, y in zip(cuts[:-1], cuts[1:], strict=True):
            yield (int(files[x]), int(starts[x])), values[x:y].tolist()


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split: the parity of its quotation marks, and the first record of its lines if it starts a file."""
    key = parity = header = None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]]), pa.array([key[1]]), pa.array([parity], pa.int32()), pa.array([header], pa.string())], names=["file", "start", "parity", "header"]
        )

    for own, values in _by_split(batches):
        if own != key:
            if key is not None:
                yield row()
            key, parity, header, open_ = own, 0, None, own[1] == 0
        for line in values:
            if open_:
                header = line if header is None else f"{header}\n{line}"
            parity = (parity + line.count('"')) % 2
            if parity == 0:
                open_ = False
    if key is not None:
        yield row()


class _Splits:
    """What tasks know: per split whether it starts inside a quoted field, and which header its file has."""

    def __init__(self, rows: list[dict]):
        rows = sorted(rows, key=lambda r: (r["file"], r["start"]))
        self.headers: list[str] = sorted({r["header"] for r in rows if r["header"] is not None})
        at = {h: i for i, h in enumerate(self.headers)}
        self.known: dict[tuple[int, int], tuple[bool, int]] = {}
        file, inside, header = None, 0, -1
        for r in rows:
            if r["file"] != file:
                file, inside = r["file"], 0
                header = at.get(r["header"], -1)
            self.known[(r["file"], r["start"])] = (bool(inside), header)
            inside = (inside + r["parity"]) % 2


def _records(splits):
    """(header, record, file, start, part): whole records have part 1; what a split starts and ends inside of has part 0 and 2."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = splits.value.known
        key, held, inside, head, header, first = None, [], False, False, -1, False
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [()] * 5
            out.clear()
            kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["header", "record", "file", "start", "part"])

        def end_split() -> None:
            # A split that ends inside a field hands its open record on; one that never leaves the field it starts in is a middle piece.
            if held:
                out.append((header, "\n".join(held), *key, 0 if head else 2))
                held.clear()

        for own, values in _by_split(batches):
            if own != key:
                end_split()
                key = own
                inside, header = known[own]
                head, first = inside, own[1] == 0
            for line in values:
                held.append(line)
                if line.count('"') % 2:
                    inside = not inside
                if not inside:
                    if not first:  # the first record of a file is its header
                        out.append((header, "\n".join(held), *key, 0 if head else 1))
                    held.clear()
                    head = first = False
            if len(out) >= 4096:
                yield flush()
        end_split()
        yield flush()

    return run


def records(spark: SparkSession, path: str, columns: Sequence[str], split_bytes: int | None = None) -> DataFrame:
    """See ``readers.csv_records``."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        if split_bytes is not None:
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
        lines = _lines(spark, path)
        # Splits are cut when a plan is made; both passes must see the same ones, so both are made here.
        surveyed = lines.mapInArrow(_survey, "file long, start long, parity int, header string").collect()  # one row per split
        splits = _Splits([r.asDict() for r in surveyed])
        if len(splits.headers) > MAX_HEADERS:
            raise ValueError(f"the files have {len(splits.headers)} different headers")
        shared = spark.sparkContext.broadcast(splits)
        pieces = lines.mapInArrow(_records(shared), "header int, record string, file long, start long, part int")
        pieces = _stored(pieces)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    whole = pieces.where("part = 1").select("header", "record", "file", "start")
    return _parsed(whole.unionByName(_joined(pieces)), splits, columns)


def _stored(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "csv-records")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _joined(pieces: DataFrame) -> DataFrame:
    """Records that cross splits, from the pieces at the ends of splits: at most two per split, put in sequence per file."""
    ends = pieces.where("part <> 1")
    order = Window.partitionBy("file").orderBy("start", "part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A piece of part 2 opens a record; the pieces of part 0 up to the next one belong to it.
    numbered = ends.withColumn("number", F.sum(F.when(F.col("part") == 2, 1).otherwise(0)).over(order))
    parts = F.array_sort(F.collect_list(F.struct("start", "record")))
    return numbered.groupBy("header", "file", "number").agg(parts.alias("p")).select(
        "header", F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record"), "file", F.element_at("p", 1)["start"].alias("start")
    )


def _fields(header: str) -> list[str]:
    return next(csv.reader([header.rstrip("\r").removeprefix("﻿")]), [])


def _parsed(rows: DataFrame, splits: _Splits, columns: Sequence[str]) -> DataFrame:
    """The columns of each record by its file's header; blank lines drop out."""
    text = F.regexp_replace("record", "\r$", "")
    names = [_fields(h) for h in splits.headers]
    body = rows.where(F.trim(text) != "").select("header", text.alias("record"))
    wide = max([len(n) for n in names], default=0) or 1
    schema = ", ".join(f"f{i} string" for i in range(wide))
    read = body.select("header", F.from_csv("record", schema, {"escape": '"', "quote": '"', "maxCharsPerColumn": "-1", "multiLine": "true"}).alias("r"))

    def column(name: str):
        out = F.lit(None).cast("string")
        for i, n in enumerate(names):
            if name in n:
                out = F.when(F.col("header") == i, F.col(f"r.f{n.index(name)}")).otherwise(out)
        return out.alias(name)

    return read.select(*[column(c) for c in columns])
