"""Cutting documents into chunks: fixed windows, or along natural breaks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Break points from strong to weak.
SEPARATORS = ("\n## ", "\n### ", "\n- ", "\n", ". ", " ")
WINDOWS_PER_SLAB = 128
OUT_CHARS = 1 << 20  # characters of chunks that leave a task at once


def fixed(docs: DataFrame, key: str, text: str = "text", size: int = 160, overlap: int = 20, keep: Sequence[str] = ()) -> DataFrame:
    """Windows of ``size`` characters, each starting ``size - overlap`` after the last, until the end is covered.

    Long texts are first cut into slabs of many windows: taking a substring
    costs time in proportion to its offset, so windows are cut from short slabs.
    """
    step = size - overlap
    if step <= 0:
        raise ValueError("overlap must be smaller than size")
    length = F.length(text)
    windows = F.when(length > 0, F.greatest(F.lit(1), F.ceil((length - size) / F.lit(step)).cast("int") + 1)).otherwise(0)
    slab = WINDOWS_PER_SLAB * step
    counted = docs.select(key, *keep, text, windows.alias("_n")).filter("_n > 0")
    slabs = counted.select(
        key, *keep, "_n",
        F.explode(F.transform(
            F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / WINDOWS_PER_SLAB).cast("int")),
            lambda s: F.struct(
                (s * WINDOWS_PER_SLAB).alias("first"),
                F.substring(F.col(text), s * slab + 1, F.lit(slab + overlap)).alias("part"),
            ),
        )).alias("s"),
    ).select(key, *keep, F.col("s.first").alias("_first"), F.col("s.part").alias("_part"), F.least(F.lit(WINDOWS_PER_SLAB), F.col("_n") - F.col("s.first")).alias("_k"))
    pieces = F.transform(F.sequence(F.lit(0), F.col("_k") - 1), lambda i: F.substring(F.col("_part"), i * step + 1, F.lit(size)))
    return slabs.select(key, *keep, "_first", F.posexplode(pieces).alias("_i", "chunk")).select(
        key, *keep, (F.col("_first") + F.col("_i")).alias("chunk_id"), "chunk"
    )


def _atoms(text: str, size: int, separators: Sequence[str]) -> Iterator[list[str]]:
    """Runs of pieces that may be packed together; a piece that had to be cut finer is a run of its own."""
    present = [i for i, s in enumerate(separators) if s in text]
    if not present:
        yield [text]
        return
    sep, finer = separators[present[0]], separators[present[0] + 1:]
    head, *tail = text.split(sep)
    pieces = ([head] if head else []) + [sep + t for t in tail]
    run: list[str] = []
    for piece in pieces:
        if len(piece) < size:
            run.append(piece)
            continue
        if run:
            yield run
            run = []
        if finer:
            yield from _atoms(piece, size, finer)
        else:
            yield [piece]
    if run:
        yield run


def split_recursive(text: str, size: int = 320, overlap: int = 50, separators: Sequence[str] = SEPARATORS) -> list[str]:
    """Chunks along the strongest breaks; neighbours share up to ``overlap`` trailing characters.

    A chunk exceeds ``size`` only where the text offers no break at all.
    """
    chunks: list[str] = []
    for run in _atoms(text, size, separators):
        window: list[str] = []
        length = 0
        for piece in run:
            if window and length + len(piece) > size:
                chunks.append("".join(window))
                while window and (length > overlap or length + len(piece) > size):
                    length -= len(window.pop(0))
            window.append(piece)
            length += len(piece)
        if window:
            chunks.append("".join(window))
    return [c for c in (chunk.strip() for chunk in chunks) if c]


def recursive(docs: DataFrame, key: str, text: str = "text", size: int = 320, overlap: int = 50) -> DataFrame:
    """Chunks along headings, list items, lines, sentences and blanks, numbered per document.

    Packing carries state from piece to piece, which no built-in expresses; the
    helper sees one text at a time, and chunks leave in batches of about ``OUT_CHARS``, so a task holds no more than that beside its texts.
    """
    schema = StructType().add(key, docs.schema[key].dataType).add("chunk_id", "integer").add("chunk", "string")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, numbers, chunks, chars = [], [], [], 0
            for i in range(b.num_rows):
                t = b.column(1)[i].as_py()
                found = split_recursive(t, size, overlap) if t else []
                rows += [i] * len(found)
                numbers += range(len(found))
                chunks += found
                chars += sum(map(len, found))
                if not chunks or (chars < OUT_CHARS and i < b.num_rows - 1):
                    continue
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(rows, pa.int32())), pa.array(numbers, pa.int32()), pa.array(chunks, arrow[2].type)], schema=arrow
                )
                rows, numbers, chunks, chars = [], [], [], 0

    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(run, schema)


def stats(chunks: DataFrame, *by: str) -> DataFrame:
    """Chunk count and mean length, 1 decimal."""
    return chunks.groupBy(*by).agg(F.count(F.lit(1)).alias("chunks"), F.round(F.avg(F.length("chunk")), 1).alias("mean_chars"))
