"""Token ids in blocks of canonical length-limited Huffman codes.

Files: ``codebook`` (id, bits: code lengths from the ids' global counts; canonical codes follow from them) and ``blocks``, one row
per block: part and block number, ids of the part before it, the document ids and lengths, a bit stream, and a checkpoint: the bit offset of
every ``STEP``-th id. A block holds whole documents and is decoded by itself; from its checkpoints all stretches
are decoded side by side by one table that gives id and length for the next ``MAX_BITS`` bits.

Documents are written in ascending order of doc_id, nulls first: range-partitioned, so parts are in order too. Rows of one id
stay together, in order of their text's hash. Null texts are empty; every document ends with the end id. An empty table gives an
empty file and result. Only the named columns of the input are used.

Texts are encoded once, into a draft in the same block format by a code from a bounded sample; the draft's parts also give the exact
counts of all ids. From these comes the final code, and blocks are recoded one by one. A plain copy of all ids would take more disk than
the texts.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch_path
from .common import unit
from .encoding import Encoder, split_columns

MAX_BITS = 20
STEP = 256
BLOCK_IDS = 65_536  # a block is closed when it has so many; a longer document makes a longer block
PART_BYTES = 32 << 20  # text bytes of a part
DRAFT_DOCS = 2_000  # documents the draft's code is made from, about
TOGETHER = 16  # blocks decoded side by side

BLOCKS = (
    "part int, block int, before long, doc_ids array<long>, lengths array<int>, n_ids long, bits binary, checkpoints array<long>"
)


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits, by package-merge; all counts are over 0."""
    n = len(counts)
    if n == 1:
        return np.ones(1, np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} ids don't fit into codes of {limit} bits")
    order = np.argsort(counts, kind="stable")
    weights = counts[order].astype(np.float64)
    level, leaves = weights, [np.arange(n + 1)]
    for _ in range(limit - 1):
        packs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate((weights, packs))
        by = np.argsort(both, kind="stable")
        level = both[by]
        leaves.append(np.concatenate(([0], np.cumsum(by < n))))
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for seen in reversed(leaves):
        own = int(seen[take])
        lengths[:own] += 1
        take = 2 * (take - own)
    out = np.zeros(n, np.int64)
    out[order] = lengths
    return out


def canonical(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the symbols (by length, then id) and their codes in that order."""
    order = np.lexsort((ids, lengths))
    sizes = lengths[order].astype(np.int64)
    # The code of a symbol is the sum of the shares of all before it.
    shares = np.left_shift(np.int64(1), MAX_BITS - sizes)
    first = np.cumsum(shares) - shares
    return order, first >> (MAX_BITS - sizes)


def pack(codes: np.ndarray, sizes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Codes as a bit stream, highest bit first, and the bit offset of each."""
    ends = np.cumsum(sizes)
    at = ends - sizes
    word, shift = at >> 6, 64 - (at & 63) - sizes
    fits = shift >= 0
    codes = codes.astype(np.uint64)
    high = np.where(fits, codes << np.maximum(shift, 0).astype(np.uint64), codes >> np.maximum(-shift, 0).astype(np.uint64))
    words = np.zeros(int(ends[-1] >> 6) + 2, np.uint64)
    first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
    words[word[first]] = np.bitwise_or.reduceat(high, first)
    over = np.flatnonzero(~fits)
    words[word[over] + 1] |= codes[over] << (64 + shift[over]).astype(np.uint64)
    return words.astype(">u8").tobytes()[: int(ends[-1] + 7) // 8], at


class Codebook:
    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        order, codes = canonical(ids, lengths)
        self.ids, self.sizes, self.codes = ids[order].astype(np.uint32), lengths[order].astype(np.uint8), codes.astype(np.uint32)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        if not hasattr(self, "code_of"):
            top = int(self.ids.max()) + 1
            self.code_of, self.size_of = np.zeros(top, np.uint32), np.zeros(top, np.int64)
            self.code_of[self.ids], self.size_of[self.ids] = self.codes, self.sizes
        return pack(self.code_of[ids], self.size_of[ids])

    def decode(self, streams: list[bytes], checkpoints: list[np.ndarray], counts: list[int]) -> list[np.ndarray]:
        """Ids of several blocks; all their stretches of STEP ids advance together."""
        if not hasattr(self, "next_id"):
            spans = np.left_shift(1, MAX_BITS - self.sizes.astype(np.int64))
            self.next_id, self.next_size = np.zeros(1 << MAX_BITS, np.uint32), np.zeros(1 << MAX_BITS, np.uint8)
            used = int(spans.sum())
            self.next_id[:used], self.next_size[:used] = np.repeat(self.ids, spans), np.repeat(self.sizes, spans)
        padded = [s + bytes(16 + -len(s) % 8) for s in streams]
        words = np.frombuffer(b"".join(padded), ">u8").astype(np.uint64)
        bases = np.cumsum([0, *[len(p) * 8 for p in padded[:-1]]])
        at = np.concatenate([c + b for c, b in zip(checkpoints, bases, strict=True)]).astype(np.int64)
        lanes = np.array([len(c) for c in checkpoints])
        out = np.zeros((len(at), STEP), np.uint32)
        last = len(words) * 64 - 64
        for k in range(STEP):
            np.minimum(at, last, out=at)  # lanes that are over run into the padding
            w, s = at >> 6, (at & 63).astype(np.uint64)
            bits = (words[w] << s) | ((words[np.minimum(w + 1, len(words) - 1)] >> np.uint64(1)) >> (np.uint64(63) - s))
            index = (bits >> np.uint64(64 - MAX_BITS)).astype(np.int64)
            out[:, k] = self.next_id[index]
            at += self.next_size[index]
        ends = np.cumsum(lanes)
        return [out[e - n : e].reshape(-1)[:count] for e, n, count in zip(ends, lanes, counts, strict=True)]


def _texts(docs: DataFrame, path: str) -> tuple[DataFrame, tuple]:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return rows, split_columns(F.col("text"), path)


def _add(total: np.ndarray, ids: np.ndarray) -> np.ndarray:
    found = np.bincount(ids) if len(ids) else np.zeros(0, np.int64)
    if len(found) > len(total):
        found, total = total, found.astype(np.int64)
    total[: len(found)] += found
    return total


def _draft_code(docs: DataFrame, path: str, n_docs: int) -> "Codebook":
    """A code for all ids of the vocabulary, from a bounded sample; it only sizes the draft."""
    rows, (parts, whole) = _texts(docs.where(unit("doc_id", seed=6) < min(1.0, DRAFT_DOCS / max(1, n_docs))), path)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            if batch.num_rows:
                total = _add(total, np.concatenate(Encoder.of(path).rows(batch.column(0), batch.column(1))[1]))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["id", "n"])

    sums = rows.select(parts.alias("parts"), whole.alias("whole")).mapInArrow(tally, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.ones(Encoder.of(path).ids_in_use(), np.int64)
    for r in sums.collect():  # as many rows as the vocabulary has ids
        counts[r["id"]] += 100 * r["n"]
    return Codebook(np.arange(len(counts)), code_lengths(counts))


class _Blocks:
    """Collects documents and closes blocks."""

    schema = pa.schema([
        ("part", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())),
        ("n_ids", pa.int64()), ("bits", pa.binary()), ("checkpoints", pa.list_(pa.int64())),
    ])

    def __init__(self, code: "Codebook", part: int):
        self.code, self.part, self.number, self.before = code, part, 0, 0
        self.counts = np.zeros(0, np.int64)
        self.names, self.held, self.size = [], [], 0

    @classmethod
    def row(cls, *values) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for f, v in zip(cls.schema, values, strict=True)], schema=cls.schema)

    def add(self, name: int | None, ids: np.ndarray) -> None:
        self.names.append(name)
        self.held.append(ids)
        self.size += len(ids)

    def close(self) -> pa.RecordBatch:
        flat = np.concatenate(self.held)
        self.counts = _add(self.counts, flat)
        bits, at = self.code.encode(flat)
        made = self.row(self.part, self.number, self.before, self.names, [len(h) for h in self.held], len(flat), bits, at[::STEP])
        self.number, self.before = self.number + 1, self.before + len(flat)
        self.names, self.held, self.size = [], [], 0
        return made

    def tally(self) -> pa.RecordBatch:
        """A row of block -1: ids and their counts in this part."""
        used = np.flatnonzero(self.counts)
        return self.row(self.part, -1, 0, used, [], 0, b"", self.counts[used])


def _draft(docs: DataFrame, path: str, out: str, end_id: int) -> None:
    """All texts in order, encoded once by the draft code; each part also tells its counts."""
    spark = docs.sparkSession
    size = docs.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(F.col("text").cast("string"))), F.lit(0)).alias("bytes")
    ).first()
    code = spark.sparkContext.broadcast(_draft_code(docs, path, size["n"]))  # bounded by the vocabulary

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        made = _Blocks(code.value, TaskContext.get().partitionId())
        for batch in batches:
            if batch.num_rows:
                _, rows = Encoder.of(path).rows(batch.column(1), batch.column(2))
                for name, row in zip(batch.column(0).to_pylist(), rows, strict=True):
                    made.add(name, np.append(row, np.uint32(end_id)))
                    if made.size >= BLOCK_IDS:
                        yield made.close()
        if made.held:
            yield made.close()
        if made.number:
            yield made.tally()

    rows, (parts, whole) = _texts(docs, path)
    n_parts = max(1, -(-size["bytes"] // PART_BYTES), spark.sparkContext.defaultParallelism)
    (
        rows.repartitionByRange(n_parts, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
        .select("doc_id", parts.alias("parts"), whole.alias("whole"))
        .mapInArrow(blocks, BLOCKS).write.parquet(out)
    )
    _write_code(spark, code.value, f"{out}-codebook")


def _write_code(spark: SparkSession, code: "Codebook", out: str) -> None:
    rows = [(int(i), int(n)) for i, n in zip(code.ids, code.sizes, strict=True)]
    spark.createDataFrame(rows, "id long, bits int").coalesce(1).write.parquet(out)


def _read_code(spark: SparkSession, path: str):
    book = spark.read.parquet(path).toPandas()  # bounded by the vocabulary
    return spark.sparkContext.broadcast(Codebook(book["id"].to_numpy(), book["bits"].to_numpy()))


def _decoded(batch: pa.RecordBatch, code: "Codebook") -> Iterator[tuple[list, list[np.ndarray]]]:
    """Blocks of a batch, some at a time: (the other columns' values, ids of each)."""
    for k in range(0, batch.num_rows, TOGETHER):
        b = batch.slice(k, TOGETHER)
        part, number, before, doc_ids, lengths, n_ids, bits, marks = (b.column(i) for i in range(8))
        ids = code.decode(bits.to_pylist(), [m.values.to_numpy() for m in marks], n_ids.to_pylist())
        yield [part, number, before, doc_ids, lengths], ids


def _id_counts(draft: DataFrame) -> DataFrame:
    """id, n from the parts' tallies. A task adds up several parts before its sums leave it, so they don't grow with the number of parts."""
    tallies = draft.where("block = -1").select("doc_ids", "checkpoints")
    n_tasks = max(tallies.sparkSession.sparkContext.defaultParallelism, math.isqrt(tallies.count()))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for ids, counts in zip(batch.column(0), batch.column(1), strict=True):
                ids, counts = ids.values.to_numpy(), counts.values.to_numpy()
                if len(ids) and ids.max() >= len(total):
                    total = np.concatenate((total, np.zeros(int(ids.max()) + 1 - len(total), np.int64)))
                total[ids] += counts
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["id", "n"])

    merged = tallies.coalesce(n_tasks).mapInArrow(add_up, "id long, n long")
    return merged.groupBy("id").agg(F.sum("n").alias("n"))


def write_ids(docs: DataFrame, path: str, out: str, end_id: int = 2) -> None:
    """Encode all texts and write ``out``/codebook and ``out``/blocks."""
    spark = docs.sparkSession
    at = scratch_path(spark, "id-draft")
    _draft(docs, path, at, end_id)
    draft = spark.read.schema(BLOCKS).parquet(at)
    counts = _id_counts(draft).toPandas()  # bounded by the vocabulary
    if len(counts):
        final = Codebook(counts["id"].to_numpy(), code_lengths(counts["n"].to_numpy()))
    else:
        final = Codebook(np.array([end_id]), np.ones(1, np.int64))
    _write_code(spark, final, f"{out}/codebook")
    old, new = _read_code(spark, f"{at}-codebook"), spark.sparkContext.broadcast(final)

    def recode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (part, number, before, doc_ids, lengths), streams in _decoded(batch, old.value):
                coded = [new.value.encode(ids) for ids in streams]
                yield pa.RecordBatch.from_arrays(
                    [
                        part, number, before, doc_ids, lengths, pa.array([len(i) for i in streams], pa.int64()),
                        pa.array([b for b, _ in coded], pa.binary()), pa.array([a[::STEP] for _, a in coded], pa.list_(pa.int64())),
                    ],
                    schema=_Blocks.schema,
                )

    draft.where("block >= 0").mapInArrow(recode, BLOCKS).write.parquet(f"{out}/blocks")


def read_ids(spark: SparkSession, out: str, digest: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and the ids, or their unsigned crc32 as little-endian 32-bit numbers."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{out}/blocks")
    code = _read_code(spark, f"{out}/codebook")
    last = ("ids_crc32", pa.int64(), "long") if digest else ("ids", pa.list_(pa.int64()), "array<long>")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (part, _, before, doc_ids, lengths), streams in _decoded(batch, code.value):
                names, starts, sizes, values, parts = [], [], [], [], []
                for i, ids in enumerate(streams):
                    size = lengths[i].values.to_numpy().astype(np.int64)
                    ends = np.cumsum(size)
                    names += doc_ids[i].as_py()
                    starts.append(before[i].as_py() + ends - size)
                    sizes.append(size)
                    parts.append(np.full(len(size), part[i].as_py()))
                    for a, e in zip(ends - size, ends, strict=True):
                        own = ids[a:e]
                        values.append(zlib.crc32(own.astype("<u4").tobytes()) if digest else own.astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(parts), pa.int32()), pa.array(names, pa.int64()), pa.array(np.concatenate(starts), pa.int64()),
                        pa.array(np.concatenate(sizes), pa.int64()), pa.array(values, last[1]),
                    ],
                    names=["part", "doc_id", "start", "n_tokens", last[0]],
                )

    sums = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row per part
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    read = blocks.mapInArrow(unpack, f"part int, doc_id long, start long, n_tokens long, {last[0]} {last[2]}")
    return read.join(offsets, "part").select(
        "doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", last[0]
    )
