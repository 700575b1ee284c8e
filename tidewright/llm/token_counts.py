"""Token counts of huge documents by overlap resynchronisation.

A long text is cut into chunks that overlap; every chunk is encoded by itself. The encoder splits text into parts from
left to right and never looks back, so where both chunks start a part at the same place of their overlap, all that
follows is split alike: there the counts are spliced. Places close to a chunk's end don't count, as its last parts may be cut
short. Documents with a pair of chunks that share no such place are done again with wider overlaps, until the overlap is
the text itself.

Cases: a null text is empty and has no tokens. Repeated rows, also with null ids, are counted one by one. An empty table
gives an empty result. Only the named columns of the input are used.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import map_rows, store
from .encoding import Encoder, split_columns, splittable

CHUNK, OVERLAP, WIDEN = 32_768, 512, 8
KEY = ["doc_id", "n_bytes", "crc", "hash"]
CUT_SHORT = 16  # characters before a chunk's end whose parts may still change; more where added strings are longer


def _chunks(docs: DataFrame, chunk: int, overlap: int, path: str) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    pieces = F.regexp_extract_all("text", F.lit(rf"(?s)\G(?=(.{{1,{chunk + overlap}}})).{{1,{chunk}}}"), F.lit(1))
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
        .select(
            "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.crc32(F.col("text").cast("binary")).alias("crc"),
            F.xxhash64("text").alias("hash"),
            # A text that a chunk with its overlap can hold is not cut.
            F.when(F.char_length("text") <= chunk + overlap, F.array("text")).otherwise(pieces).alias("pieces"),
        )
        .select(*KEY, F.size("pieces").alias("n_chunks"), F.posexplode("pieces").alias("chunk", "piece"))
    )
    parts, whole = split_columns(F.col("piece"), path)
    return rows.select(*KEY, "n_chunks", "chunk", parts.alias("parts"), whole.alias("whole"))


def _places(chars: np.ndarray, tokens: np.ndarray, at: int, chunk: int, overlap: int, last: bool, short: int):
    """Part starts (in the text) and tokens before them, in the overlaps at the left and the right end."""
    starts, before = np.cumsum(chars) - chars, np.cumsum(tokens) - tokens
    total = int(chars.sum())
    left = starts < overlap if at else np.zeros(len(starts), bool)
    right = (starts >= chunk) & (starts <= total - short) if not last else np.zeros(len(starts), bool)
    pick = lambda m: [{"at": at * chunk + int(s), "before": int(b)} for s, b in zip(starts[m], before[m], strict=True)]
    return pick(left), pick(right)


def _counter(path: str, chunk: int, overlap: int):
    short = max([CUT_SHORT, *[len(s) + 1 for s in splittable(path)[1]]])

    def count(*cols) -> dict:
        *keys, n_chunks, number, split, whole = cols
        encoder = Encoder.of(path)
        offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
        flat = split.values.slice(split.offsets[0].as_py(), int(offsets[-1]))
        tokens, _ = encoder.parts(flat)
        chars = pc.utf8_length(flat).to_numpy(zero_copy_only=False).astype(np.int64)
        totals = np.diff(np.concatenate(([0], np.cumsum(tokens)))[offsets])
        lefts, rights = [], []
        many, at = n_chunks.to_numpy(), number.to_numpy()
        for i in range(len(at)):
            a, b = offsets[i], offsets[i + 1]
            c, t = chars[a:b], tokens[a:b]
            if whole[i].is_valid:
                made = encoder.whole(whole[i].as_py())
                totals[i] = len(made.ids)
                if many[i] > 1:
                    c, t = _parts_of(made, len(whole[i].as_py()))
            left, right = _places(c, t, int(at[i]), chunk, overlap, at[i] + 1 == many[i], short) if many[i] > 1 else ([], [])
            lefts.append(left)
            rights.append(right)
        return {**dict(zip(KEY, keys, strict=True)), "n_chunks": n_chunks, "chunk": number, "n_tokens": totals, "left": lefts, "right": rights}

    return count


def _parts_of(made, n_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """Characters and tokens of the parts of an encoding, from its offsets."""
    words = np.array([-1 if w is None else w for w in made.word_ids], np.int64)
    first = np.flatnonzero(np.concatenate(([True], words[1:] != words[:-1]))) if len(words) else np.zeros(0, np.int64)
    starts = np.array([made.offsets[i][0] for i in first], np.int64)
    return np.diff(np.append(starts, n_chars)), np.diff(np.append(first, len(words)))


def _encode(docs: DataFrame, chunk: int, overlap: int, path: str) -> DataFrame:
    place = "array<struct<at:long,before:long>>"
    return store(
        map_rows(
            _chunks(docs, chunk, overlap, path), [*KEY, "n_chunks", "chunk", "parts", "whole"], _counter(path, chunk, overlap),
            f"doc_id long, n_bytes long, crc long, hash long, n_chunks int, chunk int, n_tokens long, left {place}, right {place}",
        ),
        "token-chunks",
    )


def _splice(chunks: DataFrame) -> DataFrame:
    """KEY, n_tokens: null where a pair of neighbouring chunks shares no place."""
    nxt = Window.partitionBy(*KEY).orderBy("chunk")
    pairs = (
        chunks.where("n_chunks > 1").dropDuplicates([*KEY, "chunk"])
        .withColumn("next", F.lead("left").over(nxt))
        .withColumn("place", F.array_min(F.array_intersect("right.at", "next.at")))
    )
    before = lambda side: F.get(F.filter(side, lambda p: p["at"] == F.col("place")), 0)["before"]
    last = F.col("chunk") + 1 == F.col("n_chunks")
    # Up to the place the left chunk counts, from there the right one.
    own = F.when(last, F.col("n_tokens")).otherwise(F.coalesce(before("right"), F.lit(0)) - F.coalesce(before("next"), F.lit(0)))
    return pairs.groupBy(*KEY).agg(
        F.sum(own).alias("n"), F.min(F.when(last, F.lit(True)).otherwise(F.col("place").isNotNull())).alias("fine")
    ).select(*KEY, F.when(F.col("fine"), F.col("n")).alias("n_tokens"))


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, n_chunks: the counts of the whole texts."""
    chunks = _encode(docs, chunk, overlap, path)
    rows = chunks.where("chunk = 0")  # one for every row of the input
    done = rows.where("n_chunks = 1").select(*KEY, "n_tokens", "n_chunks")
    same = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in KEY]
    spliced = store(_splice(chunks), "token-spliced")
    open_ = spliced.where("n_tokens IS NULL").select(*KEY)
    good = spliced.where("n_tokens IS NOT NULL")
    while open_.take(1):
        overlap *= WIDEN
        text = F.coalesce(F.col("text").cast("string"), F.lit(""))
        keyed = docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"),
            F.crc32(text.cast("binary")).alias("crc"), F.xxhash64(text).alias("hash"),
        )
        again = keyed.alias("d").join(open_.alias("o"), same("d", "o"), "left_semi").dropDuplicates(KEY).select("doc_id", "text")
        wide = _encode(again, chunk + overlap, overlap, path)
        whole = wide.where("n_chunks = 1").select(*KEY, "n_tokens")
        spliced = store(_splice(wide).unionByName(whole), "token-spliced")
        good = good.unionByName(spliced.where("n_tokens IS NOT NULL"))
        open_ = spliced.where("n_tokens IS NULL").select(*KEY)
    long_ = (
        rows.where("n_chunks > 1").drop("n_tokens").alias("r").join(good.alias("g"), same("r", "g"), "left")
        .select(*[F.col(f"r.{k}").alias(k) for k in KEY], F.col("g.n_tokens").alias("n_tokens"), F.col("r.n_chunks").alias("n_chunks"))
    )
    return done.unionByName(long_).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "n_chunks"
    )
