"""Target-distribution importance resampling with bit-sliced weights.

Features of a text are its runs of 1 to 3 words, hashed to ``BUCKETS`` buckets. A bucket's gain tells how much likelier it is
in the target texts than in all documents, in thousandths of a nat, as an integer. A document's weight is the sum of the gains of its
features. Documents are drawn without replacement by the greatest weight plus Gumbel noise from a hash of the doc_id.

1. Bucket counts of both tables are added up per task and merged: 10,000 numbers, whatever the input's size.
2. The gains become signed bit planes: plane i of a sign holds bit i of the absolute gains of that sign.
3. Each document's bucket counts become bit planes of 10,000 bits: plane j holds bit j of every count. Plane by plane they are ANDed with
   the gain planes; the set bits, counted and multiplied by 2^(i+j), add up to the exact weight.
4. Ranks come from a global order over range partitions of narrow rows; no task sees more than its share.

Texts are read twice, once for the counts and once for the weights, and cut at word bounds into pieces of ``PIECE`` bytes, so that long
texts need no more memory than others.

Cases: null and empty texts, and texts without words, have no features and weight 0. Repeated rows count, and are scored and drawn, each for
itself; of equal scores the smaller doc_id comes first. A null doc_id is hashed as the text ``null`` and comes first in ties. Without target
texts all gains come from the documents alone. An empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, map_rows, store
from .order import numbered

BUCKETS, LONGEST = 10_000, 3
MIN_WORDS, PERCENT, SEED = 20, 5, 42
PIECE = 1 << 20
LANES = -(-BUCKETS // 64)  # 64-bit words of a plane


def _word_letters() -> bytes:
    """Byte table: A-Z become a-z; digits, a-z and all bytes beyond ASCII stay; everything else is a space."""
    out = bytearray(b" " * 128 + bytes(range(128, 256)))
    out[0x30:0x3A] = range(0x30, 0x3A)
    out[0x61:0x7B] = out[0x41:0x5B] = range(0x61, 0x7B)
    return bytes(out)


_LETTERS = _word_letters()


def pieces(text: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text, a list per piece of about ``size`` bytes."""
    at = 0
    while at < len(text):
        end = at + size
        if end < len(text):
            # Words are cut at a space of the translated text; one longer than a piece stays whole.
            while (cut := text[at:end].translate(_LETTERS).rfind(b" ")) < 0 and end < len(text):
                end += size
            end = at + cut + 1 if cut >= 0 else len(text)
        yield text[at:end].translate(_LETTERS).split()
        at = end


def bucket_counts(text: bytes, size: int = PIECE) -> tuple[np.ndarray, int, int]:
    """Features per bucket, their number, and the number of words."""
    counts = np.zeros(LANES * 64, np.int64)
    n_words = 0
    last: list[list[int]] = [[] for _ in range(LONGEST)]  # checksum of the run of each length that ends at the last word
    for words in pieces(text, size):
        if not words:
            continue
        runs = list(map(crc32, words))
        tails = [b" " + w for w in words]
        n_words += len(words)
        ends = []
        for length in range(LONGEST):
            if length:
                # A run is the run before it, one word back, and a space and the word; the first words go on from the last piece.
                behind = last[length - 1] + ends[-1][:-1]
                runs = list(map(crc32, tails[len(words) - len(behind):], behind))
            ends.append(runs)
            counts += np.bincount(np.array(runs, np.int64) % BUCKETS, minlength=len(counts))
        last = [e[-1:] or b for e, b in zip(ends, last)]
    return counts, int(counts.sum()), n_words


def planes(values: np.ndarray) -> np.ndarray:
    """Bit planes of non-negative numbers, least bit first, as rows of 64-bit words."""
    n_bits = int(values.max(initial=0)).bit_length()
    bits = (values[None, :] >> np.arange(n_bits)[:, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=1, bitorder="little").view(np.uint64)


class GainPlanes:
    """Gains per bucket as signed bit planes."""

    def __init__(self, gains: list[int]):
        padded = np.zeros(LANES * 64, np.int64)
        padded[:BUCKETS] = gains
        up, down = planes(np.maximum(padded, 0)), planes(np.maximum(-padded, 0))
        self.planes = np.concatenate((up, down))
        self.powers = [1 << i for i in range(len(up))] + [-(1 << i) for i in range(len(down))]

    def weigh(self, counts: np.ndarray) -> int:
        """Sum of count times gain, from set bits alone."""
        total = 0
        for j, plane in enumerate(planes(counts)):
            ones = np.bitwise_count(self.planes & plane).sum(axis=1, dtype=np.int64).tolist()
            total += sum(p * n for p, n in zip(self.powers, ones)) << j
        return total


def _raw(texts: pa.Array) -> Iterator[bytes]:
    for value in texts.cast(pa.binary()):
        yield value.as_py() or b""


def corpus_counts(texts: DataFrame) -> list[int]:
    """Features per bucket of all texts: 10,000 numbers reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LANES * 64, np.int64)
        for batch in batches:
            for text in _raw(batch.column(0)):
                total += bucket_counts(text)[0]
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    by_bucket = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    out = [0] * BUCKETS
    for row in by_bucket.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow().to_pylist():
        out[row["bucket"]] = row["n"]
    return out


def gains(background: list[int], target: list[int]) -> list[int]:
    """Log ratio of smoothed bucket shares, in thousandths, rounded down."""
    s_all, t_all = sum(background), sum(target)
    return [
        math.floor(1000 * math.log(float(t + 1) * float(s_all + BUCKETS) / (float(s + 1) * float(t_all + BUCKETS))))
        for s, t in zip(background, target)
    ]


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Noise in thousandths, by a hash of the id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def weighed(docs: DataFrame, target: DataFrame) -> DataFrame:
    """doc_id, n_words, n_features, weight of every document."""
    table = docs.sparkSession.sparkContext.broadcast(GainPlanes(gains(corpus_counts(docs), corpus_counts(target))))  # 28 planes of 1.25 KB

    def run(ids, texts) -> dict:
        rows = [(n_words, n, table.value.weigh(c)) for c, n, n_words in map(bucket_counts, _raw(texts))]
        return {"doc_id": ids, "n_words": [r[0] for r in rows], "n_features": [r[1] for r in rows], "weight": [r[2] for r in rows]}

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_rows(rows, ["doc_id", "text"], run, "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every document; rank is null where it isn't drawn.

    Of the documents with at least ``min_words`` words ``percent`` in a hundred are drawn.
    """
    scored = store(weighed(docs, target).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)), "resample")
    fit = F.col("n_words") >= min_words
    drawn = scored.where(fit).count() * percent // 100
    order = [fit.desc(), F.col("score").desc(), F.col("doc_id").asc()]
    placed = numbered(scored, order, "_position", "resample-order")
    # Those fit come first, so the first places are theirs.
    rank = F.when(F.col("_position") < drawn, F.col("_position") + 1)
    return placed.select("doc_id", "n_words", "n_features", "weight", "score", rank.cast("long").alias("rank"))


def select(docs: DataFrame, target: DataFrame, **how) -> DataFrame:
    """The drawn documents with all their columns; where an id repeats, all its rows if one of them is drawn."""
    key = free_name(docs, "drawn_id")
    ids = resample(docs, target, **how).where("rank IS NOT NULL").select(F.col("doc_id").alias(key)).distinct()
    return docs.join(ids, docs["doc_id"].cast("long").eqNullSafe(F.col(key)), "left_semi")


# The same over whole tables, with the checksum of each distinct feature from its bytes.
SQL = """
WITH words AS (
  SELECT src, id, list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
  FROM (SELECT 'd' AS src, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark)
), grams AS (
  SELECT src, id, unnest(list_concat(w, list_concat(
    list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
    list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])))) AS feature
  FROM words
), counted AS (SELECT src, id, feature, count(*) AS c FROM grams GROUP BY ALL),
sieve AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), distinct_features AS (SELECT DISTINCT feature, hex(encode(feature)) AS h FROM counted),
checks AS (
  SELECT feature, xor(list_reduce(list_concat([4294967295], list_transform(range(len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM distinct_features, sieve
), per_bucket AS (SELECT src, id, bucket, sum(c)::BIGINT AS c FROM counted JOIN checks USING (feature) GROUP BY ALL),
sums AS (SELECT bucket, coalesce(sum(c) FILTER (src = 'd'), 0)::BIGINT AS s, coalesce(sum(c) FILTER (src = 'b'), 0)::BIGINT AS t FROM per_bucket GROUP BY bucket),
totals AS (SELECT sum(s)::BIGINT AS s_all, sum(t)::BIGINT AS t_all FROM sums),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000)::DOUBLE / ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS gain FROM sums, totals
), weights AS (
  SELECT id, sum(c)::BIGINT AS n_features, sum(c * gain)::BIGINT AS weight FROM per_bucket JOIN gains USING (bucket) WHERE src = 'd' GROUP BY id
), scored AS (
  SELECT w.id AS doc_id, len(w.w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || w.id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM words w LEFT JOIN weights USING (id) WHERE w.src = 'd'
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS r, count(*) FILTER (n_words >= 20) OVER () AS n FROM scored
)
SELECT doc_id, n_words::BIGINT AS n_words, n_features, weight, score, CASE WHEN n_words >= 20 AND r <= 5 * n // 100 THEN r END AS rank FROM ranked
"""
