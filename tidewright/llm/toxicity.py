"""Toxicity by compression: how much shorter does a toxic dictionary make each window than an ordinary one?

A window is one word in a constant frame, which puts block headers and the compressor's blind last bytes
out of play. Both dictionaries hold the same frequent ordinary words at the same distances; behind them the one has words
found surely and far more often in toxic training documents, the other as many bytes of further ordinary words. A whole word known
to be toxic, or a stem of one, costs a reference instead of its letters. Documents are judged by how many of their windows
gain so many bytes or more; the limits are calibrated on training documents that the dictionaries have not seen.

Training: rows whose crc32(doc_id as text) mod 5 is not 0, at most about ``MAX_TRAIN`` of them, chosen by hash; of these
remainder 4 calibrates, the others fill the dictionaries. Documents that share their smallest two-word shingle by hash count once in
word statistics, so copies don't make a word frequent. Everything else, windows and scores, covers all texts.

Cases: null and empty texts have no windows and get the score of none. Labels without id or value are left out, of several for one
id the largest holds. Without training documents of both kinds nothing can be learned: every score is 0. Repeated rows are
judged alike. Empty tables give an empty result. Only the named columns of the inputs are used; labels,
lang, source and doc_id are no inputs of a score.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, store, unit
from .license_scan import WORD as ANY_WORD

MAX_TRAIN = 24_000  # labelled documents used for training, about
BASE_WORDS, TOXIC_WORDS = 3_000, 300
MIN_ODDS, MIN_SURE = 2.0, 25.0  # log odds of a toxic word, and its log-likelihood ratio against chance
GAINS = (0, 4, 5, 6, 7, 8)  # bytes a window has to gain, one count each; 0 counts all windows
STEMS = (4, 5, 6)  # letters of word beginnings that count beside whole words
KNOWN = 1_000_000  # gains kept per worker
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
# The frame: its tail is longer than what the compressor leaves out at the end of its input.
OPEN, CLOSE, TAIL = b"\x01\x02\x03\x04", b"\x05\x06\x07\x08", b"0123456789abcdef"


@dataclass
class Model:
    """Two dictionaries and the weights of the counts; ``weights`` is None where nothing could be learned."""

    toxic: bytes = b""
    ordinary: bytes = b""
    weights: list[float] | None = None
    _known: dict[bytes, int] = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return (self.toxic, self.ordinary, self.weights)

    def __setstate__(self, state):
        self.toxic, self.ordinary, self.weights = state
        self._known = {}

    def gain(self, word: bytes) -> int:
        if not hasattr(self, "_pair"):
            import zstandard as z

            how = z.ZstdCompressionParameters.from_level(
                19, window_log=18, min_match=3, strategy=z.STRATEGY_BTOPT, target_length=32, search_log=8,
                write_content_size=0, write_checksum=0, write_dict_id=0,
            )
            self._pair = [
                z.ZstdCompressor(dict_data=z.ZstdCompressionDict(d, dict_type=z.DICT_TYPE_RAWCONTENT), compression_params=how)
                for d in (self.ordinary, self.toxic)
            ]
        window = TAIL + OPEN + word + CLOSE + TAIL
        return len(self._pair[0].compress(window)) - len(self._pair[1].compress(window))

    def counts(self, text: str | None) -> np.ndarray:
        """Windows that gain so many bytes, for each of GAINS."""
        known = self._known
        if len(known) > KNOWN:
            known.clear()
        gains = []
        for w in WORD.findall((text or "").lower().encode("utf-8", "surrogatepass")):
            g = known.get(w)
            if g is None:
                g = known[w] = self.gain(w)
            gains.append(g)
        sizes = np.bincount(np.clip(gains, 0, GAINS[-1]), minlength=GAINS[-1] + 1) if gains else np.zeros(GAINS[-1] + 1)
        return sizes[::-1].cumsum()[::-1][list(GAINS)]


_OPEN: dict[tuple[bytes, bytes], Model] = {}


def _held(model: Model) -> Model:
    """One model per worker and pair of dictionaries, so that known gains are kept between tasks."""
    key = (model.toxic, model.ordinary)
    if key not in _OPEN:
        _OPEN.clear()
        _OPEN[key] = model
    return _OPEN[key]


def _signals(counts: np.ndarray) -> np.ndarray:
    return np.concatenate((np.log1p(counts), np.ones((*counts.shape[:-1], 1))), axis=-1)


def remainder(column: str = "doc_id"):
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(5))


def words_of(text):
    """Words as ``Model.counts`` finds them."""
    return F.regexp_extract_all(F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(ANY_WORD), F.lit(0))


def _training(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, toxic, part: the bounded sample of labelled rows."""
    usable = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(remainder() != 0)
        .groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    )
    total = usable.count()
    chosen = usable.where(unit("doc_id", seed=8) < min(1.0, MAX_TRAIN / max(1, total)))
    return store(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .join(F.broadcast(chosen), "doc_id")  # about MAX_TRAIN narrow rows
        .withColumn("part", remainder()),
        "toxic-train",
    )


def _dictionaries(train: DataFrame) -> tuple[bytes, bytes] | None:
    words = F.col("words")
    near = F.array_min(F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(words) - 2, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(2)]),
    ))
    seen = (
        train.select("toxic", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
        .groupBy(near.alias("near")).agg(F.max(F.struct("toxic", "words")).alias("d")).select("d.toxic", "d.words")
    )
    stems = lambda n: F.transform(F.filter("words", lambda w: F.char_length(w) > n), lambda w: F.concat(w.substr(1, n), F.lit("~")))
    items = F.array_distinct(F.concat("words", *[stems(n) for n in STEMS], F.array(F.lit(""))))
    stats = store(
        seen.select("toxic", F.explode(items).alias("w")).groupBy("w")
        .agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")),
        "toxic-words",
    )
    totals = stats.where("w = ''").first()
    if not totals or not totals["a"] or not totals["b"]:
        return None
    odds = F.log((F.col("a") + 0.5) / (totals["a"] + 1)) - F.log((F.col("b") + 0.5) / (totals["b"] + 1))
    rated = stats.where("w <> ''").withColumn("odds", odds)
    share = totals["a"] / (totals["a"] + totals["b"])
    part = lambda n, p: F.when(F.col(n) > 0, F.col(n) * F.log(F.col(n) / ((F.col("a") + F.col("b")) * p))).otherwise(0.0)
    sure = 2 * (part("a", share) + part("b", 1 - share))
    # The surest words last, nearest to the window; as many words as the dictionary holds reach the driver.
    strong = rated.withColumn("sure", sure).where((F.col("odds") > MIN_ODDS) & (F.col("sure") > MIN_SURE))
    toxic = [r["w"] for r in strong.orderBy(F.desc("sure"), "w").limit(TOXIC_WORDS).collect()][::-1]
    common = [r["w"] for r in rated.where("odds < 0.5 AND NOT endswith(w, '~')").orderBy(F.desc("b"), "w").limit(BASE_WORDS + 10 * TOXIC_WORDS).collect()]
    # A stem stands without its end, so that the rest of a word is left to letters.
    frame = lambda some: b"".join(OPEN + (w[:-1].encode() if w.endswith("~") else w.encode() + CLOSE) for w in some)
    base, extra = frame(common[:BASE_WORDS][::-1]), frame(toxic)
    fill = frame(common[BASE_WORDS:])[: len(extra)] if toxic else b""
    return base + extra + TAIL, base + fill.ljust(len(extra), b"~") + TAIL


def _count_windows(docs: DataFrame, model: Model, columns: str) -> DataFrame:
    """The documents' other columns and the counts of their whole texts."""
    names = [c.split()[0] for c in columns.split(", ")]

    def run(*cols) -> dict:
        held = _held(model)
        return {**dict(zip(names, cols[:-1], strict=True)), "counts": [held.counts(t).tolist() for t in cols[-1].to_pylist()]}

    return map_rows(docs, [*names, "text"], run, f"{columns}, counts array<long>")


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic weights by Newton's steps with a small ridge; the constant is then moved to the best F1."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w -= np.linalg.solve(h, x.T @ (p - y) + 0.1 * w)
    margin = x @ w
    order = np.argsort(-margin, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    ends = np.append(np.diff(margin[order]) < 0, True)
    best = int(np.argmax(np.where(ends, f1, -1)))
    beyond = margin[order][best + 1] if best + 1 < len(y) else margin[order][best] - 2
    w[-1] -= (margin[order][best] + beyond) / 2
    return w


def train(docs: DataFrame, labels: DataFrame) -> Model:
    rows = _training(docs, labels)
    made = _dictionaries(rows.where("part <> 4"))
    if made is None:
        return Model()
    model = Model(*made)
    seen = _count_windows(rows.where("part = 4"), model, "toxic int").toPandas()  # numbers of a part of the bounded sample
    y = seen["toxic"].to_numpy(float) if len(seen) else np.zeros(0)
    if not y.any() or y.all():
        return Model()
    model.weights = _fit(_signals(np.stack(seen["counts"].to_numpy()).astype(float)), y).tolist()
    return model


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, counts (windows that gain at least GAINS bytes)."""
    model = train(docs, labels)
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (remainder() == 0).alias("held_out"), F.col("text").cast("string").alias("text")
    )
    columns = "doc_id long, held_out boolean"
    if model.weights is None:
        none = F.array(*[F.lit(0).cast("long") for _ in GAINS])
        return base.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), none.alias("counts"))
    margin = F.lit(model.weights[-1])
    for k, w in enumerate(model.weights[:-1]):
        margin = margin + F.log1p(F.get("counts", F.lit(k)).cast("double")) * w
    return (
        _count_windows(base, model, columns).withColumn("score", 1 / (1 + F.exp(-margin)))
        .select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "counts")
    )


def remove_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents not predicted to be toxic, judged row by row: no join."""
    model = train(docs, labels)
    if model.weights is None:
        return docs
    weights = np.array(model.weights)

    def keep(*cols):
        held = _held(model)
        counts = np.array([held.counts(t) for t in cols[-1].to_pylist()], float)
        return _signals(counts) @ weights < 0

    text_at = docs.columns.index("text")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(keep(batch.column(text_at))))

    return docs.mapInArrow(run, docs.schema)
