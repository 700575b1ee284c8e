"""Phrase collocation mining over sorted count streams.

All counts are per language. Phrases of 2 to ``LONGEST`` words that occur ``MIN_COUNT`` times are candidates; cutting one after its first k
words compares its count with those of the two parts, and its lowest-scoring cut gives its score.

1. Counting goes level by level. A phrase can only be frequent if both phrases one word shorter inside it are, so a level counts
   those alone: the frequent phrases of the level before are marked in a bitmap of fixed size, in which a clash lets a phrase be counted in
   vain but never loses one. Tasks sort and count the phrases of a few megabytes of text at a time; only their sums are shuffled.
2. The frequent phrases of all lengths form one count stream, stored twice as sorted range partitions: in prefix order (by the
   first word, the second, ...) and in suffix order (by the last word, the one before, ...).
3. In prefix order every first part of a phrase stands before it, with nothing but its own extensions in between. So one pass in lockstep
   meets the counts of all first parts as the last ones of their length; what stands in an earlier partition is handed to a partition by
   a row per partition and length. In suffix order the same gives the counts of the rests. No hash table of phrases is built or probed.
4. Extension counts, the greatest count among phrases one word longer, come from the same two streams: by prefix to the right, by
   suffix to the left. Counts can't rise as phrases grow, so if any longer candidate covers a phrase, one that is a single word longer does.

Cases: null texts are empty; a null language is ``und``, also where that stands in the table. Texts, pieces and languages without words give
nothing. Repeated rows count each. Ties end with the phrase, so ranks are unique. Texts are taken in whole; long ones are cut into
segments that overlap by one word less than the phrases counted. An empty table gives an empty result. Only lang and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from xxhash import xxh64_intdigest

from .common import store
from .order import laid_out

LONGEST, MIN_COUNT, COVERED_PCT, TOP = 4, 30, 80, 2000
SCALE = 2_000_000
BITMAP_WORDS = 1 << 20  # 8 MB, whatever the corpus
SEGMENT, FLUSH = 1 << 22, 1 << 23  # bytes of a segment of a long text; bytes counted at once
SALTS = 256

# What ends a piece, what separates words.
PIECE_ENDS, WORD_GAPS = b".,;:!?\n\x0b\x0c\r", b" \t"

WORDS = [f"w{i}" for i in range(1, LONGEST + 1)]


def _letters() -> bytes:
    """Byte table: A-Z become a-z, ends of pieces line feeds, gaps between words spaces."""
    out = bytearray(range(256))
    out[0x41:0x5B] = range(0x61, 0x7B)
    for c in PIECE_ENDS:
        out[c] = 10
    for c in WORD_GAPS:
        out[c] = 32
    return bytes(out)


_LETTERS = _letters()


# --- frequent phrases of a level ----------------------------------------------------------------------------------------------


def phrase_keys(words: np.ndarray, lang: bytes) -> np.ndarray:
    """A 64-bit key per row of word keys: depends on the words, their order and the language."""
    key = np.full(len(words), xxh64_intdigest(lang), np.uint64)
    for column in words.T:
        key = (key ^ column) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key


def word_keys(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))


class Marked:
    """A bitmap in which phrases are marked; sound in one direction: what was marked is always found."""

    def __init__(self, words: np.ndarray):
        self.words = words

    @staticmethod
    def place(keys: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
        keys = keys ^ (keys >> np.uint64(32))
        bit = keys & np.uint64(63)
        return ((keys >> np.uint64(6)) % np.uint64(n_words)).astype(np.int64), np.uint64(1) << bit

    def has(self, keys: np.ndarray) -> np.ndarray:
        at, bit = self.place(keys, len(self.words))
        return (self.words[at] & bit) != 0


def marked(frequent: DataFrame, n_words: int = BITMAP_WORDS) -> Marked:
    """The bitmap of a table (lang, phrase): merged per word of the bitmap, so at most ``n_words`` rows reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            langs, phrases = (batch.column(i).cast(pa.binary()).to_pylist() for i in range(2))
            split = [p.split(b" ") for p in phrases]
            lang_at = np.array(langs, dtype=object)
            for lang in set(langs):
                mine = np.flatnonzero(lang_at == lang)
                flat = word_keys([w for i in mine for w in split[i]])
                at, bit = Marked.place(phrase_keys(flat.reshape(len(mine), -1), lang), n_words)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(bit.view(np.int64))], names=["at", "bit"])

    bits = frequent.select("lang", "phrase").mapInArrow(run, "at long, bit long")
    rows = bits.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    words = np.zeros(n_words, np.uint64)
    words[rows["at"].to_numpy()] = rows["bits"].to_numpy().astype(np.int64).view(np.uint64)
    return Marked(words)


# --- counting ---------------------------------------------------------------------------------------------------------


def segments(text: bytes, overlap: int, size: int = SEGMENT) -> Iterator[bytes]:
    """A translated text in parts: cut at ends of pieces, else at a gap, with the last ``overlap`` words of the piece once more."""
    at, lead = 0, b""
    while len(text) - at > size:
        cut = text.rfind(b"\n", at + 1, at + size)
        within = cut < 0  # whether the cut lies within a piece
        if within:
            gap, end = text.find(b" ", at + size), text.find(b"\n", at + size)
            if gap < 0 and end < 0:
                break
            within = end < 0 or 0 <= gap < end
            cut = gap if within else end
        part = lead + text[at:cut]
        yield part
        lead = b" ".join(part.split()[-overlap:]) if within and overlap else b""
        at = cut
    yield lead + text[at:]


class Counter:
    """Counts the phrases of ``length`` words in one language's texts, those whose two shorter parts are marked at every level."""

    def __init__(self, length: int, levels: list[Marked]):
        self.length, self.levels = length, levels

    def count(self, lang: bytes, texts: list[bytes]) -> tuple[list[bytes], np.ndarray, int]:
        """Phrases, their counts, and the number of all words."""
        known: dict[bytes, int] = {}
        ids: list[int] = []
        for text in texts:
            for piece in text.split(b"\n"):
                words = piece.split()
                if words:
                    ids += [known.setdefault(w, len(known)) for w in words]
                    ids.append(-1)
        flat = np.array(ids, np.int64)
        n_words = int((flat >= 0).sum())
        names = list(known)
        if self.length == 1 or not n_words:
            return names, np.bincount(flat[flat >= 0], minlength=len(names)), n_words
        keys = word_keys(names)
        rows = np.arange(len(names))[:, None]  # words of each known phrase of the level
        code, at = flat, flat >= 0  # code of the phrase that starts at each place, and whether one does
        for level in range(1, self.length):
            good = self.levels[level - 1].has(phrase_keys(keys[rows], lang))
            at = at & good[np.where(at, code, 0)] if len(good) else np.zeros(len(code), bool)
            # A phrase one word longer starts where this and the next place start frequent ones.
            longer = np.zeros(len(code), bool)
            longer[:-1] = at[:-1] & at[1:]
            places = np.flatnonzero(longer)
            pairs = code[places] * len(rows) + code[places + 1]
            found, back, counts = np.unique(pairs, return_inverse=True, return_counts=True)
            rows = np.column_stack((rows[found // max(1, len(rows))], rows[found % max(1, len(rows))][:, -1]))
            code = np.full(len(flat), -1, np.int64)
            code[places] = back
            at = longer
        return [b" ".join([names[i] for i in r]) for r in rows.tolist()], counts, n_words


def count_level(docs: DataFrame, length: int, levels: list[Marked], size: int = SEGMENT, flush: int = FLUSH) -> DataFrame:
    """lang, phrase, c of all phrases of a length that can be frequent; with length 1 also the number of words, under an empty phrase."""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(length, held.value)
        waiting: dict[bytes, list[bytes]] = {}
        n_bytes = 0

        def done() -> Iterator[pa.RecordBatch]:
            for lang, texts in waiting.items():
                phrases, counts, n_words = counter.count(lang, texts)
                if length == 1 and n_words:
                    phrases, counts = [*phrases, b""], np.append(counts, n_words)
                for a in range(0, len(phrases), 1 << 17):
                    part = phrases[a : a + (1 << 17)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(part), pa.binary()).cast(pa.string()), pa.array(part, pa.binary()).cast(pa.string()),
                         pa.array(counts[a : a + (1 << 17)], pa.int64())], names=["lang", "phrase", "c"],
                    )
            waiting.clear()

        for batch in batches:
            langs, texts = (batch.column(i).cast(pa.binary()) for i in range(2))
            for lang, text in zip(langs, texts, strict=True):
                raw = text.as_py()
                if not raw:
                    continue
                for part in segments(raw.translate(_LETTERS), length - 1, size):
                    waiting.setdefault(lang.as_py(), []).append(part)
                    n_bytes += len(part)
                    if n_bytes >= flush:
                        yield from done()
                        n_bytes = 0
        yield from done()

    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInArrow(run, "lang string, phrase string, c long").groupBy("lang", "phrase").agg(F.sum("c").alias("c"))


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, **sizes) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, c) of all phrases of 1 to ``LONGEST`` words with ``min_count`` occurrences, and (lang, n)."""
    levels: list[Marked] = []
    tables: list[DataFrame] = []
    totals = None
    for length in range(1, LONGEST + 1):
        counted = count_level(docs, length, levels, **sizes).where((F.col("c") >= min_count) | (F.col("phrase") == ""))
        kept = store(counted, f"phrases-{length}")
        if totals is None:
            totals = kept.where("phrase = ''").select("lang", F.col("c").alias("n"))
            kept = kept.where("phrase <> ''")
        tables.append(kept)
        if length < LONGEST:
            if not kept.take(1):
                break
            levels.append(marked(kept))
    every = tables[0]
    for t in tables[1:]:
        every = every.unionByName(t)
    return every, totals


# --- count streams ----------------------------------------------------------------------------------------------------


def _stream(phrases: DataFrame, words: list[str], name: str) -> DataFrame:
    """The phrases in the order of ``words`` (nulls first), with the counts ``part_1`` ... of their parts of the first 1, 2, ... words."""
    order = [F.col("lang"), *[F.col(w) for w in words]]
    laid = laid_out(phrases, order, "_part", name)
    lockstep = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lengths = range(1, LONGEST)
    met = laid.withColumns({f"part_{k}": F.last(F.when(F.col("size") == k, F.col("c")), ignorenulls=True).over(lockstep) for k in lengths})
    # A part that stands in an earlier partition is also a part of this partition's first phrase: one row per partition and length.
    firsts = laid.groupBy("_part").agg(F.min(F.struct("lang", *words)).alias("f"))
    asked = firsts.select(
        "_part", F.col("f.lang").alias("lang"), F.explode(F.array(*[F.struct(
            F.lit(k).alias("k"), *[(F.col(f"f.{w}") if i < k else F.lit(None).cast("string")).alias(w) for i, w in enumerate(words)]
        ) for k in lengths])).alias("p"),
    ).select("_part", "lang", "p.*")
    same = F.lit(True)
    for w in words:
        same = same & F.col(f"a.{w}").eqNullSafe(F.col(f"t.{w}"))
    handed = (
        laid.alias("t").join(F.broadcast(asked.alias("a")), (F.col("a.lang") == F.col("t.lang")) & (F.col("t.size") == F.col("a.k")) & same)
        .groupBy("a._part").agg(*[F.max(F.when(F.col("a.k") == k, F.col("t.c"))).alias(f"_h{k}") for k in lengths])
    )
    filled = met.join(F.broadcast(handed), "_part", "left")
    return filled.withColumns({f"part_{k}": F.coalesce(f"part_{k}", f"_h{k}") for k in lengths}).drop("_part", *[f"_h{k}" for k in lengths])


def _greatest_extension(phrases: DataFrame, words: list[str], name: str) -> DataFrame:
    """lang, the words of a phrase, and the greatest count of a candidate one word longer at the end of ``words``."""
    cut = [F.when(F.col("size") > i + 1, F.col(w)).alias(w) for i, w in enumerate(words)]
    return phrases.where("size > 2").select("lang", *cut, "c").groupBy("lang", *words).agg(F.max("c").alias(name))


def candidates(phrases: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score, longer (the greatest count of a covering candidate) of all candidates."""
    split = F.split("phrase", " ")
    n = F.size(split)
    backwards = [f"z{i}" for i in range(1, LONGEST + 1)]
    table = store(
        phrases.select("lang", "phrase", "c", n.cast("int").alias("size"), *[F.get(split, F.lit(i)).alias(w) for i, w in enumerate(WORDS)],
                       *[F.get(split, n - 1 - i).alias(z) for i, z in enumerate(backwards)]),
        "phrases",
    )
    # Each stream carries what it needs; they meet again on the whole phrase, which is unique.
    left = _stream(table.drop(*backwards), WORDS, "prefix-order")
    right = _stream(table.drop(*WORDS), backwards, "suffix-order")
    to_right = _greatest_extension(table, WORDS, "more_right")
    to_left = _greatest_extension(table, backwards, "more_left")

    def on(words):
        same = F.col("s.lang") == F.col("e.lang")
        for w in words:
            same = same & F.col(f"s.{w}").eqNullSafe(F.col(f"e.{w}"))
        return same

    left = left.where("size > 1").alias("s").hint("merge").join(to_right.alias("e"), on(WORDS), "left").select(
        "s.lang", "s.phrase", F.col("s.c").alias("a"), "s.size", *[F.col(f"s.part_{k}").alias(f"l{k}") for k in range(1, LONGEST)], "e.more_right"
    )
    right = right.where("size > 1").alias("s").hint("merge").join(to_left.alias("e"), on(backwards), "left").select(
        "s.lang", "s.phrase", *[F.col(f"s.part_{k}").alias(f"r{k}") for k in range(1, LONGEST)], "e.more_left"
    )
    both = left.hint("merge").join(right, ["lang", "phrase"])
    cuts = F.array(*[
        F.when((F.col("size") > k) & (F.col("size") - k == rest), F.struct(
            # decimals: the product may pass 64 bits; div cuts to whole numbers
            F.expr(f"cast({SCALE} as decimal(18,0)) * cast(a as decimal(20,0)) div (cast(l{k} as decimal(20,0)) + cast(r{rest} as decimal(20,0)))").alias("score"),
            F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{rest}").alias("r"),
        ))
        for k in range(1, LONGEST) for rest in range(1, LONGEST) if k + rest <= LONGEST
    ])
    best = F.array_min(F.filter(cuts, lambda x: x.isNotNull())).alias("best")
    return both.select("lang", "phrase", "a", F.greatest("more_right", "more_left").alias("longer"), best).select(
        "lang", "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), F.col("best.score").cast("long").alias("score"), "longer"
    )


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, covered_pct: int = COVERED_PCT, top: int = TOP, **sizes) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best ``top`` of each language."""
    phrases, totals = frequent_phrases(docs, min_count, **sizes)
    found = candidates(phrases).where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * covered_pct)).drop("longer")
    # The best of each of a fixed number of parts of a language, then the best of these: never a whole language in one task.
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = found.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    part = F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))
    few = salted.withColumn("_place", part).where(F.col("_place") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    ranked = few.withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), words AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, k AS size, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i : i + k - 1])) AS p
  FROM words, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k
), totals AS (SELECT lang, count(*) AS n FROM grams WHERE size = 1 GROUP BY lang),
frequent AS (SELECT lang, size, p, count(*) AS c FROM grams GROUP BY ALL HAVING count(*) >= 30),
cuts AS (
  SELECT f.lang, f.p, f.c AS a, k, l.c AS l, r.c AS r, 2000000::HUGEINT * f.c // (l.c + r.c) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM frequent WHERE size > 1) f
  JOIN frequent l ON l.lang = f.lang AND l.p = f.p[1 : f.k] JOIN frequent r ON r.lang = f.lang AND r.p = f.p[f.k + 1 :]
), best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inner_parts AS (
  SELECT lang, size, c, unnest(list_distinct(flatten(
    list_transform(range(1, size), lambda i: list_transform(range(i + 1, size + 1), lambda j: p[i : j]))))) AS p FROM frequent WHERE size > 2
), covered AS (
  SELECT DISTINCT b.lang, b.p FROM best b JOIN inner_parts i ON i.lang = b.lang AND i.p = b.p WHERE i.size > len(b.p) AND 100 * i.c >= 80 * b.a
), ranked AS (
  SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score,
    row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank
  FROM best ANTI JOIN covered USING (lang, p)
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
