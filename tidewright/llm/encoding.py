"""Whole texts to ids of a tokenizer of the ``tokenizers`` library, exactly as the library gives them.

Byte-level tokenizers split a text by a fixed pattern before they merge, and merge each part on its own.
So the JVM splits texts, and the library's model encodes every different part once per worker (a bounded cache). Texts that hold
added special strings, or characters outside a range on whose classes all pattern engines agree, go through the library
whole; so does everything for tokenizers of another kind.
"""

from __future__ import annotations

import json
import os
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the split of byte-level tokenizers. No two of the first nine choices can begin alike but for the blank, so their order is free.
SPLIT = r" ?\p{L}+|'s|'t|'re|'ve|'m|'ll|'d| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SETTLED = r"^[\t-\r -~¡-ɏ‐-‧‰-⁞€]*$"
CACHE = 400_000  # parts kept per worker


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write for bytes: printable ones for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Encoder:
    """One per worker process and vocabulary file."""

    _open: dict[str, "Encoder"] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark shares out the work
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.known: dict[str, int] = {}  # part to its number
        self.sizes = self.starts = self.hits = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    @classmethod
    def of(cls, path: str) -> "Encoder":
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def whole(self, text: str):
        return self.tokenizer.encode(text, add_special_tokens=False)

    def ids_in_use(self) -> int:
        return max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1

    def _forget(self) -> None:
        """Keep the parts met most often, half of the cache at most."""
        limit = np.sort(self.hits)[-CACHE // 2]
        keep = np.flatnonzero(self.hits > limit)
        sizes = self.sizes[keep]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[keep] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        names = list(self.known)
        self.known = {names[k]: i for i, k in enumerate(keep)}
        self.pool, self.sizes, self.starts, self.hits = self.pool[at], sizes, ends - sizes, np.zeros(len(keep), np.int64)

    def _learn(self, parts: list[str]) -> np.ndarray:
        """Numbers of the parts in the pool; unknown ones are encoded first."""
        if len(self.known) > CACHE:
            self._forget()
        numbers = np.fromiter(map(self.known.get, parts, repeat(-1)), np.int64, len(parts))
        unknown = np.flatnonzero(numbers < 0)
        if len(unknown):
            new = [parts[i] for i in unknown]
            tokenize, letters = self.model.tokenize, self.letters
            ids = [[t.id for t in tokenize(p.encode().decode("latin-1").translate(letters))] for p in new]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum()))
            numbers[unknown] = np.arange(len(self.known), len(self.known) + len(new))
            self.known.update(zip(new, numbers[unknown].tolist(), strict=True))
            self.starts = np.concatenate((self.starts, len(self.pool) + np.cumsum(sizes) - sizes))
            self.sizes, self.pool = np.concatenate((self.sizes, sizes)), np.concatenate((self.pool, flat))
            self.hits = np.concatenate((self.hits, np.zeros(len(new), np.int64)))
        self.hits[numbers] += 1
        return numbers

    def parts(self, flat: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids of each part, and all ids in a row."""
        if not len(flat):
            return np.zeros(0, np.int64), np.zeros(0, np.uint32)
        coded = flat.dictionary_encode()
        number = self._learn(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy(zero_copy_only=False)]
        sizes = self.sizes[number]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[number] - (ends - sizes), sizes) + np.arange(ends[-1])
        return sizes, self.pool[at]

    def rows(self, split: pa.ListArray, whole: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
        """Per row the number of ids, and the ids; a row has either parts or a whole text."""
        offsets = split.offsets.to_numpy()
        sizes, ids = self.parts(split.values.slice(offsets[0], offsets[-1] - offsets[0]))
        ends = np.concatenate(([0], np.cumsum(sizes)))[offsets - offsets[0]]
        out = [ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        for i in np.flatnonzero(pc.is_valid(whole).to_numpy(zero_copy_only=False)):
            out[i] = np.array(self.whole(whole[int(i)].as_py()).ids, np.uint32)
        return np.fromiter(map(len, out), np.int64, len(out)), out


def splittable(path: str) -> tuple[bool, list[str]]:
    """May texts be split before they are encoded? And the added strings of the vocabulary."""
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    pre = made.get("pre_tokenizer") or {}
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    return plain and made.get("normalizer") is None, [t["content"] for t in made.get("added_tokens", [])]


def split_columns(text: Column, path: str) -> tuple[Column, Column]:
    """(parts, whole): an array of parts and null, or null and the text itself."""
    can, added = splittable(path)
    fine = text.rlike(SETTLED) if can else F.lit(False)
    for s in added:
        fine = fine & ~text.contains(s)
    return (
        F.when(fine, F.regexp_extract_all(text, F.lit(SPLIT), F.lit(0))),
        F.when(~fine, text),
    )
