"""Token counts and id files against the library's own encoding."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidewright.llm import token_counts, token_output

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
SCHEMA = "doc_id long, text string, parts string, n_tokens int, piece string"


def texts():
    rng = random.Random(3)
    words = ["don't", "we're", "  ", "\n\n", "naïve", "x" * 90, "1234567", "$$$", "日本語", "🙂🙂", "<|endoftext|>", "<|endof", "text|>", "'re", " ", "\u0085", "ſ", "a\tb"]
    made = [None, "", " ", "a", "y" * 700, " " * 300, "ab " * 200, "<|endoftext|>" * 9]
    made += ["".join(rng.choice(words) + rng.choice(["", " ", "'"]) for _ in range(rng.randrange(1, 120))) for _ in range(60)]
    return [(i if i != 5 else None, t, "p", 1, "q") for i, t in enumerate(made)] + [(7, "twice the same", None, None, None)] * 2


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("chunk,overlap", [(40, 8), (64, 30), (100_000, 512)])
def test_counts_of_cut_texts(spark, library, chunk, overlap):
    rows = texts()
    got = token_counts.count_tokens(spark.createDataFrame(rows, SCHEMA), PATH, limit=50, chunk=chunk, overlap=overlap).collect()
    want = sorted(((i is None, i or 0), len((t or "").encode()), len(library(t)), len(library(t)) > 50) for i, t, *_ in rows)
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want


def test_counts_of_no_rows(spark):
    assert token_counts.count_tokens(spark.createDataFrame([], SCHEMA), PATH).count() == 0


def test_id_files_round_trip(spark, library, tmp_path):
    rows = texts()
    token_output.write_ids(spark.createDataFrame(rows, SCHEMA), PATH, str(tmp_path / "ids"))
    got = token_output.read_ids(spark, str(tmp_path / "ids")).collect()
    want = sorted(((i is not None, i or 0), [*library(t), 2]) for i, t, *_ in rows)
    assert sorted(((r.doc_id is not None, r.doc_id or 0), r.ids) for r in got) == want
    by_start = sorted(got, key=lambda r: r.start)
    assert [r.start for r in by_start] == list(np.cumsum([0, *[r.n_tokens for r in by_start[:-1]]]))
    assert [r.doc_id or -1 for r in by_start] == sorted(r.doc_id or -1 for r in by_start)
    crc = {r.start: r.ids_crc32 for r in token_output.read_ids(spark, str(tmp_path / "ids"), digest=True).collect()}
    assert all(crc[r.start] == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got)


def test_id_files_of_no_rows(spark, tmp_path):
    token_output.write_ids(spark.createDataFrame([], SCHEMA), PATH, str(tmp_path / "ids"))
    assert token_output.read_ids(spark, str(tmp_path / "ids")).count() == 0


@pytest.mark.parametrize("n,limit", [(1, 4), (2, 4), (16, 4), (300, 10), (5000, 20)])
def test_code_lengths_fit_and_are_best(n, limit):
    rng = np.random.default_rng(n)
    counts = (rng.pareto(0.6, n) * 3 + 1).astype(np.int64)
    sizes = token_output.code_lengths(counts, limit)
    assert sizes.min() >= 1 and sizes.max() <= limit and (0.5**sizes).sum() <= 1
    if n == 300:  # as good as unlimited Huffman where that keeps the limit, never better than the entropy
        p = counts / counts.sum()
        assert (p * sizes).sum() >= -(p * np.log2(p)).sum()
    order = np.lexsort((sizes, -counts))
    assert all(a <= b for a, b in zip(np.sort(sizes), sizes[order], strict=True)) or n == 1


def test_blocks_of_skewed_ids_round_trip():
    rng = np.random.default_rng(1)
    ids = np.minimum((rng.pareto(0.5, 200_000)).astype(np.int64), 50_256)
    used, counts = np.unique(ids, return_counts=True)
    book = token_output.Codebook(used, token_output.code_lengths(counts))
    cut = [ids[:1], ids[1:700], ids[700:]]
    made = [book.encode(c) for c in cut]
    back = book.decode([b for b, _ in made], [at[:: token_output.STEP] for _, at in made], [len(c) for c in cut])
    assert all((a == b).all() for a, b in zip(cut, back, strict=True))
