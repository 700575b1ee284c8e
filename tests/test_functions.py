"""Semantics that are easy to get wrong, on small literal frames."""

import hashlib
import math

from pyspark.sql import functions as F

from tidewright.functions import numbers as nb
from tidewright.functions import text as tx
from tidewright.functions import vectors as vx


def values(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_half_even_rounding(frame):
    df = frame([(68.5,), (69.5,), (0.5,), (1.5,)], "x double")
    assert values(df, nb.round_half_even(F.col("x"))) == [68.0, 70.0, 0.0, 2.0]


def test_ratio_of_nothing_is_null(frame):
    df = frame([(1, 0), (1, 3), (0, 5)], "a long, b long")
    assert values(df, nb.ratio_pct(F.col("a"), F.col("b"))) == [None, 33.3, 0.0]


def test_mixed_timestamps(frame):
    texts = [
        "05/03/2024 07:08:09", "2024-03-05 07:08:09", "2024-03-05T07:08:09", "2024/03/05 07:08", "05/03/2024", "2024-03-05",
        "2024/03/05", "5/3/2024", " 2024-3-5", "31/02/2024", "2024-03-05T07:08:09Z", "", None, "yesterday",
    ]
    df = frame([(x,) for x in texts], "t string")
    got = values(df, F.date_format(tx.parse_mixed_timestamp(F.col("t")), "yyyy-MM-dd HH:mm:ss"))
    full, minute, day = "2024-03-05 07:08:09", "2024-03-05 07:08:00", "2024-03-05 00:00:00"
    assert got == [full, full, full, minute, day, day, day, day, day, None, None, None, None, None]


def test_first_keyword_is_list_order_and_substring(frame):
    df = frame([("error in DEPLOY",), ("took 1500ms",), ("fine",), (None,)], "t string")
    rules = [("deploy", "d"), ("error", "e"), ("500", "h")]
    assert values(df, tx.first_keyword(F.col("t"), rules, "none")) == ["d", "h", "none", "none"]


def test_truncate_strips_all_white_space(frame):
    df = frame([("  a\t\n",), ("x" * 201,), ("y" * 200,)], "t string")
    assert values(df, tx.truncate_with_dots(F.col("t"))) == ["a", "x" * 200 + "...", "y" * 200]


def test_template_leaves_slots_inside_values_alone(frame):
    df = frame([("{b}", "two"), (None, "x")], "a string, b string")
    filled = tx.fill_template("<{a}|{b}|{c}>", {"a": F.col("a"), "b": F.col("b")})
    assert values(df, filled) == ["<{b}|two|{c}>", "<|x|{c}>"]


def test_json_map_or_empty(frame):
    df = frame([('{"k": 1}',), ("{broken",), (None,)], "j string")
    assert values(df, tx.json_map_or_empty(F.col("j"))) == [{"k": "1"}, {}, {}]


def test_cap_items(frame):
    df = frame([(["a" * 300, "b", "c", "d", "e", "f"],)], "x array<string>")
    assert [len(v) for v in values(df, tx.cap_items(F.col("x")))[0]] == [200, 1, 1, 1, 1]


def test_levels(frame):
    df = frame([(80,), (79,), (60,), (35,), (34,)], "s int")
    assert values(df, nb.risk_level(F.col("s"))) == ["critical", "high", "high", "medium", "low"]


def test_hash_embedding_matches_plain_python(frame):
    texts = ["  Disk Full \n", "", "naïve café", "x" * 5000]
    got = values(frame([(x,) for x in texts], "t string"), vx.hash_embedding(F.col("t")))
    for text, vec in zip(texts, got):
        base = text.lower().strip()
        raw = [b / 255.0 * 2 - 1 for i in range(2) for b in hashlib.sha256(f"{base}::{i}".encode()).digest()]
        size = math.sqrt(sum(x * x for x in raw))
        assert max(abs(a - b / size) for a, b in zip(vec, raw)) < 1e-12


def test_zero_vector_stays(frame):
    df = frame([([0.0, 0.0],), ([3.0, 4.0],)], "v array<double>")
    assert values(df, vx.normalized(F.col("v"))) == [[0.0, 0.0], [0.6, 0.8]]
    assert values(df, vx.norm(F.col("v"))) == [0.0, 5.0]


def test_strip_takes_what_the_pattern_takes(frame):
    texts = ["", " ", "a", " a b\t\n", "\x0b\x0c\ra", "a \u0085", " a  ", "a  ", " a ", "a \r\n", None, "\u0085 a", "á \n "]
    df = frame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select("i", tx.strip_whitespace(F.col("t")).alias("a"), F.regexp_replace("t", r"^\s+|\s+$", "").alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got]
