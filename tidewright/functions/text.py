"""Text and timestamp columns."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted timestamp layouts, date-time before date-only. One-letter
# fields accept one or two digits, which the two-letter ones do not.
TIMESTAMP_LAYOUTS = (
    "d/M/yyyy H:m:s",
    "yyyy-M-d H:m:s",
    "yyyy-M-d'T'H:m:s",
    "yyyy/M/d H:m",
    "d/M/yyyy",
    "yyyy-M-d",
    "yyyy/M/d",
)


def clean(col: Column) -> Column:
    """Trimmed lower-case text."""
    return F.lower(F.trim(col))


def clean_or_null(col: Column) -> Column:
    """Trimmed lower-case text, empty becomes null."""
    return F.nullif(clean(col), F.lit(""))


def layout_shape(layout: str) -> str:
    """Pattern every text of a layout has: four digits for a year, one or two for other fields."""
    pieces = re.findall(r"y+|[dMHms]|'[^']*'|.", layout)
    digits = {"yyyy": r"\d{4}"} | dict.fromkeys("dMHms", r"\d{1,2}")
    return "^" + "".join(digits.get(p, re.escape(p.strip("'"))) for p in pieces) + "$"


def parse_mixed_timestamp(col: Column, layouts: Sequence[str] = TIMESTAMP_LAYOUTS) -> Column:
    """First layout that parses the whole text, else null.

    A failing parse costs an exception per row, so a layout is only tried on
    texts of its shape.
    """
    text = F.ltrim(col)
    tries = [F.when(text.rlike(layout_shape(layout)), F.try_to_timestamp(text, F.lit(layout))) for layout in layouts]
    return F.coalesce(*tries)


def strip_whitespace(col: Column) -> Column:
    """Remove all white space at both ends (``trim`` removes blanks only).

    A pattern is tried at every place of a text, so only texts that end in one of the line ends that are no white space to it, but an end, need one.
    """
    plain = F.btrim(col, F.lit(" \t\n\x0b\f\r"))
    return F.when(col.endswith("\u0085") | col.endswith("\u2028") | col.endswith("\u2029"), F.regexp_replace(col, r"^\s+|\s+$", "")).otherwise(plain)


def first_keyword(text: Column, rules: Sequence[tuple[str, str]], default: str, lowered: bool = False) -> Column:
    """Value of the first rule whose keyword occurs anywhere in the text, ignoring case.

    Several chains over one text should share one lower-cased column and pass
    ``lowered=True``: inside a ``CASE`` each branch would lower it again.
    """
    low = text if lowered else F.lower(text)
    chain = None
    for keyword, value in rules:
        hit = low.contains(keyword.lower())
        chain = F.when(hit, value) if chain is None else chain.when(hit, value)
    return F.lit(default) if chain is None else chain.otherwise(default)


def lookup(col: Column, table: Mapping[str, float], default) -> Column:
    """Small constant map as a ``CASE``, default for anything else (null too)."""
    chain = None
    for key, value in table.items():
        chain = F.when(col == key, F.lit(value)) if chain is None else chain.when(col == key, F.lit(value))
    return chain.otherwise(F.lit(default))


def truncate_with_dots(col: Column, limit: int = 200) -> Column:
    """First ``limit`` characters, stripped, with ``...`` when something was cut."""
    cut = strip_whitespace(F.substring(col, 1, limit))
    return F.concat(cut, F.when(F.length(col) > limit, "...").otherwise(""))


def preview(col: Column, limit: int = 220) -> Column:
    """First ``limit`` characters on one line."""
    return F.substring(F.replace(col, F.lit("\n"), F.lit(" ")), 1, limit)


def words(col: Column) -> Column:
    """Non-empty tokens between white space."""
    return F.filter(F.split(col, r"\s+"), lambda w: w != "")


def token_estimate(col: Column) -> Column:
    """Two tokens per word."""
    return F.size(words(col)) * 2


def fill_template(template: str, fields: Mapping[str, Column]) -> Column:
    """Put columns into the ``{name}`` slots of a constant template.

    The template is cut at its slots when the plan is built, so text inside a
    column that looks like a slot stays as it is.
    """
    parts: list[Column] = []
    rest = template
    while rest:
        starts = {name: rest.find("{" + name + "}") for name in fields}
        starts = {name: at for name, at in starts.items() if at >= 0}
        if not starts:
            parts.append(F.lit(rest))
            break
        name = min(starts, key=starts.get)
        if starts[name]:
            parts.append(F.lit(rest[: starts[name]]))
        parts.append(F.coalesce(fields[name].cast("string"), F.lit("")))
        rest = rest[starts[name] + len(name) + 2:]
    return F.concat(*parts) if parts else F.lit("")


def json_map_or_empty(col: Column) -> Column:
    """JSON object as a map, anything malformed (or null) as an empty map."""
    empty = F.create_map().cast("map<string,string>")
    parsed = F.from_json(col, "map<string,string>", {"mode": "PERMISSIVE"})
    return F.coalesce(parsed, empty)


def cap_items(col: Column, items: int = 5, chars: int = 200) -> Column:
    """At most ``items`` elements of at most ``chars`` characters."""
    return F.transform(F.slice(col, 1, items), lambda x: F.substring(x, 1, chars))


def format_day(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd")


def shift_minutes(ts: Column, minutes: Column) -> Column:
    """Timestamp moved by a (negative or positive) number of minutes."""
    return ts + F.make_interval(mins=minutes.cast("int"))


# The parts of the sentence that stands for a card transaction, each before its column.
NARRATIVE = (
    ("transação ", "canal"), (" no merchant ", "merchant"), ("; descrição ", "descricao"), ("; perfil ", "perfil_simulado"), ("; valor R$ ", "valor"),
    ("; hora ", "hora"), (":15; país ", "pais"), ("; cidade ", "cidade"), ("; cartão_presente ", "cartao_presente"), ("; risco_device ", "risco_device"),
)


def narrative(lowered: bool = False) -> Column:
    """Card transaction as a sentence; the value keeps its shortest decimal form.

    ``lowered`` gives it in lower case, column by column: most columns are plain ASCII, which is a quarter of the work. No letter's form depends on
    another column, as the words between them start with a mark or a blank and end in a blank.
    """
    shown = {"valor": F.round("valor", 2).cast("string"), "hora": F.lpad(F.col("hora").cast("string"), 2, "0")}
    told = [(words, shown.get(column, F.col(column))) for words, column in NARRATIVE]
    return F.concat(*[x for words, part in told for x in ((F.lit(words.lower()), F.lower(part)) if lowered else (F.lit(words), part))])
