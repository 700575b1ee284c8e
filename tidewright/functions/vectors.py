"""Vector columns (arrays of numbers), computed in double precision inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip_whitespace


def let(value: Column, body) -> Column:
    """Bind a value for use in a lambda: inside a lambda an outer expression is evaluated per element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def as_double(vec: Column) -> Column:
    return vec.cast("array<double>")


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(as_double(a), as_double(b), lambda x, y: x * y))


def norm(vec: Column) -> Column:
    return F.sqrt(total(F.transform(as_double(vec), lambda x: x * x)))


def normalized(vec: Column) -> Column:
    """Unit vector; a zero vector stays as it is."""
    def scale(v: Column) -> Column:
        return let(norm(v), lambda n: F.transform(v, lambda x: x / F.when(n == 0, 1.0).otherwise(n)))

    return let(as_double(vec), scale)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def l2_distance(a: Column, b: Column) -> Column:
    return F.sqrt(total(F.zip_with(as_double(a), as_double(b), lambda x, y: (x - y) * (x - y))))


def _digests(clean_text: Column, dim: int) -> Column:
    return reduce(F.concat, [F.sha2(F.concat(clean_text, F.lit(f"::{i}")), 256) for i in range(-(-dim // 32))])


def hash_bytes(clean_text: Column, dim: int = 64) -> Column:
    """The numbers of ``hash_embedding`` before they are scaled, a byte each: an eighth of the vector's room. ``knn_blocks.columns`` makes the same vectors of them.

    The text is lower-case and stripped, and best a column: it is read once per digest.
    """
    return F.unhex(F.substring(_digests(clean_text, dim), 1, 2 * dim))


def hash_embedding(text: Column, dim: int = 64) -> Column:
    """Deterministic unit vector from SHA-256 bytes of the cleaned text, 32 numbers per digest."""
    places = F.sequence(F.lit(0), F.lit(dim - 1))

    def numbers(hexed: Column) -> Column:
        return F.transform(
            places, lambda i: F.conv(F.substring(hexed, i * 2 + 1, F.lit(2)), 16, 10).cast("double") / F.lit(255.0) * 2 - 1
        )

    return let(strip_whitespace(F.lower(text)), lambda c: normalized(let(_digests(c, dim), numbers)))


def mean_columns(vec: str, dim: int) -> Column:
    """Mean vector as an aggregate: one partial sum per position, no rows per position."""
    return F.array(*[F.avg(F.get(F.col(vec), F.lit(i)).cast("double")) for i in range(dim)])


def sign_projection(vec: Column, dims: int) -> Column:
    """Projection to ``dims`` numbers: sums of all numbers with signs from a fixed rule (a row of a sign matrix per number), so distances roughly stay.

    The sign of number i (from 0) in sum j is that of the parity of the bits that i + 1 and 37 * j + 11 share.
    """
    def part(v: Column, j: int) -> Column:
        signed = F.transform(v, lambda x, i: F.when(F.bit_count((i + 1).bitwiseAND(37 * j + 11)) % 2 == 0, x).otherwise(-x))
        return total(signed)

    return let(as_double(vec), lambda v: F.array(*[part(v, j) for j in range(dims)]))
