"""Deterministic picks and number formatting.

A pick depends only on its key, never on partitioning or retries: the first 32
bits of the MD5 of the key's parts joined by colons.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def key(*parts: Column | str | int) -> Column:
    return F.concat_ws(":", *(p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts))


def hashed(*parts: Column | str | int) -> Column:
    """The MD5 of a key: what rows are ordered by for a shuffle or a sample."""
    return F.md5(key(*parts))


def pick(n: Column | int, *parts: Column | str | int) -> Column:
    """A whole number from 0 to n - 1."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.pmod(F.conv(F.substring(hashed(*parts), 1, 8), 16, 10).cast("long"), n.cast("long"))


def pick_between(low: int, high: int, *parts: Column | str | int) -> Column:
    """A whole number from low to high, both included."""
    return pick(high - low + 1, *parts) + low


def chance(share: float, *parts: Column | str | int) -> Column:
    """True for ``share`` of the keys."""
    return pick(1_000_000, *parts) < round(share * 1_000_000)


def hex_id(digits: int, *parts: Column | str | int) -> Column:
    return F.substring(hashed(*parts), 1, digits)


def letters(n: int, *parts: Column | str | int, upper: bool = False) -> Column:
    """A word of ``n`` letters."""
    first = 65 if upper else 97
    return F.concat(*(F.chr(pick(26, *parts, f"letter{i}") + first) for i in range(n)))


def shuffled(items: Column, *parts: Column | str | int) -> Column:
    """An array in an order given by the hashes of key and position."""
    tagged = F.transform(items, lambda x, i: F.struct(hashed(*parts, i).alias("h"), i.alias("i"), x.alias("x")))
    return F.transform(F.array_sort(tagged), lambda s: s["x"])


def rounded_mean(total: Column, n: Column) -> Column:
    """total / n to two places, ties as the nearest double has them (1.005 gives 1.0).

    A pandas UDF, as no built-in rounds the binary value: Spark's round and
    bround go through its shortest decimal form.
    """

    @F.pandas_udf(T.DoubleType())
    def two_places(values):  # noqa: ANN001, ANN202
        return values.map(lambda x: round(x, 2))

    two_places.func.__annotations__.update({"values": "pd.Series", "return": "pd.Series"})
    return two_places(total.cast("double") / n)


def median_text(values: Column) -> Column:
    """The median of an array as text: a whole number if the count is odd, else with .0 or .5."""
    s = F.array_sort(values)
    n = F.size(s)
    odd = F.get(s, F.floor(n / 2).cast("int")).cast("string")
    even = ((F.get(s, (n / 2 - 1).cast("int")) + F.get(s, (n / 2).cast("int"))) / 2).cast("double").cast("string")
    return F.when(n % 2 == 1, odd).otherwise(even)
