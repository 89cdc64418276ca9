"""Exact whole numbers of any length: as limbs of nine decimal digits, the lowest first, and as text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = 9
BASE = 10**DIGITS


def decimal(x: Column | int) -> Column:
    return (F.lit(x) if isinstance(x, int) else x).cast("decimal(38,0)")


def limbs(text: Column, n: int) -> list[Column]:
    """The number in a text of digits, with a minus or without, as n limbs (long) that all carry its sign. They are NULL
    where the text is no such number or has more digits than n limbs."""
    good = text.rlike(rf"^-?0*[0-9]{{1,{n * DIGITS}}}$")
    digits = F.lpad(F.regexp_replace(text, "^-?0*", ""), n * DIGITS, "0")
    sign = F.when(F.startswith(text, F.lit("-")), -1).otherwise(1)
    return [F.when(good, sign * F.substring(digits, (n - 1 - i) * DIGITS + 1, DIGITS).cast("long")) for i in range(n)]


def product(a: list[Column], b: list[Column]) -> list[Column]:
    """The limbs of a product, not carried. A long holds them if one factor has nine limbs or fewer."""
    if min(len(a), len(b)) > 9:
        raise ValueError("one factor must have nine limbs or fewer")
    terms: list[list[Column]] = [[] for _ in range(len(a) + len(b) - 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            terms[i + j].append(x * y)
    return [reduce(lambda x, y: x + y, t) for t in terms]


def total(parts: list[Column]) -> Column:
    """The aggregate that adds up numbers: an array of limbs, not carried. Rows that are NULL are left out; the sums of some
    10^13 products of nine limbs fit."""
    return F.array(*[F.coalesce(F.sum(decimal(p)), decimal(0)) for p in parts])


def text(sums: Column) -> Column:
    """The exact text of a total, with a minus if it is below zero."""
    wide = lambda xs: F.concat(xs, F.array(*[decimal(0)] * 3))

    def step(acc: Column, x: Column) -> Column:
        whole = decimal(x + acc["carry"])
        rest = decimal(F.pmod(whole, decimal(BASE)))
        carry = decimal(F.floor(decimal(whole - rest) / decimal(BASE)))
        return F.struct(carry.alias("carry"), F.concat(F.lpad(rest.cast("string"), DIGITS, "0"), acc["digits"]).alias("digits"))

    folded = lambda xs: F.aggregate(wide(xs), F.struct(decimal(0).alias("carry"), F.lit("").alias("digits")), step)
    plain = lambda digits: F.coalesce(F.nullif(F.ltrim(digits, F.lit("0")), F.lit("")), F.lit("0"))
    up = folded(sums)
    negated = folded(F.transform(sums, lambda x: decimal(-x)))
    return F.when(up["carry"] < 0, F.concat(F.lit("-"), plain(negated["digits"]))).otherwise(plain(up["digits"]))


def pointed(number: Column, places: Column) -> Column:
    """A whole number in text divided by 10^places, exactly, without zeros at the end."""
    sign = F.when(F.startswith(number, F.lit("-")), "-").otherwise("")
    digits = F.ltrim(number, F.lit("-"))
    padded = F.concat(F.repeat(F.lit("0"), F.greatest(F.lit(0), places + 1 - F.length(digits))), digits)
    rest = F.rtrim(F.right(padded, places), F.lit("0"))
    return F.concat(sign, F.left(padded, F.length(padded) - places), F.when(rest != "", F.concat(F.lit("."), rest)).otherwise(""))
