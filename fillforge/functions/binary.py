"""Little-endian integers in BINARY columns, and base58 text."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: the base58 alphabet.
ALPHABET = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
ADDRESS = "^[1-9A-HJ-NP-Za-km-z]{32,44}$"
SIGNATURE = "^[1-9A-HJ-NP-Za-km-z]{64,88}$"

TWO_64 = "18446744073709551616"
#: 10^38 = TEN_38_HIGH * 2^64 + TEN_38_LOW
TEN_38_HIGH, TEN_38_LOW = divmod(10**38, 2**64)


def number(x: int | str) -> Column:
    return F.lit(str(x)).cast("decimal(38,0)")


def reversed_bytes(data: Column) -> Column:
    """Bytes in reverse, by way of a text with a character for each. reverse() itself would turn BINARY into STRING and
    spoil it."""
    return F.encode(F.reverse(F.decode(data, "ISO-8859-1")), "ISO-8859-1")


def hex_le(data: Column, offset: Column | int, size: int) -> Column:
    """The little-endian integer of `size` bytes at a byte offset as 2 * size hex digits; NULL where data is too short."""
    at = F.lit(offset) if isinstance(offset, int) else offset
    part = F.substring(data, at + 1, F.lit(size))
    return F.when(F.octet_length(data) >= at + size, F.hex(part if size == 1 else reversed_bytes(part)))


def from_hex(digits: Column) -> Column:
    """The number of up to 16 hex digits, as DECIMAL(20,0)."""
    return F.conv(digits, 16, 10).cast("decimal(20,0)")


def uint_le(data: Column, offset: Column | int, size: int) -> Column:
    """Unsigned integer of up to 8 bytes at a byte offset, as DECIMAL(20,0); NULL where data is too short."""
    return from_hex(hex_le(data, offset, size))


def byte_at(data: Column, offset: Column | int) -> Column:
    return F.conv(hex_le(data, offset, 1), 16, 10).cast("int")


def u128_le(data: Column, offset: int) -> Column:
    """Unsigned 128-bit integer as DECIMAL(38,0); NULL where it is too short or has 39 digits."""
    low, high = (uint_le(data, offset + d, 8).cast("decimal(38,0)") for d in (0, 8))
    return F.try_add(F.try_multiply(high, number(TWO_64)), low).cast("decimal(38,0)")


def i128_parts(data: Column, offset: Column | int) -> Column:
    """Signed 128-bit integer as struct(negative, high, low): the two 64-bit halves of its absolute value."""
    return i128_of_hex(hex_le(data, offset, 16))


def i128_of_hex(digits: Column) -> Column:
    """i128_parts of the number's 32 hex digits. Its fields are put into every expression that uses them, so digits had
    better be a column of its own. The absolute value of a negative number is its complement and one more."""
    negative = digits >= "8"
    positive = F.when(negative, F.translate(digits, "0123456789ABCDEF", "FEDCBA9876543210")).otherwise(digits)
    more = F.when(negative, 1).otherwise(0)
    carried = negative & digits.endswith("0" * 16)
    high = from_hex(F.left(positive, F.lit(16))) + F.when(carried, 1).otherwise(0)
    low = F.when(carried, 0).otherwise(from_hex(F.right(positive, F.lit(16))) + more)
    return F.struct(negative.alias("negative"), high.cast("decimal(38,0)").alias("high"), low.cast("decimal(38,0)").alias("low"))


def abs_decimal(parts: Column) -> Column:
    """The absolute value as DECIMAL(38,0), NULL beyond its range."""
    return F.try_add(F.try_multiply(parts["high"], number(TWO_64)), parts["low"]).cast("decimal(38,0)")


def abs_text(parts: Column) -> Column:
    """The absolute value as exact text; those of 39 digits begin with 1."""
    rest = F.try_add(F.try_multiply(parts["high"] - number(TEN_38_HIGH), number(TWO_64)), parts["low"] - number(TEN_38_LOW)).cast("decimal(38,0)")
    return F.coalesce(abs_decimal(parts).cast("string"), F.concat(F.lit("1"), F.lpad(rest.cast("string"), 38, "0")))


def le_bytes(value: Column, size: int) -> Column:
    """A BIGINT as `size` little-endian bytes in two's complement."""
    low = F.substring(reversed_bytes(F.unhex(F.lpad(F.hex(value.cast("long")), 16, "0"))), 1, min(size, 8))
    if size <= 8:
        return low
    return F.concat(low, F.when(value < 0, F.lit(b"\xff" * (size - 8))).otherwise(F.lit(bytes(size - 8))))


def decode58(text: str | None) -> bytes | None:
    if text is None:
        return None
    n = 0
    for c in text:
        digit = ALPHABET.find(c)
        if digit < 0:
            return None
        n = n * 58 + digit
    zeros = len(text) - len(text.lstrip("1"))
    return b"\0" * zeros + (n.to_bytes((n.bit_length() + 7) // 8, "big") if n else b"")


def encode58(raw: bytes | None) -> str | None:
    if raw is None:
        return None
    n, out = int.from_bytes(raw, "big"), ""
    while n:
        n, digit = divmod(n, 58)
        out = ALPHABET[digit] + out
    return "1" * (len(raw) - len(raw.lstrip(b"\0"))) + out


DIGITS = np.full(256, 255, np.uint64)
DIGITS[list(ALPHABET.encode())] = np.arange(58)
STEP, LONGEST = 5, 250  # digits taken at a time (58^5 < 2^30), longest text that is decoded beside others


def decode58_all(texts: list[str | None]) -> list[bytes | None]:
    """decode58 of each text: those of like length together, as columns of 32-bit limbs; long ones on their own."""
    out: list[bytes | None] = [None] * len(texts)
    alike: dict[int, list[int]] = {}
    for i, text in enumerate(texts):
        if text is not None and len(text) <= LONGEST:
            alike.setdefault(-(-len(text) // STEP), []).append(i)
        else:
            out[i] = decode58(text)
    for steps, at in alike.items():
        digits = DIGITS[np.frombuffer("".join(texts[i].rjust(steps * STEP, "1") for i in at).encode("ascii", "replace"), np.uint8)].reshape(len(at), steps, STEP)
        good = (digits < 58).all(axis=(1, 2))
        words = (digits * 58 ** np.arange(STEP - 1, -1, -1, dtype=np.uint64)).sum(axis=2, dtype=np.uint64)
        limbs = np.zeros((steps, len(at)), np.uint64)
        for k in range(steps):
            carry = words[:, k]
            for j in range(k + 1):  # k + 1 steps of less than 30 bits fill k + 1 limbs at most
                carry = limbs[j] * np.uint64(58**STEP) + carry
                limbs[j] = carry & np.uint64(0xFFFFFFFF)
                carry = carry >> np.uint64(32)
        raw = limbs[::-1].T.astype(">u4").tobytes()
        for n, i in enumerate(at):
            if good[n]:
                out[i] = b"\0" * (len(texts[i]) - len(texts[i].lstrip("1"))) + raw[4 * steps * n : 4 * steps * (n + 1)].lstrip(b"\0")
    return out


@F.pandas_udf(T.BinaryType())
def base58_bytes(text: pd.Series) -> pd.Series:
    return pd.Series(decode58_all([x if isinstance(x, str) else None for x in text]), dtype=object)


#: Bytes of base58 text; NULL for other characters. The one step without a built-in: filter by program first. Marked as
#: not deterministic so that a filter on its result does not decode a second time.
from_base58 = base58_bytes.asNondeterministic()


LETTERS = np.frombuffer(ALPHABET.encode(), np.uint8)


def encode58_all(raws: list[bytes | None]) -> list[str | None]:
    """encode58 of each value: those of like length together, as columns of 32-bit limbs that are divided by 58^STEP at a
    time; long ones on their own."""
    out: list[str | None] = [None] * len(raws)
    alike: dict[int, list[int]] = {}
    for i, raw in enumerate(raws):
        if raw is not None and len(raw) <= LONGEST:
            alike.setdefault(-(-len(raw) // 4), []).append(i)
        else:
            out[i] = encode58(raw)
    for n, at in alike.items():
        limbs = np.frombuffer(b"".join(raws[i].rjust(4 * n, b"\0") for i in at), ">u4").reshape(len(at), n).T.astype(np.uint64)
        groups = []
        for _ in range(-(-(32 * n) // 29)):  # 58^5 has more than 29 bits
            rest = np.zeros(len(at), np.uint64)
            for j in range(n):
                whole = rest << np.uint64(32) | limbs[j]
                limbs[j], rest = whole // np.uint64(58**STEP), whole % np.uint64(58**STEP)
            groups.append(rest)
        digits = np.stack([g // np.uint64(58**k) % np.uint64(58) for g in reversed(groups) for k in range(STEP - 1, -1, -1)], axis=1) if groups else np.empty((len(at), 0), np.uint64)
        text, size = LETTERS[digits.astype(np.int64)].tobytes().decode(), digits.shape[1]
        for k, i in enumerate(at):
            zeros = len(raws[i]) - len(raws[i].lstrip(b"\0"))
            out[i] = "1" * zeros + text[k * size : (k + 1) * size].lstrip("1")
    return out


@F.pandas_udf(T.StringType())
def to_base58(raw: pd.Series) -> pd.Series:
    return pd.Series(encode58_all([None if x is None else bytes(x) for x in raw]), dtype=object)
