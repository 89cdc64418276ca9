"""Cleaning of registry text and numbers, and prices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE_LIMIT = 10**12
SPACES = "[\\s\\u00A0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000\\uFEFF]"


def sane_price_e6(price: Column) -> Column:
    """The price if 0 < price < 10^12, else NULL."""
    return F.when((price > 0) & (price < PRICE_LIMIT), price)


def price_from_e6(price: Column) -> Column:
    return (price.cast("decimal(38,0)") / F.lit(1_000_000)).cast("decimal(38,6)")


def max_leverage(bps: Column) -> Column:
    """floor(10000 / bps); 10 where bps is missing or not positive, or the result is not positive."""
    found = F.when(bps > 0, F.floor(F.lit(10_000) / bps))
    return F.when(found > 0, found).otherwise(10).cast("int")


def clean_decimals(decimals: Column) -> Column:
    """decimals if within 0..18, else 6."""
    return F.when(decimals.between(0, 18), decimals).otherwise(6).cast("int")


def sanitize_text(text: Column, limit: int) -> Column:
    """Without control characters, DEL, < and >, trimmed of Unicode space, cut to limit code points; NULL if empty."""
    plain = F.regexp_replace(text, "[\\u0000-\\u001F\\u007F<>]", "")
    trimmed = F.regexp_replace(plain, f"^{SPACES}+|{SPACES}+$", "")
    return F.nullif(F.substring(trimmed, 1, limit), F.lit(""))


def sanitize_url(url: Column) -> Column:
    """The url if it has 1..512 characters, parses, and is http or https; else NULL."""
    scheme = F.lower(F.try_parse_url(url, F.lit("PROTOCOL")))
    return F.when(F.length(url).between(1, 512) & scheme.isin("http", "https"), url)


def pick_asset_logo(content: Column) -> Column:
    """links.image, else the first file that is an image or of unknown kind; cdn_uri before uri. Only valid addresses."""
    image = F.filter(content["files"], lambda f: F.coalesce(f["mime"], F.lit("")).rlike("^(image/.*)?$"))
    found = F.transform(image, lambda f: F.coalesce(sanitize_url(f["cdn_uri"]), sanitize_url(f["uri"])))
    return F.coalesce(sanitize_url(content["links"]["image"]), F.get(F.filter(found, lambda x: x.isNotNull()), F.lit(0)))


def placeholder_symbol() -> Column:
    return F.lit("UNKNOWN")


def placeholder_name(slab: Column) -> Column:
    return F.concat(F.lit("Market "), F.left(slab, F.lit(8)))


def resolve_network(text: Column) -> Column:
    """mainnet or testnet, in any case and with blanks around; anything else is devnet."""
    plain = F.lower(F.trim(text))
    return F.when(plain.isin("mainnet", "testnet"), plain).otherwise("devnet")
