"""Column expressions shared by the operators.  All stay inside Catalyst."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text patterns of message times.
MESSAGE_TIME = "yyyy-MM-dd HH:mm:ss"
ISO_TIME = "yyyy-MM-dd'T'HH:mm:ss"
ISO_TIME_FRACTION = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def parse_time(text: Column | str, *patterns: str, ntz: bool = False) -> Column:
    """Timestamp from text; NULL when no pattern fits.

    The patterns are tried in order (default: the message pattern).  ``ntz``
    gives a time without zone.
    """
    text = F.col(text) if isinstance(text, str) else text
    parsed = [F.try_to_timestamp(text, F.lit(p)) for p in patterns or (MESSAGE_TIME,)]
    time = F.coalesce(*parsed) if len(parsed) > 1 else parsed[0]
    return time.cast("timestamp_ntz") if ntz else time


def iso_text(time: Column | str) -> Column:
    """ISO time text, 19 characters."""
    return F.date_format(time, ISO_TIME)


def strip_blank(text: Column | str) -> Column:
    """Text without Unicode whitespace at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def is_blank(text: Column | str) -> Column:
    """True for NULL, empty and whitespace-only text."""
    return F.coalesce(F.length(strip_blank(text)) == 0, F.lit(True))


def hash_bucket(*keys: Column | str, seed: int | str = 42, buckets: int = 100) -> Column:
    """Bucket 0..buckets-1 of a row key.

    It depends on the key and seed only, never on partitioning, so a retried
    task gives the same answer.  NULL parts count as empty text.
    """
    return (hash_digest(*keys, seed=seed) % buckets).cast("int")


#: Number of values of hash_digest.
DIGESTS = 2**32


def hash_digest(*keys: Column | str, seed: int | str = 42) -> Column:
    """32 bits of a row key's digest: ``< share * DIGESTS`` picks any share of rows, however small.

    As hash_bucket, but not folded into buckets.
    """
    parts = [F.coalesce((F.col(k) if isinstance(k, str) else k).cast("string"), F.lit("")) for k in keys]
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *parts)), 1, 8), 16, 10).cast("bigint")


def ratio(top: Column, bottom: Column, default: float | None = 0.0) -> Column:
    """top / bottom, or ``default`` when bottom is 0 (or either is NULL)."""
    quotient = F.try_divide(top.cast("double"), bottom.cast("double"))
    return quotient if default is None else F.coalesce(quotient, F.lit(float(default)))


def fixed_text(number: Column | str, digits: int) -> Column:
    """Number as text with so many decimals, rounded by its exact binary value.

    Ties go away from zero.  ``round`` works on the printed decimal instead
    and would turn 0.15, which is stored slightly below, into 0.2.
    For sizes below 10^12.
    """
    x = F.col(number) if isinstance(number, str) else number
    size, scale = F.abs(x), 10**digits
    product = size * float(scale)
    # what the product lost: split the factor into two halves of 26 bits
    wide = size * 134217729.0
    high = wide - (wide - size)
    lost = (high * float(scale) - product) + (size - high) * float(scale)
    whole = F.floor(product)
    rest = product - whole
    up = (rest > 0.5) | ((rest == 0.5) & (lost >= 0))
    n = whole + up.cast("bigint")
    tail = F.lpad((n % scale).cast("string"), digits, "0")
    return F.concat(F.when(x < 0, "-").otherwise(""), F.floor(n / scale).cast("string"), F.lit("."), tail)
