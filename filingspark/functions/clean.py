"""String, identifier and number clean-up as column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ARCHIVE_URL = "https://www.sec.gov/Archives/edgar/data"


def strip_specials(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Delete comma, backslash and slash from the named (default: all) string columns."""
    strings = [n for n, t in df.dtypes if t == "string"]
    chosen = strings if columns is None else list(columns)
    return df.withColumns({c: F.translate(c, ",\\/", "") for c in chosen})


def pad_cik(cik: Column) -> Column:
    """Left-pad to ten characters; longer values stay as they are."""
    text = cik.cast("string")
    return F.when(F.length(text) >= 10, text).otherwise(F.lpad(text, 10, "0"))


def unpad_cik(cik: Column) -> Column:
    return F.ltrim(cik, F.lit("0"))


def filing_link(cik: Column, accession: Column, document: Column) -> Column:
    return F.concat_ws(
        "/", F.lit(ARCHIVE_URL), unpad_cik(cik), F.replace(accession, F.lit("-"), F.lit("")), document
    )


def safe_long(text: Column) -> Column:
    """Number text to bigint: fraction dropped, out of range or not a number becomes 0."""
    return F.coalesce(text.try_cast("decimal(38,6)").try_cast("bigint"), F.lit(0).cast("bigint"))


def letters_only(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\p{L}]", "")


def _one_decimal(n: Column, unit: int) -> Column:
    """``n / unit`` with one decimal, rounded from the exact binary value of the quotient.

    Only a quotient halfway between two decimals depends on its binary value:
    its fraction is compared with the nearest double of each halfway point, and
    when they are the same double, that double's own error decides.
    """
    quotient = n / F.lit(float(unit))
    tenth = unit // 10
    down = F.floor(n / tenth)
    fraction = quotient - F.floor(quotient)
    up = F.lit(False)
    for digit in range(10):
        halfway = float(f"0.{digit}5")
        error = Decimal(halfway) - Decimal(f"0.{digit}5")
        at = error > 0 or (error == 0 and digit % 2 == 1)
        above = (fraction > halfway) | ((fraction == halfway) & F.lit(at))
        up = F.when(down % 10 == digit, above).otherwise(up)
    halved = n % tenth == tenth // 2
    tenths = down + F.when(halved, up.cast("int")).otherwise((n % tenth > tenth // 2).cast("int"))
    return F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"))


def humanise(n: Column) -> Column:
    """A count as text: above a million ``1.5M``, above a thousand ``1.5K``, else as it is."""
    return (
        F.when(n > 1_000_000, F.concat(_one_decimal(n, 1_000_000), F.lit("M")))
        .when(n > 1_000, F.concat(_one_decimal(n, 1_000), F.lit("K")))
        .otherwise(n.cast("string"))
    )


def plain_spaces(text: Column) -> Column:
    """No-break and zero-width spaces to ordinary spaces."""
    return F.translate(text, "\u00a0\u200b", "  ")
