"""Price text as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from listweave.functions.text import _col

# Words that mark a listing as free of charge.
FREE_WORDS = ("ingyenes", "free", "díjtalan", "dijtalan")


def parse_price(value: Column | str) -> Column:
    """STRUCT<price_min BIGINT, price_max BIGINT, is_free BOOLEAN>: a free word,
    or the smallest and largest amount; a single amount has no maximum."""
    c = F.coalesce(_col(value), F.lit(""))
    # blanks and dots inside an amount go first, then digit groups stand alone
    joined = F.regexp_replace(c, r"(?U)(?<=\d)[\s.]+(?=\d)", "")
    runs = F.transform(F.split(joined, r"(?U)\D+"), lambda run: F.nullif(run, F.lit("")).try_cast("bigint"))
    amounts = F.filter(runs, lambda n: n.isNotNull())
    free = F.lower(c).rlike("|".join(FREE_WORDS))
    many = F.size(amounts) > 1
    return F.struct(
        F.when(free, F.lit(0).cast("bigint")).otherwise(F.array_min(amounts)).alias("price_min"),
        F.when(~free & many, F.array_max(amounts)).alias("price_max"),
        free.alias("is_free"),
    )


def price_from_parts(amount: Column | str, currency: Column | str) -> Column:
    """Amount and currency text; no amount means unpublished, not free."""
    a = _col(amount)
    return F.when(
        a.isNotNull() & (a != ""),
        F.concat(a, F.lit(" "), F.coalesce(F.nullif(_col(currency), F.lit("")), F.lit("HUF"))),
    )
