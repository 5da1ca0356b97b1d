"""Hit-level rules over event and product lists, as Spark column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from clicklens.constants import PURCHASE_EVENT
from clicklens.functions.text import _col, strip_ws, ws_regex_class

# A finite decimal number as Python's float() reads it (underscores allowed
# between digits). nan and inf are not accepted: such a price adds 0.
_DIGITS = r"[0-9](?:_?[0-9])*"
NUMBER_PATTERN = rf"^[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$"


def event_pattern(code: str = PURCHASE_EVENT) -> str:
    """Regex matching an event list holding ``code`` as a whole, trimmed token."""
    ws = ws_regex_class()
    return rf"(?:^|,){ws}*{re.escape(code)}{ws}*(?:,|\z)"


def has_event(event_list: Column | str, code: str = PURCHASE_EVENT) -> Column:
    """True when the comma-separated list holds ``code`` as a trimmed token; never NULL.

    One regex instead of split/transform: stays inside whole-stage codegen,
    which matters because this predicate runs on every hit.
    """
    c = _col(event_list)
    # The substring test first: most hits fail it without running the regex.
    return F.coalesce(c.contains(code) & c.rlike(event_pattern(code)), F.lit(False))


def parse_price(text: Column) -> Column:
    """Trimmed price text -> double; NULL when absent or not a finite decimal."""
    t = strip_ws(text)
    value = F.regexp_replace(t, "_", "").try_cast("double")
    # Only an exponent or very many digits can leave the range of a double.
    ordinary = ~t.rlike("[eE]") & (F.length(t) < 300)
    finite = F.when(F.abs(value) < F.lit(float("inf")), value)
    return F.when(t.rlike(NUMBER_PATTERN), F.when(ordinary, value).otherwise(finite))


# The 4th ';'-field of each ','-separated product that has at least four
# fields, left to right (a match cannot cross a ',').
_FOURTH_FIELD = r"(?:^|,)[^;,]*;[^;,]*;[^;,]*;([^;,]*)"


def _price_field(product: Column) -> Column:
    return F.get(F.split(product, ";"), 3)


def hit_revenue(product_list: Column | str) -> Column:
    """Sum of the 4th ';'-field of each ','-separated product; 0.0 when none.

    Prices are added left to right as doubles, so the per-hit value is the
    same bit pattern as a sequential float sum. The price is a line total:
    the quantity field is not a factor.
    """
    fields = F.regexp_extract_all(_col(product_list), F.lit(_FOURTH_FIELD), F.lit(1))
    total = F.aggregate(fields, F.lit(0.0), lambda acc, x: acc + F.coalesce(parse_price(x), F.lit(0.0)))
    return F.coalesce(total, F.lit(0.0))


def product_array(product_list: Column | str) -> Column:
    """array<struct> of the non-empty products: category, name, quantity, price text, price."""
    products = F.filter(F.transform(F.split(_col(product_list), ","), strip_ws), lambda p: p != F.lit(""))
    return F.transform(
        products,
        lambda p: F.struct(
            F.get(F.split(p, ";"), 0).alias("category"),
            F.get(F.split(p, ";"), 1).alias("product_name"),
            F.get(F.split(p, ";"), 2).alias("quantity"),
            _price_field(p).alias("price_text"),
            parse_price(_price_field(p)).alias("price"),
        ),
    )
