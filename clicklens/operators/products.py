"""Product list -> one row per product."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.functions import product_array


def product_rows(hits: DataFrame, keep: Sequence[str] = ("event_id",)) -> DataFrame:
    """One row per non-empty product of ``product_list``.

    Columns: ``keep`` + ``product_index`` (0-based among non-empty products),
    ``category``, ``product_name``, ``quantity``, ``price_text`` (raw 4th
    field) and ``price`` (double, NULL when absent or not a number). The hit
    revenue is the sum of ``price`` over a hit's rows (NULL as 0).
    """
    return hits.select(*keep, F.posexplode(product_array("product_list")).alias("product_index", "p")).select(
        *keep,
        "product_index",
        "p.category",
        "p.product_name",
        "p.quantity",
        "p.price_text",
        "p.price",
    )
