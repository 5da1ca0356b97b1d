"""Revenue aggregation and the ordered report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklens.constants import (
    DECIMAL_BELOW,
    DOMAIN,
    KEYWORD,
    KEYWORD_PARAMS,
    PURCHASE_EVENT,
    REPORT_DOMAIN,
    REPORT_KEYWORD,
    REPORT_REVENUE,
    REVENUE,
    REVENUE_SUM_TYPE,
    SEARCH_ENGINE_HOSTS,
)
from clicklens.operators.attribution import Hosts, search_purchases


def exact_sum(c: Column | str) -> Column:
    """Sum of doubles that loses nothing and, for ordinary prices, doesn't depend on row order.

    A double sum depends on the order rows arrive in, which differs between
    runs and partitionings. So three sums are added: the decimal parts (six
    places, summed exactly), what rounding to six places left over, and the
    values too large for the decimal part, each as they are. A value within a
    few units in its last place of a decimal with six places is that decimal,
    so ordinary prices leave nothing over and their sum is the same bit
    pattern on any partitioning. NULL when every value is NULL.
    """
    c = F.col(c) if isinstance(c, str) else c
    small = F.abs(c) < F.lit(DECIMAL_BELOW)
    part = F.when(small, c).cast(REVENUE_SUM_TYPE)
    over = c - part.cast("double")
    rest = F.when(~small, c).when(F.abs(over) > F.abs(c) * F.lit(2.0**-49), over).when(small, F.lit(0.0))
    return F.coalesce(F.sum(part).cast("double"), F.when(F.sum(rest).isNotNull(), F.lit(0.0))) + F.sum(rest)


def revenue_by(df: DataFrame, keys: Sequence[str], value: str = REVENUE, name: str = REVENUE) -> DataFrame:
    """Sum ``value`` by ``keys`` (partial sums before the shuffle)."""
    return df.groupBy(*keys).agg(exact_sum(value).alias(name))


def keyword_revenue(
    hits: DataFrame,
    hosts: Hosts = SEARCH_ENGINE_HOSTS,
    params: Sequence[str] = KEYWORD_PARAMS,
    purchase_event: str = PURCHASE_EVENT,
    extra_keys: Sequence[str] = (),
) -> DataFrame:
    """Hits -> (domain, keyword, revenue), one row per pair, unordered.

    One hash shuffle on (domain, keyword) after map-side partial sums, so a
    hot pair costs one row per task in the shuffle, never one task's worth of
    hits. The positive-revenue rule is applied inside the sum (only positive
    hits are added; a pair without any is dropped), which equals filtering
    hits first but computes each hit's revenue once and keeps the scan-side
    filter free of array lambdas.
    """
    cand = search_purchases(hits, hosts, params, purchase_event, keep=extra_keys)
    return sum_positive(cand, extra_keys)


def sum_positive(attributed: DataFrame, extra_keys: Sequence[str] = ()) -> DataFrame:
    """Attributed hits -> revenue by ([extra keys,] domain, keyword), counting only
    hits with positive revenue; pairs without one are dropped."""
    rev = F.col(REVENUE)
    agg = attributed.groupBy(*extra_keys, DOMAIN, KEYWORD).agg(exact_sum(F.when(rev > 0, rev)).alias(REVENUE))
    return agg.where(F.col(REVENUE).isNotNull())


def report_order() -> list[Column]:
    """Revenue descending, then domain and keyword (a total order on the report)."""
    return [
        F.col(f"`{REPORT_REVENUE}`").desc(),
        F.col(f"`{REPORT_DOMAIN}`"),
        F.col(f"`{REPORT_KEYWORD}`"),
    ]


def labelled(agg: DataFrame) -> DataFrame:
    """Rename to the report labels, in report column order."""
    return agg.select(
        F.col(DOMAIN).alias(REPORT_DOMAIN),
        F.col(KEYWORD).alias(REPORT_KEYWORD),
        F.col(REVENUE).alias(REPORT_REVENUE),
    )


def keyword_report(
    hits: DataFrame,
    hosts: Hosts = SEARCH_ENGINE_HOSTS,
    params: Sequence[str] = KEYWORD_PARAMS,
    purchase_event: str = PURCHASE_EVENT,
) -> DataFrame:
    """The report: labelled columns, revenue descending (ties: domain, keyword)."""
    return labelled(keyword_revenue(hits, hosts, params, purchase_event)).orderBy(*report_order())
