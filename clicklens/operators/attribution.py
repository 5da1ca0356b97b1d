"""Per-hit attribution: derived columns and the qualifying filters.

Every function is ``DataFrame -> DataFrame`` over a frame holding the contract
columns (extra columns pass through).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.constants import (
    DOMAIN,
    IS_EXTERNAL_SEARCH,
    IS_PURCHASE,
    KEYWORD,
    KEYWORD_PARAMS,
    PURCHASE_EVENT,
    REVENUE,
    SEARCH_ENGINE_HOSTS,
    UNKNOWN_DOMAIN,
)
from clicklens.functions import (
    clean_url,
    has_event,
    hit_revenue,
    is_search_domain,
    is_search_referrer,
    query_string,
    search_keyword,
    url_domain,
)
from clicklens.functions.url import domain_of_netloc, keyword_of, netloc


def with_domain(df: DataFrame) -> DataFrame:
    """Add ``search_engine_domain`` (NULL when the referrer has no host)."""
    return df.withColumn(DOMAIN, url_domain("referrer"))


def with_attribution(
    df: DataFrame,
    hosts: Sequence[str] = SEARCH_ENGINE_HOSTS,
    params: Sequence[str] = KEYWORD_PARAMS,
    purchase_event: str = PURCHASE_EVENT,
) -> DataFrame:
    """Add domain, keyword, external-search flag, purchase flag and hit revenue."""
    d = with_domain(df)
    return d.select(
        "*",
        search_keyword("referrer", params).alias(KEYWORD),
        is_search_domain(DOMAIN, hosts).alias(IS_EXTERNAL_SEARCH),
        has_event("event_list", purchase_event).alias(IS_PURCHASE),
        hit_revenue("product_list").alias(REVENUE),
    )


#: Host tables of up to this many rows are sent to every task.
FEW_HOSTS = 200_000

Hosts = Sequence[str] | DataFrame


def from_hosts(df: DataFrame, hosts: DataFrame) -> DataFrame:
    """Hits whose referrer's domain is in a table of hosts (its first column), the match
    being that of ``is_search_domain``: a listed host also stands for itself without
    one leading ``www.``.

    Nulls, empty and repeated hosts change nothing. The table is counted: up to
    ``FEW_HOSTS`` rows it goes to every task; beyond, both sides are dealt by
    domain, a hot domain's hits being split by adaptive execution.
    """
    host = F.lower(hosts[hosts.columns[0]].cast("string"))
    listed = hosts.select(host.alias("_host")).where(F.col("_host") != "")
    bare = F.when(F.col("_host").startswith("www.") & (F.length("_host") > 4), F.substring("_host", F.lit(5), F.length("_host") - 4))
    accepted = listed.select(F.explode(F.array_compact(F.array("_host", bare))).alias("_host")).distinct()
    few = accepted.limit(FEW_HOSTS + 1).count() <= FEW_HOSTS
    # Hits without a host are dropped ahead of the join.
    keyed = df.withColumn("_host", url_domain("referrer")).where(F.col("_host").isNotNull())
    return keyed.join(F.broadcast(accepted) if few else accepted, "_host", "left_semi").select(*df.columns)


def external_search_hits(df: DataFrame, hosts: Hosts = SEARCH_ENGINE_HOSTS) -> DataFrame:
    """Hits whose referrer host is a search engine, with ``search_engine_domain``.

    ``hosts`` is a list, or a table whose first column names them.
    """
    if isinstance(hosts, DataFrame):
        return with_domain(from_hosts(df, hosts))
    return with_domain(df.where(is_search_referrer("referrer", hosts)))


def purchase_hits(df: DataFrame, purchase_event: str = PURCHASE_EVENT) -> DataFrame:
    """Hits whose event list holds the purchase event."""
    return df.where(has_event("event_list", purchase_event))


def candidate_flag(
    hosts: Sequence[str] = SEARCH_ENGINE_HOSTS, purchase_event: str = PURCHASE_EVENT
):
    """The per-hit test: a purchase (checked first: the rarer condition) from a search host."""
    return has_event("event_list", purchase_event) & is_search_referrer("referrer", hosts)


def attribute(df: DataFrame, params: Sequence[str] = KEYWORD_PARAMS, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` + domain, keyword, revenue for hits already known to be candidates.

    The cleaned URL, its location and its query are columns of their own, one
    select each, so that none is worked out again for every use.
    """
    df = df.select(*keep, "product_list", clean_url("referrer").alias("_url"))
    df = df.select(*keep, "product_list", "_url", netloc(F.col("_url")).alias("_loc"))
    df = df.select(*keep, "product_list", "_loc", query_string(F.col("_url"), F.col("_loc")).alias("_query"))
    return df.select(
        *keep,
        F.coalesce(domain_of_netloc(F.col("_loc")), F.lit(UNKNOWN_DOMAIN)).alias(DOMAIN),
        keyword_of(F.col("_query"), params).alias(KEYWORD),
        hit_revenue("product_list").alias(REVENUE),
    )


def search_purchases(
    df: DataFrame,
    hosts: Hosts = SEARCH_ENGINE_HOSTS,
    params: Sequence[str] = KEYWORD_PARAMS,
    purchase_event: str = PURCHASE_EVENT,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Purchases from external search, attributed; revenue not yet checked.

    Output: ``keep`` columns + domain, keyword, revenue (double). The cheap
    tests run on every hit next to the scan, inside whole-stage codegen, in
    this order: the purchase test (a substring check, then a short regex)
    first, because purchases are the rarer condition, then the host test (one
    regex and a set lookup) only on purchases. Keyword and revenue are
    computed once, only for hits that pass both. A table of hosts is joined to
    the purchases alone.
    """
    if isinstance(hosts, DataFrame):
        return attribute(from_hosts(purchase_hits(df, purchase_event), hosts), params, keep)
    return attribute(df.where(candidate_flag(hosts, purchase_event)), params, keep)


def qualified_hits(
    df: DataFrame,
    hosts: Hosts = SEARCH_ENGINE_HOSTS,
    params: Sequence[str] = KEYWORD_PARAMS,
    purchase_event: str = PURCHASE_EVENT,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Purchases from external search with positive revenue: keep + domain, keyword, revenue."""
    return search_purchases(df, hosts, params, purchase_event, keep).where(F.col(REVENUE) > 0)
