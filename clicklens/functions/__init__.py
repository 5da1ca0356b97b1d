"""Column-level building blocks (``Column -> Column``), all native Spark expressions."""

from clicklens.functions.hits import has_event, hit_revenue, parse_price, product_array
from clicklens.functions.text import has_text, strip_ws
from clicklens.functions.url import (
    clean_url,
    accepted_domains,
    is_search_domain,
    is_search_referrer,
    percent_decode,
    query_pairs,
    query_param,
    query_string,
    search_keyword,
    url_domain,
)

__all__ = [
    "clean_url",
    "has_event",
    "has_text",
    "hit_revenue",
    "accepted_domains",
    "is_search_domain",
    "is_search_referrer",
    "parse_price",
    "percent_decode",
    "product_array",
    "query_pairs",
    "query_param",
    "query_string",
    "search_keyword",
    "strip_ws",
    "url_domain",
]
