"""Table-level operators (``DataFrame -> DataFrame``)."""

from clicklens.operators.aggregate import (
    exact_sum,
    keyword_report,
    keyword_revenue,
    labelled,
    report_order,
    revenue_by,
    sum_positive,
)
from clicklens.operators.attribution import (
    attribute,
    candidate_flag,
    external_search_hits,
    purchase_hits,
    qualified_hits,
    search_purchases,
    with_attribution,
    with_domain,
)
from clicklens.operators.products import product_rows

__all__ = [
    "attribute",
    "candidate_flag",
    "sum_positive",
    "exact_sum",
    "external_search_hits",
    "keyword_report",
    "keyword_revenue",
    "labelled",
    "product_rows",
    "purchase_hits",
    "qualified_hits",
    "report_order",
    "revenue_by",
    "search_purchases",
    "with_attribution",
    "with_domain",
]
