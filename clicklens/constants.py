"""Values that must stay equal to the job we re-implement.

Everything below is a fixed value of the attribution contract. Functions take
these as defaults and accept other values as arguments.
"""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------

# Referring hosts that count as external search. Matching is exact on the host
# after one leading "www." is removed; a host also matches when "www." + host
# is in the list.
SEARCH_ENGINE_HOSTS: tuple[str, ...] = (
    "google.com",
    "www.google.com",
    "search.yahoo.com",
    "yahoo.com",
    "www.yahoo.com",
    "bing.com",
    "www.bing.com",
    "msn.com",
    "search.msn.com",
)

# Query-string parameters holding the search term, in priority order.
KEYWORD_PARAMS: tuple[str, ...] = ("q", "p")

# Event code of a purchase inside the comma-separated event list.
PURCHASE_EVENT = "1"

# Labels used when a value is missing.
UNKNOWN_DOMAIN = "unknown"
KEYWORD_NOT_SET = "(not set)"

# Hit-level input columns, in file order.
HIT_COLUMNS: tuple[str, ...] = (
    "hit_time_gmt",
    "date_time",
    "user_agent",
    "ip",
    "event_list",
    "geo_city",
    "geo_region",
    "geo_country",
    "pagename",
    "page_url",
    "product_list",
    "referrer",
)

# Report column labels, in output order.
REPORT_DOMAIN = "Search Engine Domain"
REPORT_KEYWORD = "Search Keyword"
REPORT_REVENUE = "Revenue"

# Report file name: "<ISO date>_SearchKeywordPerformance.tab".
REPORT_FILE_SUFFIX = "_SearchKeywordPerformance.tab"

# Characters removed by text trimming: exactly the characters Python's
# str.strip() removes (str.isspace() is true for these 29 code points).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# --- end of fixed values ----------------------------------------------------

# Internal snake_case names of derived columns.
DOMAIN = "search_engine_domain"
KEYWORD = "search_keyword"
REVENUE = "revenue"
IS_PURCHASE = "is_purchase"
IS_EXTERNAL_SEARCH = "is_external_search"

# Exact decimal type of revenue sums, and the size from which a double has no
# six decimal places left, so that the decimal part would gain nothing. A sum
# has room for 1e17 values below it.
REVENUE_SUM_TYPE = "decimal(28,6)"
DECIMAL_BELOW = 1e15
