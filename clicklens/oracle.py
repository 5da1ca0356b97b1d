"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each statement runs on the raw test tables (``events``, ``pages``) and
re-derives the hit log with the same rules as ``sources.derived``. The rules
are written anew: nothing is taken from ``clicklens.functions``; URLs and
event lists are cut by splitting, numbers by DuckDB's own cast, and sums by
compensated addition, so a wrong pattern or a lossy sum shows. Known limit:
stray ``%`` escapes are not repaired before ``url_decode``; the derived hits
hold none.
"""

from __future__ import annotations

from clicklens.constants import (
    KEYWORD_NOT_SET,
    REPORT_DOMAIN,
    REPORT_KEYWORD,
    REPORT_REVENUE,
    SEARCH_ENGINE_HOSTS,
    WHITESPACE,
)

# The white-space set as chr() calls, so the SQL text holds no control characters.
_WS = "(" + " || ".join(f"chr({ord(c)})" for c in WHITESPACE) + ")"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"trim({x}, {_WS})"


def clean_url(x: str) -> str:
    return f"regexp_replace({strip(x)}, '^[\\x00-\\x20]+|[\\t\\n\\r]', '', 'g')"


def _before(x: str, mark: str) -> str:
    return f"string_split({x}, '{mark}')[1]"


def netloc(u: str) -> str:
    """Between ``//`` (at the start, or after a scheme) and the next slash, query or fragment."""
    head = _before(_before(u, "#"), "?")
    scheme = f"substr({head}, 1, instr({head}, '//') - 1)"
    named = f"({scheme} = '' OR (ends_with({scheme}, ':') AND regexp_full_match({scheme}, '[A-Za-z][-+.A-Za-z0-9]*:')))"
    rest = f"substr({head}, instr({head}, '//') + 2)"
    return f"(CASE WHEN {u} IS NULL THEN NULL WHEN instr({head}, '//') > 0 AND {named} THEN {_before(rest, '/')} ELSE '' END)"


def _valid(loc: str) -> str:
    return f"((instr({loc}, '[') > 0) = (instr({loc}, ']') > 0))"


def domain(x: str) -> str:
    loc = netloc(clean_url(x))
    low = f"lower({loc})"
    bare = f"(CASE WHEN starts_with({low}, 'www.') THEN substr({low}, 5) ELSE {low} END)"
    return f"(CASE WHEN {_valid(loc)} THEN nullif({bare}, '') END)"


def decode(s: str) -> str:
    return f"url_decode(replace({s}, '+', ' '))"


def query_value(x: str, names: tuple[str, ...]) -> str:
    """Decoded, trimmed first value among ``names`` (NULL when none)."""
    u = clean_url(x)
    loc = netloc(u)
    head = _before(u, "#")
    query = f"(CASE WHEN {_valid(loc)} AND instr({head}, '?') > 0 THEN substr({head}, instr({head}, '?') + 1) ELSE '' END)"
    pairs = (
        f"list_filter(string_split({query}, '&'), "
        "lambda x: instr(x, '=') > 0 AND length(x) > instr(x, '='))"
    )
    key = decode("split_part(y, '=', 1)")
    firsts = [f"list_filter({pairs}, lambda y: {key} = {_q(n)})[1]" for n in names]
    raw_pair = f"coalesce({', '.join(firsts)})"
    value = f"substr({raw_pair}, instr({raw_pair}, '=') + 1)"
    return strip(decode(value))


def keyword(x: str, names: tuple[str, ...] = ("q", "p")) -> str:
    return f"coalesce(nullif({query_value(x, names)}, ''), {_q(KEYWORD_NOT_SET)})"


def is_search(d: str) -> str:
    hosts = ", ".join(_q(h) for h in SEARCH_ENGINE_HOSTS)
    return f"coalesce(({d} IN ({hosts}) OR ('www.' || {d}) IN ({hosts})), false)"


def purchase(x: str) -> str:
    return f"coalesce(list_contains(list_transform(string_split({x}, ','), lambda t: {strip('t')}), '1'), false)"


def price(t: str) -> str:
    """A finite number as DuckDB's cast reads it; words such as nan and inf are none."""
    s = strip(t)
    value = f"TRY_CAST({s} AS DOUBLE)"
    return f"(CASE WHEN regexp_matches({s}, '^[-+.0-9]') AND isfinite({value}) THEN {value} END)"


def revenue(x: str) -> str:
    fourth = price("string_split(p, ';')[4]")
    prices = f"list_transform(string_split({x}, ','), lambda p: coalesce({fourth}, 0.0::DOUBLE))"
    return f"coalesce(list_reduce(list_prepend(0.0::DOUBLE, {prices}), lambda a, b: a + b), 0.0::DOUBLE)"


def has_text(x: str) -> str:
    return f"coalesce({strip(x)} <> '', false)"


def exact_sum(x: str) -> str:
    """Compensated sum; the tables' amounts are in cents."""
    return f"CAST(CAST(round(fsum({x}), 2) AS DECIMAL(38, 2)) AS DOUBLE)"


def _case(key: str, cases: dict[int, str], default: str) -> str:
    body = " ".join(f"WHEN {k} THEN {v}" for k, v in cases.items())
    return f"CASE {key} {body} ELSE {default} END"


_V = "CAST(value AS VARCHAR)"

HITS_SELECT = f"""
SELECT event_id,
  CAST(date_diff('second', TIMESTAMP '1970-01-01 00:00:00', ts) AS VARCHAR) AS hit_time_gmt,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS date_time,
  'Mozilla/5.0 ("' || event_type || '"; rv:' || CAST(user_id % 50 AS VARCHAR) || ')' AS user_agent,
  '10.' || CAST(user_id % 256 AS VARCHAR) || '.' || CAST(event_id % 256 AS VARCHAR) || '.1' AS ip,
  CASE event_type
    WHEN 'purchase' THEN {_case("event_id % 4", {0: "'1'", 1: "'2,1,200'", 2: "'2, 1'"}, "'12,1'")}
    WHEN 'click' THEN '2' WHEN 'view' THEN '' WHEN 'signup' THEN '12,11' ELSE NULL END AS event_list,
  'Lisbon' AS geo_city, 'LX' AS geo_region, 'PT' AS geo_country,
  event_type AS pagename,
  'https://shop.example.com/' || event_type || '/?id=' || CAST(event_id AS VARCHAR) AS page_url,
  {_case("event_id % 9", {
      0: f"'Garden;Rake - 90cm;1;' || {_V} || ';'",
      1: f"'Garden;Rake;1;' || {_V} || ';,Kitchen;Bowls;4;4.00;'",
      2: "'Garden;Lantern;1;;'",
      3: "'Garden;Lantern;1'",
      4: f"'A;B;1;abc;, ,C;D;1; ' || {_V} || ' ;'",
      5: "NULL",
      6: "'A;B;1;-5;'",
      7: f"'A;B;1;-1.5;,C;D;2;' || {_V} || ';200=3'",
  }, f"'A;B;1;' || {_V}")} AS product_list,
  {_case("event_id % 13", {
      0: "'http://www.google.com/search?hl=en&q=oak+' || CAST(user_id % 7 AS VARCHAR) || '&aq=f'",
      1: "'http://search.yahoo.com/search?p=tin+kettle&toggle=1'",
      2: "'http://www.bing.com/search?q=&p=rake'",
      3: "'https://WWW.Google.com?q=Oak%20Lantern#top'",
      4: "'http://www.gardenfinder.com/search/?k=Lantern'",
      5: "NULL",
      6: "'  http://search.msn.com/results?q=rake%2090cm  '",
      7: "'http://wwwxgoogle.com/search?q=fake'",
      8: "'http://yahoo.com/'",
      9: "'bing.com/search?q=noscheme'",
      10: "'http://msn.com/x?q=+'",
      11: "'http://www.bing.com/search?p=second&q=first'",
  }, "'http://www.google.com/search?q=' || CAST(user_id % 5 AS VARCHAR) || '%2Bx'")} AS referrer
FROM events
"""

HIT_COLS = (
    "hit_time_gmt, date_time, user_agent, ip, event_list, geo_city, geo_region, "
    "geo_country, pagename, page_url, product_list, referrer"
)


def with_hits(body: str, change: str = "*") -> str:
    """``body`` over the hits; ``change`` is their SELECT list."""
    return f"WITH hits AS (SELECT {change} FROM ({HITS_SELECT})) {body}"


def qualified(params: tuple[str, ...] = ("q", "p"), where: str = "true", keep: str = "") -> str:
    return f"""
SELECT * FROM (
  SELECT {keep}event_id, d AS search_engine_domain,
    {keyword('referrer', params)} AS search_keyword,
    {revenue('product_list')} AS revenue
  FROM (SELECT *, {domain('referrer')} AS d FROM hits WHERE {where}) h
  WHERE {is_search('d')} AND {purchase('event_list')}
) WHERE revenue > 0
"""


def keyword_revenue(
    params: tuple[str, ...] = ("q", "p"), where: str = "true", keep: str = "", key: str = ""
) -> str:
    """Revenue by [key,] domain, keyword; ``keep`` adds hit columns the key reads."""
    keys = f"{key}search_engine_domain, search_keyword"
    return f"""
SELECT {keys}, {exact_sum('revenue')} AS revenue
FROM ({qualified(params, where, keep)}) GROUP BY ALL
"""


def report(where: str = "true") -> str:
    return f"""
SELECT search_engine_domain AS "{REPORT_DOMAIN}", search_keyword AS "{REPORT_KEYWORD}",
  revenue AS "{REPORT_REVENUE}"
FROM ({keyword_revenue(where=where)})
"""


QUALIFIED = qualified()
KEYWORD_REVENUE = keyword_revenue()
REPORT = report()


def _nullif_empty(cols: str) -> str:
    return ", ".join(f"nullif({c.strip()}, '') AS {c.strip()}" for c in cols.split(","))


#: Prices of the extremes query by kind of hit, as numbers: the text forms are not parsed here.
_EXTREMES = """
SELECT 'bing.com' AS search_engine_domain, kind || CAST(event_id % 10 AS VARCHAR) AS search_keyword,
  printf('%.9e', fsum(CASE WHEN kind = 'small' THEN CASE WHEN third THEN 5 ELSE 1e-7 END
    ELSE CASE WHEN third THEN 2e22 ELSE 4.25 END END)) AS revenue
FROM (SELECT event_id, event_id // 10 % 3 = 0 AS third, CASE WHEN event_id % 2 = 0 THEN 'small' ELSE 'large' END AS kind
  FROM events) GROUP BY ALL
"""

_PRODUCT_PRICE = price("string_split(prods[idx + 1], ';')[4]")
_STRIP_X = strip("x")


def oracle_sql() -> dict[str, str]:
    revenue_text = f"replace(printf('%.2f', \"{REPORT_REVENUE}\"), ',', '')"
    report_text = (
        f'SELECT "{REPORT_DOMAIN}", "{REPORT_KEYWORD}", {revenue_text} AS "{REPORT_REVENUE}" FROM ({REPORT})'
    )
    return {
        "has_text": with_hits(
            f"SELECT event_id, {has_text('referrer')} AS referrer_has_text, "
            f"{has_text('event_list')} AS event_list_has_text, "
            f"{has_text('product_list')} AS product_list_has_text FROM hits"
        ),
        "referrer_domain": with_hits(f"SELECT event_id, {domain('referrer')} AS search_engine_domain FROM hits"),
        "search_keyword": with_hits(f"SELECT event_id, {keyword('referrer')} AS search_keyword FROM hits"),
        "hit_revenue": with_hits(f"SELECT event_id, {revenue('product_list')} AS revenue FROM hits"),
        "hit_attribution": with_hits(
            f"SELECT event_id, d AS search_engine_domain, {keyword('referrer')} AS search_keyword, "
            f"{is_search('d')} AS is_external_search, {purchase('event_list')} AS is_purchase, "
            f"{revenue('product_list')} AS revenue FROM (SELECT *, {domain('referrer')} AS d FROM hits)"
        ),
        "product_rows": with_hits(
            f"""SELECT event_id, CAST(idx AS BIGINT) AS product_index,
                string_split(prods[idx + 1], ';')[1] AS category,
                string_split(prods[idx + 1], ';')[2] AS product_name,
                string_split(prods[idx + 1], ';')[3] AS quantity,
                string_split(prods[idx + 1], ';')[4] AS price_text,
                {_PRODUCT_PRICE} AS price
              FROM (SELECT event_id, prods, unnest(range(len(prods))) AS idx FROM (
                SELECT event_id, list_filter(list_transform(string_split(product_list, ','),
                  lambda x: {_STRIP_X}), lambda x: x <> '') AS prods FROM hits))"""
        ),
        "external_search_hits": with_hits(
            f"SELECT event_id, d AS search_engine_domain FROM "
            f"(SELECT event_id, {domain('referrer')} AS d FROM hits) WHERE {is_search('d')}"
        ),
        "external_search_hits_table": with_hits(
            f"SELECT event_id, d AS search_engine_domain FROM (SELECT event_id, {domain('referrer')} AS d FROM hits) "
            f"WHERE d IN (SELECT {domain('referrer')} FROM hits WHERE {purchase('event_list')}) "
            f"OR d IN (SELECT 'www.' || {domain('referrer')} FROM hits WHERE {purchase('event_list')})"
        ),
        "purchase_hits": with_hits(f"SELECT event_id, event_list FROM hits WHERE {purchase('event_list')}"),
        "qualified_hits": with_hits(QUALIFIED),
        "keyword_revenue": with_hits(KEYWORD_REVENUE),
        "keyword_report": with_hits(REPORT),
        "report_row_count": with_hits(f"SELECT count(*) AS report_rows FROM ({KEYWORD_REVENUE})"),
        "pages_domain": f"SELECT page_id, {domain('url')} AS page_domain FROM pages",
        "pages_query_param": (
            f"SELECT page_id, {query_value('url', ('utm_source',))} AS utm_source, "
            f"{query_value('url', ('page',))} AS page, {query_value('url', ('ref',))} AS ref FROM pages"
        ),
        "events_by_type_revenue": (
            f"SELECT event_type, count(*) AS events, {exact_sum('value')} AS revenue "
            "FROM events GROUP BY event_type"
        ),
        "hits_scan": with_hits(f"SELECT {_nullif_empty(HIT_COLS)} FROM hits"),
        "hits_schema": with_hits(
            "SELECT TRY_CAST(hit_time_gmt AS BIGINT) AS hit_time_gmt, "
            "try_strptime(date_time, '%Y-%m-%d %H:%M:%S') AS date_time, CAST(NULL AS VARCHAR) AS geo_city, "
            + _nullif_empty("user_agent, ip, event_list, geo_region, geo_country, pagename, page_url, product_list, referrer")
            + " FROM hits"
        ),
        "hits_from_lines": with_hits(REPORT),
        "hits_short_rows": with_hits(report("event_id % 7 <> 3")),
        "report_sink": with_hits(report_text),
        "report_rerun": with_hits(
            f"SELECT *, DATE '2024-01-30' AS run_date FROM ({KEYWORD_REVENUE}) UNION ALL "
            f"SELECT *, DATE '2024-01-31' AS run_date FROM ({keyword_revenue(('p', 'q'))})"
        ),
        "report_table": with_hits(f"SELECT *, DATE '2024-01-30' AS run_date FROM ({KEYWORD_REVENUE})"),
        "report_empty": (
            f"SELECT '{REPORT_DOMAIN}' || chr(9) || '{REPORT_KEYWORD}' || chr(9) || '{REPORT_REVENUE}' AS line"
        ),
        "hits_mixed_headers": with_hits(
            f"SELECT {_nullif_empty(HIT_COLS)} FROM hits",
            "* REPLACE (CASE WHEN event_id % 3 <> 2 THEN geo_city END AS geo_city)",
        ),
        "hits_multi_line": with_hits(
            f"SELECT {_nullif_empty(HIT_COLS)} FROM hits",
            "* REPLACE (CASE WHEN event_id % 5 = 0 THEN user_agent || chr(10) || chr(9) || 'second line' ELSE user_agent END AS user_agent)",
        ),
        "keyword_revenue_extremes": _EXTREMES,
        "report_rerun_empty": (
            f"SELECT '{REPORT_DOMAIN}' || chr(9) || '{REPORT_KEYWORD}' || chr(9) || '{REPORT_REVENUE}' AS line, CAST(0 AS BIGINT) AS table_rows"
        ),
        "report_rerun_by_input": with_hits(
            f'SELECT "{REPORT_DOMAIN}", "{REPORT_KEYWORD}", {revenue_text} AS "{REPORT_REVENUE}" FROM ({report("event_id % 2 = 1")})'
        ),
        "report_by_input_two_files": with_hits(
            " UNION ALL ".join(f"SELECT '{k}' AS input, * FROM ({keyword_revenue(where=f'event_id % 2 = {k}')})" for k in (0, 1))
        ),
        "report_line_break_keyword": with_hits(report_text, "* REPLACE (replace(referrer, 'q=oak+', 'q=oak%0A') AS referrer)"),
        "incremental_dated_file": with_hits(
            f'SELECT "{REPORT_DOMAIN}", "{REPORT_KEYWORD}", {revenue_text} AS "{REPORT_REVENUE}" FROM '
            f'({report("substr(date_time, 1, 10) = (SELECT max(substr(date_time, 1, 10)) FROM hits)")})'
        ),
        "incremental_report": with_hits(
            keyword_revenue(keep="substr(date_time, 1, 10) AS day, ", key="day, ")
        ),
        "running_revenue": with_hits(KEYWORD_REVENUE),
        "running_revenue_reupload": with_hits(keyword_revenue(where="NOT (CAST(substr(date_time, 9, 2) AS INTEGER) % 2 = 0 AND event_id % 3 = 0)")),
    }
