"""URL parsing of referrers as Spark column expressions.

The rules follow Python's ``urllib.parse.urlsplit`` and ``parse_qs``, which
define the attribution contract:

* the URL is trimmed; leading control characters and spaces are dropped and
  TAB, CR and LF are removed anywhere;
* a scheme is the text before the first ``:`` when it starts with a letter and
  holds only letters, digits, ``+``, ``-`` and ``.``;
* the network location follows ``//`` and runs to the first ``/``, ``?`` or
  ``#``; it keeps user-info and port; one ``[`` without ``]`` (or the reverse)
  makes the whole URL invalid;
* the query is the text after the first ``?`` that comes before any ``#``;
* query pairs split on ``&``; a pair without ``=`` or with an empty raw value is
  skipped; ``+`` is a space and ``%XX`` escapes are decoded in key and value
  (a ``%`` not followed by two hex digits stays as it is).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from clicklens.constants import KEYWORD_NOT_SET, KEYWORD_PARAMS, SEARCH_ENGINE_HOSTS
from clicklens.functions.text import _col, strip_ws

_NETLOC = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
# The same location without one leading "www." (any case): lower-casing it
# gives the domain, except for the bracket check and the empty case.
_HOST = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[wW][wW][wW]\.)?([^/?#]*)"
_QUERY = r"^[^?#]*\?([^#]*)"
_STRAY_PERCENT = r"%(?![0-9A-Fa-f]{2})"
# Leading C0 controls and spaces, and TAB/CR/LF anywhere (removed by urlsplit).
_UNSAFE = r"^[\x00-\x20]+|[\t\n\r]"


def clean_url(c: Column | str) -> Column:
    """Trimmed URL without leading controls/spaces and without TAB/CR/LF.

    One regex pass (measured faster than ``translate`` + ``ltrim``).
    """
    return F.regexp_replace(strip_ws(c), _UNSAFE, "")


def netloc(url: Column) -> Column:
    """Network location of a cleaned URL; '' when there is none."""
    return F.regexp_extract(url, _NETLOC, 1)


def _valid(loc: Column) -> Column:
    """False when the location holds exactly one of '[' and ']'."""
    return (F.instr(loc, "[") > 0) == (F.instr(loc, "]") > 0)


def domain_of_netloc(loc: Column) -> Column:
    """Lower-cased location without one leading 'www.'; NULL if empty/invalid."""
    host = F.nullif(F.regexp_replace(F.lower(loc), r"^www\.", ""), F.lit(""))
    return F.when(_valid(loc), host)


def url_domain(c: Column | str) -> Column:
    """Referrer -> search engine domain (NULL when the URL has no host)."""
    return domain_of_netloc(netloc(clean_url(c)))


def query_string(url: Column, loc: Column | None = None) -> Column:
    """Query part of a cleaned URL; '' when there is none or the URL is invalid.

    ``loc`` is its network location, where that is at hand.
    """
    loc = netloc(url) if loc is None else loc
    return F.when(_valid(loc), F.regexp_extract(url, _QUERY, 1)).otherwise(F.lit(""))


def percent_decode(c: Column) -> Column:
    """'+' -> space and %XX decoding (UTF-8, bad bytes -> U+FFFD); stray '%' kept."""
    return F.url_decode(F.regexp_replace(c, _STRAY_PERCENT, "%25"))


def query_pairs(query: Column) -> Column:
    """array<struct<k: decoded key, v: raw value>> of the non-blank pairs, in order."""
    kept = F.filter(
        F.split(query, "&"),
        lambda x: (F.instr(x, "=") > 0) & (F.length(x) > F.instr(x, "=")),
    )
    return F.transform(
        kept,
        lambda x: F.struct(
            percent_decode(F.substring_index(x, "=", 1)).alias("k"),
            x.substr(F.instr(x, "=") + 1, F.length(x)).alias("v"),
        ),
    )


def _key_is(name: str):
    return lambda p: p["k"] == F.lit(name)


def _hex_byte(b: int) -> str:
    return "%" + "".join(d if d.isdigit() else f"[{d}{d.lower()}]" for d in f"{b:02X}")


def key_pattern(name: str) -> str | None:
    """Regex for every raw key that decodes to ``name`` (each character literal or
    %-escaped, hex in either case; a space also as '+'; '&' and '=' only
    escaped). None when ``name`` holds '%' or '+', whose raw forms depend on
    their neighbours."""
    if "%" in name or "+" in name or not name:
        return None
    parts = []
    for ch in name:
        alts = ["".join(_hex_byte(b) for b in ch.encode("utf-8"))]
        if ch not in "&=":  # these two can only appear %-escaped inside a key
            alts.append(re.escape(ch))
        if ch == " ":
            alts.append(r"\+")
        parts.append("(?:" + "|".join(alts) + ")")
    return "".join(parts)


def raw_param(query: Column, name: str) -> Column:
    """Raw value of the first pair whose key decodes to ``name`` and whose raw value
    is not empty; NULL when there is none. One regex, no array lambdas: the
    leftmost match is the first such pair."""
    pattern = key_pattern(name)
    if pattern is None:
        return F.get(F.filter(query_pairs(query), _key_is(name)), 0)["v"]
    return F.nullif(F.regexp_extract(query, f"(?:^|&){pattern}=([^&]+)", 1), F.lit(""))


def query_param(c: Column | str, names: Sequence[str] | str) -> Column:
    """URL -> value of the first query parameter among ``names`` ('' if blank), or NULL."""
    return param_of(query_string(clean_url(c)), (names,) if isinstance(names, str) else names)


def param_of(query: Column, names: Sequence[str]) -> Column:
    """Query string -> decoded, trimmed value of the first parameter among ``names``, or NULL."""
    return strip_ws(percent_decode(F.coalesce(*[raw_param(query, n) for n in names])))


def keyword_of(query: Column, params: Sequence[str] = KEYWORD_PARAMS) -> Column:
    """Query string -> search keyword; '(not set)' when absent or blank."""
    return F.coalesce(F.nullif(param_of(query, params), F.lit("")), F.lit(KEYWORD_NOT_SET))


def search_keyword(c: Column | str, params: Sequence[str] = KEYWORD_PARAMS) -> Column:
    """Referrer -> search keyword; '(not set)' when absent or blank."""
    return keyword_of(query_string(clean_url(c)), params)


def accepted_domains(hosts: Sequence[str] = SEARCH_ENGINE_HOSTS) -> list[str]:
    """Domains d with d in hosts or 'www.' + d in hosts (one set, one lookup)."""
    out = dict.fromkeys(hosts)
    out.update(dict.fromkeys(h[4:] for h in hosts if h.startswith("www.") and len(h) > 4))
    return list(out)


def is_search_domain(domain: Column | str, hosts: Sequence[str] = SEARCH_ENGINE_HOSTS) -> Column:
    """Exact membership of the domain (or 'www.' + domain) in the host list; never NULL."""
    return F.coalesce(_col(domain).isin(accepted_domains(hosts)), F.lit(False))


def is_search_referrer(c: Column | str, hosts: Sequence[str] = SEARCH_ENGINE_HOSTS) -> Column:
    """Same answer as ``is_search_domain(url_domain(c))``, as one regex and one set lookup.

    Listed hosts hold no brackets and are not empty, so the validity and empty
    checks of ``url_domain`` cannot change the answer. Built for the per-hit
    filter: it reads the referrer once and stays inside whole-stage codegen.
    """
    host = F.lower(F.regexp_extract(clean_url(c), _HOST, 1))
    return F.coalesce(host.isin(accepted_domains(hosts)), F.lit(False))
