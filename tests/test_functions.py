"""Column rules, table-driven: the reference's unit cases plus hostile inputs."""

from __future__ import annotations

import pytest

from clicklens.functions import (
    has_event,
    has_text,
    hit_revenue,
    is_search_domain,
    is_search_referrer,
    query_param,
    search_keyword,
    url_domain,
)
from tests.conftest import one_col

# (referrer, domain, is search engine, keyword); expected values from rules R1-R3.
REFERRERS = [
    ("http://www.google.com/search?q=ipod+classic", "google.com", True, "ipod classic"),
    ("http://search.yahoo.com/search?p=cd+player&x=1", "search.yahoo.com", True, "cd player"),
    ("http://www.google.com?q=a", "google.com", True, "a"),
    ("http://www.google.com#q=a", "google.com", True, "(not set)"),
    ("https://WWW.Google.COM/s?q=Ipod", "google.com", True, "Ipod"),
    ("//google.com/s?q=a", "google.com", True, "a"),
    ("google.com/s?q=a", None, False, "a"),
    ("  http://bing.com/s?q=z  ", "bing.com", True, "z"),
    ("http://bing.com:80/s?q=z", "bing.com:80", False, "z"),
    ("http://u:p@bing.com/s?q=z", "u:p@bing.com", False, "z"),
    ("http://bing.com/s?q=&p=x", "bing.com", True, "x"),
    ("http://bing.com/s?q=&q=y", "bing.com", True, "y"),
    ("http://bing.com/s?q", "bing.com", True, "(not set)"),
    ("http://bing.com/s?q=+", "bing.com", True, "(not set)"),
    ("http://bing.com/s?q=%20", "bing.com", True, "(not set)"),
    ("http://bing.com/s?q=a%20b", "bing.com", True, "a b"),
    ("http://bing.com/s?q=100%", "bing.com", True, "100%"),
    ("http://bing.com/s?q=100%25", "bing.com", True, "100%"),
    ("http://bing.com/s?q=%E2%82%AC5", "bing.com", True, "€5"),
    ("http://bing.com/s?q=%FF", "bing.com", True, "�"),
    ("http://bing.com/s?%71=enc", "bing.com", True, "enc"),
    ("http://bing.com/s?q=a#frag", "bing.com", True, "a"),
    ("http://bing.com/s#x?q=a", "bing.com", True, "(not set)"),
    ("http://bing.com/s?a=b?q=c", "bing.com", True, "(not set)"),
    ("http://bing.com/s?p=first&q=second", "bing.com", True, "second"),
    ("http://bing.com/s?aq=f&oq=&q=t", "bing.com", True, "t"),
    ("http://bing.com/s?q=a;p=b", "bing.com", True, "a;p=b"),
    ("http://bing.com/s?q=a=b", "bing.com", True, "a=b"),
    ("http://bing.com/s?Q=up", "bing.com", True, "(not set)"),
    ("http://www.www.google.com/s?q=a", "www.google.com", True, "a"),
    ("http://wwwxgoogle.com/s?q=a", "wwwxgoogle.com", False, "a"),
    ("http://google.com/s?q=%zz", "google.com", True, "%zz"),
    ("http:///s?q=a", None, False, "a"),
    ("android-app://com.google/?q=a", "com.google", False, "a"),
    ("ftp://msn.com/?q=n", "msn.com", True, "n"),
    ("foo//google.com/?q=a", None, False, "a"),
    ("http://[google.com/?q=a", None, False, "(not set)"),
    ("http://google.com\\x/?q=a", "google.com\\x", False, "a"),
    ("http://www./?q=a", None, False, "a"),
    ("http://google.com/s?q=a&q=b", "google.com", True, "a"),
    ("", None, False, "(not set)"),
    ("   ", None, False, "(not set)"),
    (None, None, False, "(not set)"),
    ("http://google.co.uk/search?q=a", "google.co.uk", False, "a"),
    ("http://google.com/s?q=café", "google.com", True, "café"),
    ("http://google.com/s?q=a%2Bb+c", "google.com", True, "a+b c"),
    ("1http://google.com/?q=a", None, False, "a"),
    ("ht_tp://google.com/?q=a", None, False, "a"),
    # The reference's own unit cases.
    ("http://www.google.com/search?q=ipod", "google.com", True, "ipod"),
    ("http://www.bing.com/search?q=Zune", "bing.com", True, "Zune"),
    ("http://www.google.com/search?q=Ipod", "google.com", True, "Ipod"),
    ("http://search.yahoo.com/search?p=cd+player", "search.yahoo.com", True, "cd player"),
    ("http://www.esshopzilla.com/search/?k=Ipod", "esshopzilla.com", False, "(not set)"),
    # Python's str.strip() white space, and URL bytes urlsplit removes.
    ("　http://bing.com/s?q= z ", "bing.com", True, "z"),
    ("http://bi\tng.com/s?q=a\nb", "bing.com", True, "ab"),
]


@pytest.fixture(scope="module")
def referrers(spark):
    df = one_col(spark, [r[0] for r in REFERRERS], "referrer")
    rows = df.select(
        "id",
        url_domain("referrer").alias("d"),
        is_search_domain(url_domain("referrer")).alias("s"),
        is_search_referrer("referrer").alias("s2"),
        search_keyword("referrer").alias("k"),
    ).collect()
    return {r.id: r for r in rows}


@pytest.mark.parametrize("i", range(len(REFERRERS)), ids=[repr(r[0])[:40] for r in REFERRERS])
def test_referrer_rules(referrers, i):
    ref, domain, search, keyword = REFERRERS[i]
    got = referrers[i]
    assert (got.d, got.s, got.k) == (domain, search, keyword)
    assert got.s2 == search  # the one-regex filter agrees with the full domain rule


EVENT_LISTS = [
    ("1", True), ("2,1,200", True), ("2, 1", True), (" 1 ", True), ("12", False),
    ("11,12", False), (",", False), ("", False), (None, False), ("2,200", False),
    ("200,1", True), ("1　,5", True), ("21,13", False),
]


def test_purchase_event(spark):
    df = one_col(spark, [e for e, _ in EVENT_LISTS])
    got = [r[0] for r in df.orderBy("id").select(has_event("v")).collect()]
    assert got == [want for _, want in EVENT_LISTS]


PRODUCT_LISTS = [
    ("Electronics;Zune - 32GB;1;250;", 250.0),
    ("Electronics;Zune - 32GB;1;250;,Office Supplies;Red Folders;4;4.00;", 254.0),
    ("", 0.0),
    (None, 0.0),
    ("A;B;1;abc;, ,C;D;1; 5 ;", 5.0),
    ("A;B;1", 0.0),
    ("A;B;1;", 0.0),
    ("A;B;1;-5;", -5.0),
    ("A;B;1;-1.5;,C;D;2;4;200=3", 2.5),
    ("A;B;1;1e3;", 1000.0),
    ("A;B;1;1_000;", 1000.0),
    ("A;B;1;.5;,A;B;1;5.;,A;B;1;+2;", 7.5),
    ("A;B;1;nan;", 0.0),
    ("A;B;1;inf;", 0.0),
    ("A;B;1;5d;", 0.0),
    ("A;B;1;1__0;", 0.0),
    ("A;B;1;0.1;,A;B;1;0.2;", 0.1 + 0.2),
]


def test_hit_revenue(spark):
    df = one_col(spark, [p for p, _ in PRODUCT_LISTS])
    got = [r[0] for r in df.orderBy("id").select(hit_revenue("v")).collect()]
    assert got == [want for _, want in PRODUCT_LISTS]


def test_has_text(spark):
    values = ["x", " x ", "", "   ", None, "　", "\t\n"]
    df = one_col(spark, values)
    got = [r[0] for r in df.orderBy("id").select(has_text("v")).collect()]
    assert got == [True, True, False, False, False, False, False]


def test_keyword_params_are_configurable(spark):
    df = one_col(spark, ["http://x.com/?utm_source=feed&q=a", "http://x.com/?q=a&p=b"])
    got = [r[0] for r in df.orderBy("id").select(search_keyword("v", ("p", "q"))).collect()]
    assert got == ["a", "b"]


def test_search_hosts_are_configurable(spark):
    df = one_col(spark, ["http://duckduckgo.com/?q=a", "http://www.google.com/?q=a"])
    flags = df.orderBy("id").select(is_search_domain(url_domain("v"), ("www.duckduckgo.com",))).collect()
    assert [r[0] for r in flags] == [True, False]


def test_query_param_key_encodings_and_fallback(spark):
    urls = [
        "http://x.com/?utm%5Fsource=a&utm_source=b",
        "http://x.com/?utm%5fsource=&utm_source=c",
        "http://x.com/?a%2Bb=1&a+b=2",
        "http://x.com/?a%25=3",
        "http://x.com/?x=1&a%26b=4&a&b=5",
        "http://x.com/?a%3Db=6",
    ]
    df = one_col(spark, urls)
    got = df.orderBy("id").select(
        query_param("v", "utm_source"), query_param("v", "a+b"), query_param("v", "a%"),
        query_param("v", "a&b"), query_param("v", "a=b"), query_param("v", "a b"),
    ).collect()
    assert [tuple(r) for r in got] == [
        ("a", None, None, None, None, None),
        ("c", None, None, None, None, None),
        (None, "1", None, None, None, "2"),
        (None, None, "3", None, None, None),
        (None, None, None, "4", None, None),
        (None, None, None, None, "6", None),
    ]


def test_with_attribution_and_typed(spark):
    from clicklens.constants import HIT_COLUMNS
    from clicklens.operators import with_attribution
    from clicklens.sources.schema import typed

    row = {c: None for c in HIT_COLUMNS}
    row.update(
        hit_time_gmt="1254033280", date_time="2009-09-27 06:34:40", event_list="2,1",
        product_list="A;B;1;2.5;,C;D;1;1;", referrer="http://www.Bing.com/s?q=z+z",
    )
    df = spark.createDataFrame([tuple(row[c] for c in HIT_COLUMNS)], ", ".join(f"{c} string" for c in HIT_COLUMNS))
    got = with_attribution(df).select(
        "search_engine_domain", "search_keyword", "is_external_search", "is_purchase", "revenue"
    ).first()
    assert tuple(got) == ("bing.com", "z z", True, True, 3.5)
    t = typed(df).select("hit_time_gmt", "date_time").first()
    assert t.hit_time_gmt == 1254033280
    assert str(t.date_time) == "2009-09-27 06:34:40"
