"""Host lists given as a table: the same hits as with a list, and the join that is chosen."""

import pytest
from pyspark.sql import functions as F

from clicklens.constants import SEARCH_ENGINE_HOSTS
from clicklens.operators import attribution, external_search_hits, keyword_revenue

REFERRERS = [
    "http://www.google.com/search?q=a", "http://WWW.Bing.com/?q=b", "http://google.com:80/?q=c", "http://www.www.bing.com/?q=d",
    "https://search.yahoo.com/?p=e", "google.com/?q=f", "", None, "http://", "http://msn.com", "http://other.net/?q=g",
]


def hits(spark):
    rows = [(i, r, "1", "A;B;1;2;") for i, r in enumerate(REFERRERS * 2)]
    return spark.createDataFrame(rows, "id int, referrer string, event_list string, product_list string")


def table(spark, hosts):
    return spark.createDataFrame([(h, 1) for h in hosts], "host string, referrer int")


@pytest.mark.parametrize("most", [200_000, 2])
def test_a_table_of_hosts_gives_what_the_list_gives(spark, monkeypatch, most):
    monkeypatch.setattr(attribution, "FEW_HOSTS", most)
    for hosts in (list(SEARCH_ENGINE_HOSTS), ["www.bing.com"], ["www.www.bing.com", "www."], ["other.net"] * 3, []):
        given = table(spark, [*hosts, None, ""])
        by_list, by_table = (sorted(map(tuple, external_search_hits(hits(spark), h).collect()), key=str) for h in (hosts, given))
        assert by_table == by_list
        sums = [sorted(map(tuple, keyword_revenue(hits(spark), h).collect())) for h in (hosts, given)]
        assert sums[0] == sums[1]


def test_small_tables_are_broadcast_large_ones_are_not(spark, monkeypatch):
    plan = lambda: external_search_hits(hits(spark), table(spark, ["bing.com", "msn.com"])).select(F.lit(1))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan()
    monkeypatch.setattr(attribution, "FEW_HOSTS", 1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan() and "LeftSemi" in plan()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
