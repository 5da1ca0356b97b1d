"""A hit log derived from the ``events`` table.

The provided tables hold no hit log, so one is derived from ``events``: every
event becomes one hit whose event list, product list and referrer are chosen
from the event's id, type and value. The mix exercises every attribution rule
(blank parameters, escapes, fragments, hosts without a path, look-alike hosts,
padded text, short products, bad numbers, negative prices). The same
definition is written as SQL in ``clicklens.oracle`` for the DuckDB check.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklens.constants import HIT_COLUMNS


def _case(key: Column, cases: Mapping[int, Column | str | None], default: Column | str | None) -> Column:
    def lit(v):
        return v if isinstance(v, Column) else F.lit(v).cast("string")

    out = None
    for k, v in cases.items():
        out = F.when(key == k, lit(v)) if out is None else out.when(key == k, lit(v))
    return out.otherwise(lit(default))


def hits_from_events(events: DataFrame) -> DataFrame:
    """``events`` -> ``event_id`` + the 12 hit columns, one hit per event."""
    eid, uid, etype = F.col("event_id"), F.col("user_id"), F.col("event_type")
    value = F.col("value").cast("string")

    purchase = _case(eid % 4, {0: "1", 1: "2,1,200", 2: "2, 1"}, "12,1")
    event_list = (
        F.when(etype == "purchase", purchase)
        .when(etype == "click", F.lit("2"))
        .when(etype == "view", F.lit(""))
        .when(etype == "signup", F.lit("12,11"))
    )
    product_list = _case(
        eid % 9,
        {
            0: F.concat(F.lit("Garden;Rake - 90cm;1;"), value, F.lit(";")),
            1: F.concat(F.lit("Garden;Rake;1;"), value, F.lit(";,Kitchen;Bowls;4;4.00;")),
            2: "Garden;Lantern;1;;",
            3: "Garden;Lantern;1",
            4: F.concat(F.lit("A;B;1;abc;, ,C;D;1; "), value, F.lit(" ;")),
            5: None,
            6: "A;B;1;-5;",
            7: F.concat(F.lit("A;B;1;-1.5;,C;D;2;"), value, F.lit(";200=3")),
        },
        F.concat(F.lit("A;B;1;"), value),
    )
    referrer = _case(
        eid % 13,
        {
            0: F.concat(
                F.lit("http://www.google.com/search?hl=en&q=oak+"),
                (uid % 7).cast("string"),
                F.lit("&aq=f"),
            ),
            1: "http://search.yahoo.com/search?p=tin+kettle&toggle=1",
            2: "http://www.bing.com/search?q=&p=rake",
            3: "https://WWW.Google.com?q=Oak%20Lantern#top",
            4: "http://www.gardenfinder.com/search/?k=Lantern",
            5: None,
            6: "  http://search.msn.com/results?q=rake%2090cm  ",
            7: "http://wwwxgoogle.com/search?q=fake",
            8: "http://yahoo.com/",
            9: "bing.com/search?q=noscheme",
            10: "http://msn.com/x?q=+",
            11: "http://www.bing.com/search?p=second&q=first",
        },
        F.concat(F.lit("http://www.google.com/search?q="), (uid % 5).cast("string"), F.lit("%2Bx")),
    )
    cols = {
        "hit_time_gmt": F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)").cast("string"),
        "date_time": F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        # Quotes inside a field exercise the TSV quoting rules.
        "user_agent": F.concat(F.lit('Mozilla/5.0 ("'), etype, F.lit('"; rv:'), (uid % 50).cast("string"), F.lit(")")),
        "ip": F.concat(F.lit("10."), (uid % 256).cast("string"), F.lit("."), (eid % 256).cast("string"), F.lit(".1")),
        "event_list": event_list,
        "geo_city": F.lit("Lisbon"),
        "geo_region": F.lit("LX"),
        "geo_country": F.lit("PT"),
        "pagename": etype,
        "page_url": F.concat(F.lit("https://shop.example.com/"), etype, F.lit("/?id="), eid.cast("string")),
        "product_list": product_list,
        "referrer": referrer,
    }
    return events.select(eid.alias("event_id"), *[cols[c].alias(c) for c in HIT_COLUMNS])


def read_events(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def derived_hits(spark, sf_dir: str) -> DataFrame:
    """The derived hit log of a test-data directory (``event_id`` + 12 columns)."""
    return hits_from_events(read_events(spark, sf_dir))
