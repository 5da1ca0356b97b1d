"""The hit-level input contract and the by-name header rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklens.constants import HIT_COLUMNS


def hits_schema(columns: Sequence[str] = HIT_COLUMNS) -> T.StructType:
    """All-string schema of the hit file, in file order."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def conform(
    df: DataFrame, columns: Sequence[str] = HIT_COLUMNS, keep: Sequence[str] = ()
) -> DataFrame:
    """Trim column names, then select the contract columns by exact name.

    Names match case-sensitively; when a trimmed name repeats, the last
    column wins. Columns missing from the input become NULL strings, so an
    input without a header (zero columns) turns into an empty, correctly
    shaped table. Columns are picked by position, so names that differ only
    in case cannot clash. ``keep`` names extra input columns to pass through.
    """
    names = list(df.columns)
    position = {n.strip(): i for i, n in enumerate(names)}
    extra = [names.index(k) for k in keep]
    by_pos = df.toDF(*[f"_in{i}" for i in range(len(names))])
    return by_pos.select(
        *[
            (F.col(f"_in{position[c]}") if c in position else F.lit(None).cast("string")).alias(c)
            for c in columns
        ],
        *[F.col(f"_in{i}").alias(names[i]) for i in extra],
    )


def typed(df: DataFrame) -> DataFrame:
    """Contract columns plus typed views of the two time columns.

    ``hit_time_gmt`` (epoch seconds) becomes bigint and ``date_time`` a
    timestamp without time zone; text that does not parse becomes NULL.
    """
    parts = [
        F.regexp_extract("date_time", _DATE_TIME, i).try_cast("int") for i in range(1, 7)
    ]
    return df.select(
        F.col("hit_time_gmt").try_cast("bigint").alias("hit_time_gmt"),
        # Built from its parts, so no session time zone is involved.
        F.try_make_timestamp_ntz(*parts).alias("date_time"),
        *[F.col(c) for c in HIT_COLUMNS if c not in ("hit_time_gmt", "date_time")],
    )


_DATE_TIME = r"^(\d{4})-(\d{2})-(\d{2}) (\d{2}):(\d{2}):(\d{2})$"
