"""Tab-separated hit logs: batch files, lines of text, and a file stream.

Format: one header line, tab separator, ``"`` quotes with ``""`` inside a
quoted field; text behind a closing quote belongs to its field. Columns are
resolved by (trimmed) header name, file by file, so files with padded,
reordered or absent columns mix freely: one scan reads them all, and where
headers differ each row looks up the places of its file's columns.

Rows with fewer fields than their header (and blank lines) are dropped; extra
fields are ignored. Lines are split where they are read, and once: whole files
may be split over tasks. A line is cut at its tabs; only lines with a quote
inside a quoted field, or a tab there, are parsed field by field. A line that
leaves a quote open belongs to a field with a line break in it: reading it
line by line would lose the row, so the read fails and asks for
``multi_line=True``, which joins lines to records first, files in splits all
the same (``records``).
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens.constants import HIT_COLUMNS
from clicklens.sources.records import records
from clicklens.sources.schema import conform

TSV_OPTIONS = {"sep": "\t", "quote": '"', "escape": '"'}
WRITE_OPTIONS = {
    **TSV_OPTIONS,
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

#: Files that one scan reads under different headers; their places are broadcast (about 300 bytes a file).
FILES_A_SCAN = 50_000


def data_files(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """Files under a path, glob, or list of them (folders searched, hidden names skipped), in order."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = set()
    for given in [path] if isinstance(path, str) else path:
        p = jvm.org.apache.hadoop.fs.Path(given)
        fs = p.getFileSystem(conf)
        hits = fs.globStatus(p)
        if not hits:
            raise FileNotFoundError(given)
        for hit in hits:
            files = fs.listFiles(hit.getPath(), True)
            base = str(fs.makeQualified(hit.getPath()))
            while files.hasNext():
                name = str(files.next().getPath())
                if not any(part[:1] in "._" for part in name[len(base) :].split("/") if part):
                    found.add(name)
    return sorted(found)


def header_line(spark: SparkSession, file: str) -> str | None:
    """First line of a file (compressed or not); None when it has none."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(file)
    stream = p.getFileSystem(conf).open(p)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
        source = codec.createInputStream(stream) if codec else stream
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(source, "UTF-8")).readLine()
    finally:
        stream.close()
    return line.removeprefix("\ufeff") if line else None


def file_headers(spark: SparkSession, path: str | Sequence[str]) -> dict[str, str]:
    """File -> its header line; files without a line are left out.

    Reads one line of each file, 32 files at a time.
    """
    files = data_files(spark, path)
    with ThreadPoolExecutor(32) as pool:
        lines = list(pool.map(lambda f: header_line(spark, f), files))
    return {f: line for f, line in zip(files, lines, strict=True) if line}


def header_names(line: str) -> list[str]:
    return [n.strip() for n in next(csv.reader([line], delimiter="\t"), [])]


def read_hits(
    spark: SparkSession,
    path: str | Sequence[str],
    *,
    multi_line: bool = False,
    columns: Sequence[str] = HIT_COLUMNS,
    with_input_file: bool = False,
) -> DataFrame:
    """Read hit TSV file(s) into the contract columns (all strings, empty text as NULL).

    ``with_input_file`` adds ``input_file``, the path of each row's file.
    """
    keep = ("input_file",) if with_input_file else ()
    headers = file_headers(spark, path)
    parts, files = [], list(headers)
    for at in range(0, len(files), FILES_A_SCAN):
        parts.append(_scan(spark, {f: headers[f] for f in files[at : at + FILES_A_SCAN]}, columns, with_input_file, multi_line))
    if parts:
        return reduce(DataFrame.unionByName, parts)
    schema = ", ".join(f"`{c}` string" for c in (*columns, *keep))
    return spark.createDataFrame([], schema)


def _scan(spark: SparkSession, headers: dict[str, str], columns: Sequence[str], with_input_file: bool, multi_line: bool) -> DataFrame:
    """Hits of these files, each by its own header, in one scan."""
    text = records(spark, list(headers)) if multi_line else spark.read.text(list(headers))
    if not multi_line and (with_input_file or len(set(headers.values())) > 1):
        text = text.select("value", F.col("_metadata.file_path").alias("input_file"))
    keep = ("input_file",) if with_input_file else ()
    if len(set(headers.values())) == 1:
        line = next(iter(headers.values()))
        names = header_names(line)
        # A byte order mark may stand before the first file's header.
        text = text.where(~F.col("value").isin(line, "\ufeff" + line))
        places, width = {c: F.lit(i) for c, i in _places(names).items()}, F.lit(len(names))
        return _picked(_fields(text, keep), width, places, columns, keep)
    uri = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    rows = []
    for file, line in headers.items():
        names = header_names(line)
        at = _places(names)
        rows.append((uri(file).toUri().toString(), line, len(names), [at.get(c, -1) for c in columns]))
    # At most FILES_A_SCAN rows.
    layout = F.broadcast(spark.createDataFrame(rows, "input_file string, _line string, _width int, _at array<int>"))
    text = text.join(layout, "input_file")
    text = text.where((F.col("value") != F.col("_line")) & (F.col("value") != F.concat(F.lit("\ufeff"), "_line")))
    places = {c: F.nullif(F.col("_at")[i], F.lit(-1)) for i, c in enumerate(columns)}
    return _picked(_fields(text, ("_width", "_at", *keep)), F.col("_width"), places, columns, keep)


def lines_frame(spark: SparkSession, lines: Sequence[str]) -> DataFrame:
    """A DataFrame of lines from a Python list (for small, in-memory inputs)."""
    return spark.createDataFrame([(line,) for line in lines], "value string")


def hits_from_lines(
    lines: DataFrame,
    header: Sequence[str] | None = None,
    *,
    drop_short_rows: bool = True,
    columns: Sequence[str] = HIT_COLUMNS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Parse TSV lines (the first column of ``lines``) into the contract columns.

    Without ``header`` the first line is the header (one row reaches the
    driver); lines equal to it, as at the top of every part file, are skipped.
    Blank lines are skipped; with ``drop_short_rows`` rows with fewer fields
    than the header are dropped; extra fields are ignored. ``keep`` names
    other columns of ``lines`` to pass through.
    """
    text = lines.select(F.col(lines.columns[0]).cast("string").alias("value"), *keep)
    body = text.where(F.col("value") != F.lit(""))
    if header is None:
        first = text.first()
        if first is None or first[0] is None:
            return conform(text.where(F.lit(False)).select(), columns)
        header_line = first[0]
        names = next(csv.reader([header_line], delimiter="\t"), [])
        body = body.where(F.col("value") != F.lit(header_line))
    else:
        names = list(header)
    names = [n.strip() for n in names]
    if not names:
        return conform(body.where(F.lit(False)).select(), columns)
    places, width = {c: F.lit(i) for c, i in _places(names).items()}, F.lit(len(names) if drop_short_rows else 0)
    return _picked(_fields(body, keep), width, places, columns, keep)


def _places(names: Sequence[str]) -> dict[str, int]:
    """Place of each column; of a repeated name the last."""
    return {n: i for i, n in enumerate(names) if n}


def _once(c: Column) -> Column:
    """``c``, worked out once per row.

    The condition is always true, but depends on the task: the optimizer does
    not repeat such a column in the filters and columns that are made of it.
    """
    return F.when(F.spark_partition_id() >= 0, c)


#: A field that begins with a quote and is not one of ``"text without quote or tab"``.
_UNLIKE_PLAIN = r'(?:^|\t)"(?![^"\t]*+"(?:\t|\z))'
#: A field and the tab behind it, where the one before ends: a quoted field and
#: what follows its closing quote, or text that does not begin with a quote.
_FIELD = r'\G("[^"]*+(?:""[^"]*+)*+"(?!")[^\t]*+|(?!")[^\t]*+)\t'
_QUOTE_OPEN = "a line leaves a quote open: a field holds a line break; read the input with multi_line=True"


def _fields(text: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The fields of the lines ``value`` in an array ``_fields``; blank lines are left out."""
    text = text.where(F.col("value") != F.lit(""))
    quoted = F.contains("value", F.lit('"'))
    odd = quoted & F.rlike("value", F.lit(_UNLIKE_PLAIN))
    cut = text.select("value", quoted.alias("_quoted"), _once(odd).alias("_odd"), *keep)
    parsed = F.regexp_extract_all(F.concat("value", F.lit("\t")), F.lit(_FIELD), F.lit(1))
    raw = _once(F.when(F.col("_odd"), parsed).otherwise(F.split("value", "\t", -1)))
    cut = cut.select(raw.alias("_raw"), F.when(F.col("_odd"), F.length("value")).alias("_length"), "_quoted", *keep)
    # A match stops where a quote stays open.
    opens = F.coalesce(F.length(F.array_join("_raw", "\t")) != F.col("_length"), F.lit(False))
    cut = cut.where(F.when(opens, F.raise_error(F.lit(_QUOTE_OPEN)).cast("boolean")).otherwise(F.lit(True)))
    plain = F.when(F.col("_quoted"), F.transform("_raw", _unquoted)).otherwise(F.col("_raw"))
    return cut.select(_once(plain).alias("_fields"), *keep)


def _unquoted(field: Column) -> Column:
    """A field without its quotes; what follows its closing quote is as it stands."""
    behind = F.regexp_extract(field, _QUOTED_THEN_TEXT, 2)
    before = F.replace(F.regexp_extract(field, _QUOTED_THEN_TEXT, 1), F.lit('""'), F.lit('"'))
    return F.when(~field.startswith('"'), field).otherwise(F.concat(before, behind))


_QUOTED_THEN_TEXT = r'(?s)^"([^"]*+(?:""[^"]*+)*+)"(.*)$'


def _picked(rows: DataFrame, width: Column, places: dict[str, Column], columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """The contract columns by their places; rows with fewer fields than ``width`` are dropped."""
    rows = rows.where(F.size("_fields") >= width)
    absent = F.lit(None).cast("string")
    return rows.select(*(_once(F.nullif(F.get("_fields", places[c]), F.lit(""))).alias(c) if c in places else absent.alias(c) for c in columns), *keep)


def read_hits_stream(
    spark: SparkSession,
    path: str,
    *,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Stream of arriving files (path, modificationTime, length): one small row per file, no content.

    The files of a micro-batch are then read with ``read_hits``, each by its
    own header; a stream of rows would need one header for all.
    """
    schema = "path string, modificationTime timestamp, length long, content binary"
    reader = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path).select("path", "modificationTime", "length")


def write_hits_tsv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write hits as TSV part files, each with a header line."""
    df.write.mode(mode).options(**WRITE_OPTIONS).csv(path)


def write_lines(lines: DataFrame, header_line: str, path: str, mode: str = "overwrite") -> None:
    """Write raw lines as part files that each start with ``header_line``.

    The lines are written verbatim (no quoting); used for files whose rows do
    not all have the same number of fields.
    """
    (
        lines.select(F.col(lines.columns[0]).alias(header_line))
        .write.mode(mode)
        .options(header="true", sep="\u0001", quote="", escapeQuotes="false", emptyValue="")
        .options(ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
        .csv(path)
    )


def tsv_field(c: Column) -> Column:
    """A value as one TSV field: quoted (inner quotes doubled) when it holds a quote,
    tab or line break; NULL as empty."""
    quoted = F.concat(F.lit('"'), F.regexp_replace(c, '"', '""'), F.lit('"'))
    return F.when(c.rlike('["\t\r\n]'), quoted).otherwise(F.coalesce(c, F.lit("")))


def tsv_line(*cols: Column) -> Column:
    """Columns joined into one TSV line (no line break)."""
    return F.concat_ws("\t", *[tsv_field(c) for c in cols])
