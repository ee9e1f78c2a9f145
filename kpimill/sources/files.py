"""Readers for delimited feeds, sheet folders and file listings.

Feeds are read as text columns; types are given afterwards. Nothing is read whole into one row, so a large file
is still split over tasks (gzip files excepted, which are one task each by their nature).
"""

from __future__ import annotations

import csv
import datetime as dt
import re
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from kpimill.functions.periods import excel_serial
from kpimill.operators.reshape import last_duplicate_columns
from kpimill.session import materialize

DELIMITERS = (";", ",", "\t", "|")
HEADS_AT_ONCE = 16


def input_files(spark: SparkSession, path: str) -> list[str]:
    """The files that a read of the path would take, named as in ``_metadata.file_path``; only a listing."""
    return sorted(re.sub("^file:///", "file:/", f) for f in spark.read.text(path).inputFiles())


def _head(spark: SparkSession, file: str, lines: int) -> list[str]:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    stream = p.getFileSystem(conf).open(p)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        out = []
        while len(out) < lines and (line := reader.readLine()) is not None:
            out.append(line)
        return out
    finally:
        stream.close()


def file_heads(spark: SparkSession, path: str, lines: int = 1) -> dict[str, list[str]]:
    """The first lines of every file under a path, by its name as in ``_metadata.file_path``; files without lines are left out.

    Only the first block of a file is opened, so this costs a few kilobytes a file, not a pass over the data. Files are
    opened by the driver, many at a time, as it lists them anyway.
    """
    names = input_files(spark, path)
    with ThreadPoolExecutor(HEADS_AT_ONCE) as pool:
        found = pool.map(lambda f: _head(spark, f, lines), names)
        return {name: head for name, head in zip(names, found) if head}


def first_lines(spark: SparkSession, path: str) -> dict[str, str]:
    """First line of every file under a path."""
    return {name: head[0].lstrip("\ufeff") for name, head in file_heads(spark, path).items()}


def header_index(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """(source_file, delimiter, header) of every file, as a table."""
    rows = [(name, sep or detect_delimiter(line), line) for name, line in first_lines(spark, path).items()]
    return spark.createDataFrame(rows, "source_file string, delimiter string, header string")


def header_line(spark: SparkSession, path: str) -> str:
    """First line of a feed."""
    row = spark.read.text(path).first()
    if row is None:
        raise ValueError(f"no lines in {path}")
    return row[0].lstrip("﻿")


def detect_delimiter(line: str) -> str:
    """The delimiter that cuts the header into the most cells."""
    return max(DELIMITERS, key=lambda d: len(next(csv.reader([line], delimiter=d))))


def layouts(spark: SparkSession, path: str, sep: str | None = None) -> dict[tuple[str, str], list[str]]:
    """Files by layout: (delimiter, header line) -> files. A path of one layout is one entry."""
    out: dict[tuple[str, str], list[str]] = {}
    for file, line in sorted(first_lines(spark, path).items()):
        out.setdefault((sep or detect_delimiter(line), line), []).append(file)
    if not out:
        raise ValueError(f"no lines in {path}")
    return out


def _by_layout(spark: SparkSession, path: str, sep: str | None, options: dict[str, str]) -> DataFrame:
    """Files of each layout read with their own delimiter and header; columns are matched by name."""
    out = None
    found = layouts(spark, path, sep)
    for (mark, _), names in found.items():
        reader = spark.read.option("header", True).option("sep", mark).options(**options)
        one = reader.csv(path if len(found) == 1 else [unquote(n) for n in names])
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def read_delimited(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """Delimited text with a header line in every file; delimiter (when not given) and header are those of each file."""
    return _by_layout(spark, path, sep, {})


def read_gz_feed(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """Feed with stray quotes: quoting is off while cells are cut, then every quote is removed. Files may differ in layout."""
    raw = _by_layout(spark, path, sep, {"quote": ""})
    return raw.select(*[F.replace(F.col(f"`{c}`"), F.lit('"'), F.lit("")).alias(c.replace('"', "")) for c in raw.columns])


def sheet_names(spark: SparkSession, root: str) -> list[str]:
    """Names of the ``sheet=<name>`` folders under a workbook folder."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(root)
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop)
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    folders = [s.getPath().getName() for s in found if s.isDirectory()]
    return sorted(names.unescapePathName(f[len("sheet="):]) for f in folders if f.startswith("sheet="))


def _sheet_path(spark: SparkSession, root: str, name: str) -> str:
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return f"{root}/{names.getPartitionPathString('sheet', name)}"


def read_sheets(
    spark: SparkSession, root: str, wanted: list[str] | None = None, label: str = "sheet", distinct: bool = False
) -> DataFrame:
    """All sheets of a workbook folder, stacked, with the sheet's name as a column.

    Sheets may differ in columns; wanted sheets that are absent are left out. ``distinct`` drops repeated rows.
    """
    here = sheet_names(spark, root)
    use = here if wanted is None else [w for w in wanted if w in here]
    if not use:
        raise ValueError(f"none of the sheets {wanted} in {root}")
    out = None
    for name in use:
        path = _sheet_path(spark, root, name)
        one = _by_layout(spark, path, ",", {}).withColumn(label, F.lit(name))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out.distinct() if distinct else out


def _sheet_number(col: str, sheet: str) -> Column:
    """A number cell: null where it is empty; one that is filled but no number stops the read, with its text."""
    text = F.trim(F.col(f"`{col}`"))
    number = text.try_cast("double")
    bad = F.concat(F.lit(f"no number in column {col} of sheet {sheet}: "), text)
    return F.when((text != "") & number.isNull(), F.raise_error(bad)).otherwise(number)


def read_typed_sheets(spark: SparkSession, root: str, sheets: dict[str, tuple[str, ...]], numbers: set[str]) -> DataFrame:
    """Known sheets with known columns; rows with an empty cell are dropped, absent sheets skipped.

    A number cell that holds anything else than a number is an error that names the cell's text: no row is lost because a
    cell could not be read.
    """
    here = set(sheet_names(spark, root))
    out = None
    for name, cols in sheets.items():
        if name not in here:
            continue
        schema = T.StructType([T.StructField(c, T.StringType()) for c in cols])
        path = _sheet_path(spark, root, name)
        one = spark.read.option("header", True).schema(schema).csv(path)
        one = one.withColumns({c: _sheet_number(c, name) for c in cols if c in numbers}).dropna()
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    if out is None:
        raise ValueError(f"none of the sheets {list(sheets)} in {root}")
    return out


def read_last_duplicates(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """Of every repeated header the last column; headers that occur once are dropped."""
    names = next(csv.reader([header_line(spark, path)], delimiter=sep))
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    raw = spark.read.schema(schema).option("header", True).option("sep", sep).csv(path)
    return raw.select(*[F.col(f"c{i}").alias(n) for i, n in last_duplicate_columns(names).items()])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file and their place in it, as one sortable number: the start of their split, then a running number
    inside the split."""
    inside = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    start = F.col("_metadata.file_block_start").cast("decimal(20,0)")
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("source_file"),
        (start * F.lit(1 << 33).cast("decimal(18,0)") + inside.cast("decimal(18,0)")).cast("decimal(38,0)").alias("at"),
        "value",
    )


def _first_by_place(lines: DataFrame, by: list[str], wanted: Column) -> DataFrame:
    """Per file the first of the wanted lines, in one pass: they are few, so they are aggregated whole."""
    return lines.where(wanted).groupBy(*by).agg(F.min(F.struct("at", "value")).alias("__first")).select(*by, "__first.at", "__first.value")


def report_months(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """Report month of each file: its first cell is a spreadsheet day number. A file without one is an error."""
    heads = spark.createDataFrame(list(first_lines(spark, path).items()), "source_file string, value string")
    days = F.expr(f"try_cast(try_cast(split_part(value, '{sep}', 1) AS DOUBLE) AS INT)")
    months = heads.select("source_file", excel_serial(days).alias("report_month"))
    missing = [r[0] for r in months.where("report_month IS NULL").limit(5).collect()]
    if missing:
        raise ValueError(f"no report month in {missing}")
    return months


def find_header(spark: SparkSession, path: str, marker: str, sep: str = ";") -> DataFrame:
    """Tables whose header is not the first line: it is the first line whose first cell is the marker.

    Lines keep their place by one number per line, so files are read in parallel splits: once for the header lines, once
    for the data. Files may differ in layout; columns are matched by name. A file without the marker is an error.
    """
    lines = _lines(spark, path)
    first_cell = F.trim(F.get(F.split("value", f"\\Q{sep}\\E", 2), F.lit(0)))
    is_header = F.replace(first_cell, F.lit('"'), F.lit("")) == marker
    headers = _first_by_place(lines, ["source_file"], is_header)
    headers = materialize(headers.select("source_file", F.col("at").alias("h_at"), F.col("value").alias("layout")), "headers")
    known = {r[0] for r in headers.select("source_file").collect()}
    missing = sorted(set(file_heads(spark, path)) - known)
    if missing:
        raise ValueError(f"no header starting with {marker!r} in {missing[:5]}")
    # distinct layouts, not files
    found = [r[0] for r in headers.select("layout").distinct().orderBy("layout").collect()]
    cells = [[c.strip() for c in next(csv.reader([v], delimiter=sep))] for v in found]
    names = list(dict.fromkeys(n for row in cells for n in row if n))
    width = max(len(r) for r in cells)
    schema = ", ".join(f"c{i} string" for i in range(width))
    body = (
        lines.join(headers, "source_file")
        .where((F.col("at") > F.col("h_at")) & (F.trim("value") != ""))
        .select("source_file", "layout", F.from_csv("value", schema, {"sep": sep}).alias("r"))
    )

    def pick(name: str):
        at = {v: row.index(name) for v, row in zip(found, cells) if name in row}
        value = F.lit(None).cast("string")
        for v, i in at.items():
            value = F.when(F.col("layout") == v, F.col(f"r.c{i}")).otherwise(value)
        return value.alias(name)

    return body.select("source_file", *[pick(n) for n in names])


def list_files(
    spark: SparkSession, path: str, glob: str | None = None, since: dt.datetime | None = None, recursive: bool = False
) -> DataFrame:
    """Name and modification time of files, without reading them."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if since:
        reader = reader.option("modifiedAfter", since.strftime("%Y-%m-%dT%H:%M:%S"))
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    files = reader.load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "path", "length",
                        F.col("modificationTime").alias("modified_at"))


def latest_file(files: DataFrame) -> DataFrame:
    """The newest file of a listing."""
    return files.orderBy(F.col("modified_at").desc(), F.col("path").desc()).limit(1)
