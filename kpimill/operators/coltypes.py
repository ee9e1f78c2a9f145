"""Column types: inference, coercion, date-format detection, rule checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kpimill.functions import fixed_values as fv
from kpimill.functions.text import CENTURY_PIVOT, proper_name, read_date_sql, read_number_sql, sql_text as _q
from kpimill.session import materialize


GROUP = 40  # columns that are profiled by one aggregation; more would outgrow what is compiled as one method


def profile(df: DataFrame, formats=fv.UPLOAD_DATE_FORMATS, group: int = GROUP) -> DataFrame:
    """One row per column with the counts that type inference needs, from one pass over the rows.

    Wide tables are cut into groups of columns: a row becomes one row per group, with as many texts as a group has
    columns, and all groups go through one aggregation of that many profiles, combined before the shuffle.
    """
    columns = df.columns
    width = min(group, len(columns))
    parts = [columns[i : i + width] for i in range(0, len(columns), width)]
    text = lambda c: f"CAST(`{c}` AS STRING)" if c is not None else "CAST(NULL AS STRING)"
    if len(parts) == 1:
        cells = df.selectExpr("0 AS part", *[f"{text(c)} AS t{i}" for i, c in enumerate(columns)])
    else:
        padded = [part + [None] * (width - len(part)) for part in parts]
        structs = [f"named_struct('part', {k}, {', '.join(f"'t{i}', {text(c)}" for i, c in enumerate(part))})" for k, part in enumerate(padded)]
        cells = df.selectExpr(f"inline(array({', '.join(structs)}))")
    # texts and numbers are made once per row, then aggregated
    cells = cells.selectExpr("*", *[f"{read_number_sql(f't{i}')} AS n{i}" for i in range(width)])
    stats = []
    for i in range(width):
        dates = ", ".join(f"count({read_date_sql(f't{i}', f)})" for f in formats)
        stats.append(
            f"named_struct('slot', {i}, 'filled', count(t{i}), "
            f"'dates', array({dates}), 'numbers', count(n{i}), "
            f"'integral', count(CASE WHEN n{i} = floor(n{i}) THEN 1 END), 'top', max(n{i}), "
            f"'width', CAST(coalesce(max(length(coalesce(t{i}, 'nan'))), 0) AS INT)) AS s{i}"
        )
    grouped = cells.groupBy("part").agg(*map(F.expr, stats)) if len(parts) > 1 else cells.agg(F.lit(0).alias("part"), *map(F.expr, stats))
    rows = grouped.selectExpr("part", f"inline(array({', '.join(f's{i}' for i in range(width))}))")
    named = ", ".join(f"named_struct('column', {_q(c)}, 'name', {_q(proper_name(c))})" for c in columns)
    place = f"part * {width} + slot"
    known = rows.where(f"{place} < {len(columns)}").selectExpr(f"element_at(array({named}), {place} + 1) AS c", "*")
    out = known.selectExpr("c.column", "c.name", "filled", "dates", "numbers", "integral", "top", "width")
    if len(parts) == 1:
        return out
    # without rows there are no groups: every column is there all the same
    empty = f"inline(array({named}))"
    every = df.sparkSession.range(1).selectExpr(empty).withColumnsRenamed({"column": "__column", "name": "__name"})
    zero = "CAST(0 AS BIGINT)"
    return every.join(out, F.col("__column") == F.col("column"), "left").selectExpr(
        "__column AS `column`", "__name AS name", f"coalesce(filled, {zero}) AS filled", f"coalesce(dates, array_repeat({zero}, {len(formats)})) AS dates",
        f"coalesce(numbers, {zero}) AS numbers", f"coalesce(integral, {zero}) AS integral", "top", "coalesce(width, 0) AS width")


def infer_types(df: DataFrame, formats=fv.UPLOAD_DATE_FORMATS) -> DataFrame:
    """Proposed warehouse type per column.

    Date when one format reads every filled value; phone numbers stay text; then numbers (integral or not, by
    size); else text by its longest value, an empty cell counting as three characters. A column without any
    value is an integer.
    """
    steps = " ".join(f"WHEN width <= {w} THEN 'VARCHAR({w})'" for w in fv.VARCHAR_STEPS)
    rule = f"""CASE
        WHEN filled > 0 AND array_contains(dates, filled) THEN 'DATE'
        WHEN contains(name, 'MSISDN') THEN 'VARCHAR(11)'
        WHEN numbers = filled AND integral = filled THEN
          CASE WHEN contains(name, 'SUBS_ID') THEN 'DECIMAL(12,0)' WHEN top > 2147483647 THEN 'BIGINT' ELSE 'INTEGER' END
        WHEN numbers = filled THEN 'FLOAT'
        {steps} ELSE 'LONG VARCHAR' END"""
    return profile(df, formats).selectExpr("`column`", "name AS column_name", f"{rule} AS dtype")


def _read_chosen(text: str, chosen: str, formats) -> str:
    """SQL that reads a text in the format with the chosen number, which is known to fit: no shape test is made."""
    return f"CASE {chosen} " + " ".join(f"WHEN {i} THEN try_to_date({text}, {_q(f)})" for i, f in enumerate(formats)) + " END"


def parse_dates(
    df: DataFrame, col: str, formats, by: list[str], out: str = "parsed_date", month: str | None = None
) -> DataFrame:
    """Parse a text date with the first format that reads *all* filled values of its file.

    The format is chosen per file by one aggregation; a file no single format can read gets NULL dates, so
    it can be rejected. ``month`` adds the file's report month: the month of its first date. The table of
    formats has one row per file.
    """
    reads = [read_date_sql("__text", f) for f in formats]
    tries = " ".join(f"WHEN count(__d{i}) = count(__text) THEN {i}" for i in range(len(reads)))
    first = f"array({', '.join(f'min(__d{i})' for i in range(len(reads)))})"
    files = [f"__f{i}" for i in range(len(by))]
    # dates repeat: every distinct text of a file is parsed once, in all formats
    texts = df.selectExpr(*[f"`{c}` AS {f}" for c, f in zip(by, files)], f"`{col}` AS __text").distinct()
    parsed = texts.selectExpr("*", *[f"{r} AS __d{i}" for i, r in enumerate(reads)])
    chosen = parsed.groupBy(*files).agg(F.expr(f"CASE {tries} END AS __fmt"), F.expr(f"{first} AS __first"))
    chosen = chosen.withColumn("__month", F.expr("trunc(get(__first, __fmt), 'month')")).drop("__first")
    chosen = materialize(chosen, "date-formats")
    joined = df.join(chosen, [F.equal_null(F.col(c), F.col(f)) for c, f in zip(by, files)], "left")
    joined = joined.withColumn(out, F.expr(_read_chosen(col, "__fmt", formats)))
    short = [str(i) for i, f in enumerate(formats) if "yyyy" not in f]
    if short:
        this_century = f"__fmt IN ({', '.join(short)}) AND year({out}) >= {CENTURY_PIVOT}"
        joined = joined.withColumn(out, F.expr(f"CASE WHEN {this_century} THEN add_months({out}, -1200) ELSE {out} END"))
    if month:
        joined = joined.withColumn(month, F.col("__month"))
    return joined.drop("__fmt", "__month", *files)


def coerce(df: DataFrame, codes: dict[str, str], formats=fv.UPLOAD_DATE_FORMATS) -> DataFrame:
    """Cast columns by warehouse type code; text that does not fit becomes NULL.

    Dates take the first format that reads every filled value of the column; the choice is one value per
    column, looked up inside the same plan.
    """
    date_cols = [c for c, code in codes.items() if code == "DA"]
    picks = []
    for c in date_cols:
        text = f"CAST(`{c}` AS STRING)"
        cases = " ".join(
            f"WHEN count({read_date_sql(text, f)}) = count(`{c}`) THEN {i}" for i, f in enumerate(formats)
        )
        picks.append(f"CASE {cases} END")
    chosen = df.selectExpr(f"array({', '.join(picks)}) AS f").scalar() if date_cols else None
    if date_cols:
        df = df.withColumn("__fmt", chosen)

    def value(c: str) -> Column:
        code = codes.get(c)
        if code is None:
            return F.col(f"`{c}`")
        text = f"CAST(`{c}` AS STRING)"
        if code == "DA":
            reads = " ".join(
                f"WHEN {i} THEN {read_date_sql(text, f)}" for i, f in enumerate(formats)
            )
            return F.expr(f"CASE get(__fmt, {date_cols.index(c)}) {reads} END").alias(c)
        if code == "TS":
            read = f"try_to_timestamp({text}, {_q(fv.UPLOAD_TIMESTAMP_FORMAT)})"
            return F.expr(f"CAST({read} AS TIMESTAMP_NTZ)").alias(c)
        if code in ("I", "I8"):
            return F.expr(f"try_cast(try_cast(trim({text}) AS DOUBLE) AS {fv.TYPE_CODES[code]})").alias(c)
        if code == "CV":
            return F.expr(text).alias(c)
        number = f"try_cast(trim({text}) AS {fv.TYPE_CODES[code]})"
        return F.expr(f"nullif({number}, double('NaN'))" if code == "F" else number).alias(c)

    return df.select(*[value(c) for c in df.columns if c != "__fmt"])


def check_rules(
    df: DataFrame,
    key: list[str],
    pattern: dict[str, str] | None = None,
    required: list[str] | None = None,
    blocked: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Violation counts per rule: pattern mismatch, missing value, blocked value, duplicate key.

    The row rules are one aggregation; duplicates are counted from per-key counts, combined map-side.
    """
    rules = [(f"pattern:{c}", f"count(CASE WHEN NOT regexp_like({c}, {_q(p)}) THEN 1 END)")
             for c, p in (pattern or {}).items()]
    rules += [(f"required:{c}", f"count(CASE WHEN {c} IS NULL THEN 1 END)") for c in required or []]
    parts = []
    if rules:
        rows = ", ".join(f"named_struct('rule', {_q(n)}, 'violations', {e})" for n, e in rules)
        parts.append(df.selectExpr(f"array({rows}) AS r").selectExpr("inline(r)"))
    for c, values in (blocked or {}).items():
        listed = values.select(F.upper(values.columns[0]).alias("__v")).distinct()
        hits = df.groupBy(F.upper(c).alias("__u")).agg(F.count(F.lit(1)).alias("n"))
        hits = hits.join(listed, F.col("__u") == F.col("__v"), "left_semi")
        parts.append(hits.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))
                     .select(F.lit(f"blocked:{c}").alias("rule"), "violations"))
    dup = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts.append(dup.agg(F.count(F.lit(1)).alias("violations"))
                 .select(F.lit(f"unique:{','.join(key)}").alias("rule"), "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
