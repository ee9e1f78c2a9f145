"""Text and number clean-up as Column expressions; no Python runs per row."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from kpimill.functions import fixed_values as fv


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(col: Column | str, decimal: str = ".", thousands: str | None = None, type_: str = "double") -> Column:
    """Number from text with a given decimal mark and thousands mark; NULL when it is not a number."""
    text = F.trim(_col(col).cast("string"))
    if thousands:
        text = F.replace(text, F.lit(thousands), F.lit(""))
    if decimal != ".":
        text = F.replace(text, F.lit(decimal), F.lit("."))
    number = text.try_cast(type_)
    return nan_to_null(number) if type_ == "double" else number


def sql_text(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


CENTURY_PIVOT = 2069  # two-digit years read as this year or later belong to the century before

_DATE_PART = re.compile("yyyy|yy|[dMHms]")
_PART_SHAPE = {"yyyy": r"\d{4}", "yy": r"\d{2}"}


def read_date_sql(text: str, fmt: str) -> str:
    """SQL that reads a date in one format, else NULL.

    The shape is tested first, from the cheapest test on: a failed parse raises inside the parser, which costs
    far more. Two-digit years 69 to 99 are 1969 to 1999.
    """
    shape, pos, least, most = "", 0, 0, 0
    for m in _DATE_PART.finditer(fmt):
        mark = fmt[pos:m.start()]
        shape += re.escape(mark) + _PART_SHAPE.get(m.group(), r"\d{1,2}")
        least += len(mark) + len(m.group())
        most += len(mark) + max(len(m.group()), 2)
        pos = m.end()
    sep = sql_text(re.sub("[A-Za-z]", "", fmt)[0])
    read = f"try_to_date({text}, {sql_text(fmt)})"
    if "yyyy" not in fmt:
        read = f"CASE WHEN year({read}) >= {CENTURY_PIVOT} THEN add_months({read}, -1200) ELSE {read} END"
    fits = f"length({text}) BETWEEN {least} AND {most} AND contains({text}, {sep}) AND {text} RLIKE {sql_text(f'^{shape}$')}"
    return f"CASE WHEN {fits} THEN {read} END"


_NUMBER_SHAPE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def read_number_sql(text: str) -> str:
    """SQL that reads a double, else NULL; the shape is tested first for the same reason."""
    return f"CASE WHEN {text} RLIKE {sql_text(_NUMBER_SHAPE)} THEN try_cast({text} AS DOUBLE) END"


def blank_to_null(col: Column | str) -> Column:
    return F.nullif(_col(col), F.lit(""))


def nan_to_null(col: Column | str) -> Column:
    """Not-a-number means missing."""
    return F.nullif(_col(col), F.lit(float("nan")))


def extract(col: Column | str, pattern: str, group: int) -> Column:
    """Regex group, or NULL when the pattern does not match."""
    return F.nullif(F.regexp_extract(_col(col), pattern, group), F.lit(""))


def or_unknown(col: Column | str, matched: Column | str, default: str = "Unknown") -> Column:
    """Empty values of *matched* lookup rows get the default; unmatched rows stay NULL."""
    c = _col(col)
    return F.when(_col(matched) & (c.isNull() | (c == "")), F.lit(default)).otherwise(c)


def first_word(name: Column | str) -> Column:
    return F.split_part(_col(name), F.lit(" "), F.lit(1))


def first_code(codes: Column | str) -> Column:
    """First code of a comma list without the dial-out prefix, wherever it stands."""
    return F.replace(F.get(F.split(_col(codes), ","), F.lit(0)), F.lit(fv.DIAL_OUT_PREFIX), F.lit(""))


def split_route(route: Column | str, sep: str = " to ") -> tuple[Column, Column]:
    """``A to B`` -> trimmed A and B; B is NULL when there is no separator."""
    parts = F.split(_col(route), re.escape(sep), 2)
    return F.trim(F.get(parts, F.lit(0))), F.trim(F.get(parts, F.lit(1)))


# Latin spelling of Cyrillic letters that take one Latin letter, pairwise in alphabet order.
_CYR_SINGLE = "абвгдезийклмнопрстуфхыэАБВГДЕЗИЙКЛМНОПРСТУФХЫЭ"
_LAT_SINGLE = "abvgdezijklmnoprstufhyeABVGDEZIJKLMNOPRSTUFHYE"
# Letters that take several Latin letters or a sign, in alphabet order.
_CYR_MULTI = {
    "ё": "e", "ж": "zh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "sch", "ъ": "'", "ь": "'", "ю": "ju", "я": "ja",
    "Ё": "E", "Ж": "Zh", "Ц": "Ts", "Ч": "Ch", "Ш": "Sh", "Щ": "Sch", "Ъ": "'", "Ь": "'", "Ю": "Ju", "Я": "Ja",
}


def proper_name(name: str) -> str:
    """Column-name normaliser: Latin letters, blanks to underscores, nothing else, upper case."""
    table = str.maketrans({**dict(zip(_CYR_SINGLE, _LAT_SINGLE)), **_CYR_MULTI})
    latin = re.sub(r"\s", "_", name.translate(table))
    return re.sub(r"[^0-9a-zA-Z_]+", "", latin).upper()


def proper_name_col(col: Column | str) -> Column:
    """The same rule for values of a column."""
    out = F.translate(_col(col), _CYR_SINGLE, _LAT_SINGLE)
    for cyr, lat in _CYR_MULTI.items():
        out = F.replace(out, F.lit(cyr), F.lit(lat))
    out = F.regexp_replace(out, r"\s", "_")
    return F.upper(F.regexp_replace(out, "[^0-9a-zA-Z_]+", ""))
