"""Cleaning of vendor text cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts that mean "no value".
NULL_TOKENS = ["#N/A", "--", "#N/A Requesting Data...", "N/A", "", "NaN", "nan", "NULL", "None", "n/a"]

# A plain decimal number; a cast alone would also take 12f, 1d, 0x1p3 and Infinity.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

# The time of a date-time text.
CLOCK = r"[ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?$"

# The date formats, each with the shape of the texts it applies to.
# With slashes month-first wins over day-first, with dashes day-first wins. The
# shapes settle that by the size of the month part, so a text is parsed once and
# no parse fails just because another format comes next.
_MONTH = r"(0?[1-9]|1[0-2])"
DATE_FORMATS = [
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (rf"^{_MONTH}/\d{{1,2}}/\d{{4}}$", "M/d/yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (rf"^\d{{1,2}}-{_MONTH}-\d{{4}}$", "d-M-yyyy"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "M-d-yyyy"),
]

# Keyword groups in order; the first group with a hit names the category.
CATEGORY_KEYWORDS = [
    ("GDP", ["gdp"]),
    ("CPI", ["cpi", "price", "inflation"]),
    ("Employment", ["unemploy", "employ"]),
    ("Housing", ["housing", "construction"]),
    ("Rates", ["rate", "yield"]),
    ("Trade", ["trade", "export", "import"]),
]


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def null_if_token(col: Column | str) -> Column:
    """Trimmed text, NULL for every no-value token."""
    text = F.trim(_c(col))
    return F.when(~text.isin(NULL_TOKENS), text)


def to_number(col: Column | str) -> Column:
    """Number from text with thousands commas; NULL for tokens and unparsable text."""
    text = F.regexp_replace(null_if_token(col), ",", "")
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def to_date(col: Column | str) -> Column:
    """Date from six formats, else NULL; the time of a date-time is left out."""
    text, out = F.regexp_replace(F.trim(_c(col)), CLOCK, ""), None
    for shape, fmt in DATE_FORMATS:
        test, parsed = text.rlike(shape), F.try_to_date(text, fmt)
        out = F.when(test, parsed) if out is None else out.when(test, parsed)
    return out


def is_reject(raw: Column | str, parsed: Column) -> Column:
    """A raw text that carries a value but could not be parsed."""
    return null_if_token(raw).isNotNull() & parsed.isNull()


def category(name: Column | str) -> Column:
    """Indicator category from keywords in its name, first match wins."""
    text, out = F.lower(_c(name)), None
    for label, words in CATEGORY_KEYWORDS:
        test = text.contains(words[0])
        for word in words[1:]:
            test = test | text.contains(word)
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out.otherwise(F.lit("Other"))


def country_code(col: Column | str) -> Column:
    return F.substring(_c(col), 1, 2)


def trim_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip() for name in df.columns])


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim every string column and every column name."""
    df = trim_names(df)
    return df.select(*[
        F.trim(F.col(f"`{name}`")).alias(name) if kind == "string" else F.col(f"`{name}`")
        for name, kind in df.dtypes
    ])


def resolve_column(df: DataFrame, *names: str) -> str:
    """First of the alternative column names that is present."""
    for name in names:
        if name in df.columns:
            return name
    raise ValueError(f"none of {list(names)} among columns {df.columns}")


def keep_known(df: DataFrame, known: list[str], required: list[str]) -> DataFrame:
    """Known columns that are present, in the given order; a missing required one is an error."""
    missing = [name for name in required if name not in df.columns]
    if missing:
        raise ValueError(f"missing column(s) {missing}, got {df.columns}")
    return df.select(*[name for name in known if name in df.columns])
