"""Column expressions shared by the operators.

All are built-in ``pyspark.sql.functions`` compositions, so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str

CENT = Decimal("0.01")


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dec_lit(value) -> Column:
    """An exact decimal literal; a Python float would turn the arithmetic
    into double."""
    d = value if isinstance(value, Decimal) else Decimal(str(value))
    return F.lit(d)


def money(c: ColumnOrName, precision: int = 12, scale: int = 2) -> Column:
    """Cast to a fixed-point amount. Casting a decimal rounds half up."""
    return col(c).cast(T.DecimalType(precision, scale))


def days_between(end: ColumnOrName, start: ColumnOrName) -> Column:
    """Whole days from ``start`` to ``end``; NULL in, NULL out."""
    return F.datediff(col(end), col(start))


def concat_null_as_empty(*parts: ColumnOrName) -> Column:
    """String concatenation that reads NULL as the empty string.

    Spark's ``concat`` returns NULL if any input is NULL; the report texts
    of the rental system treat a missing middle name as empty instead.
    Strings given as plain ``str`` are literals here, not column names.
    """
    cols = [F.lit(p) if isinstance(p, str) else p for p in parts]
    return F.concat(*[F.coalesce(c.cast("string"), F.lit("")) for c in cols])


# Date-format elements and their Spark datetime equivalents.
_ORACLE_ELEMENTS = [
    ("YYYY", "yyyy"), ("RRRR", "yyyy"), ("YY", "yy"), ("RR", "yy"),
    ("MONTH", "MMMM"), ("MON", "MMM"), ("MM", "MM"),
    ("DDD", "DDD"), ("DD", "dd"), ("DY", "EEE"), ("DAY", "EEEE"),
    ("HH24", "HH"), ("HH12", "hh"), ("HH", "hh"), ("MI", "mm"), ("SS", "ss"),
    ("AM", "a"), ("PM", "a"),
]


def oracle_pattern(fmt: str) -> str:
    """Translate a ``TO_DATE`` format into a Spark datetime pattern.

    Elements are case-insensitive in the source format: ``mm`` is the month
    and ``mi`` the minute, whereas in Spark ``mm`` is the minute. Text in
    double quotes is kept literally.
    """
    out: list[str] = []
    i = 0
    while i < len(fmt):
        ch = fmt[i]
        if ch == '"':
            j = fmt.index('"', i + 1)
            out.append("'" + fmt[i + 1:j].replace("'", "''") + "'")
            i = j + 1
            continue
        for src, dst in _ORACLE_ELEMENTS:
            if fmt[i:i + len(src)].upper() == src:
                out.append(dst)
                i += len(src)
                break
        else:
            out.append("'" + ch + "'" if ch.isalpha() else ch)
            i += 1
    return "".join(out)


def parse_date(c: ColumnOrName, fmt: str | None = None, dialect: str = "oracle") -> Column:
    """Text to date. ``fmt=None`` parses ISO ``yyyy-MM-dd`` (the implicit
    string-to-DATE conversion)."""
    if fmt is None:
        return col(c).cast(T.DateType())
    pattern = oracle_pattern(fmt) if dialect == "oracle" else fmt
    return F.to_date(col(c), pattern)


def format_date(c: ColumnOrName, fmt: str, dialect: str = "oracle") -> Column:
    pattern = oracle_pattern(fmt) if dialect == "oracle" else fmt
    return F.date_format(col(c), pattern)


def round_to_int(c: ColumnOrName) -> Column:
    """Store an amount in an integer column: round half up, then narrow.
    A bare cast would truncate 129.65 to 129."""
    return F.round(col(c), 0).cast(T.IntegerType())


def char_pad(c: ColumnOrName, n: int) -> Column:
    """Blank-pad to ``CHAR(n)`` width. Longer values are left whole (they
    violate the length rule, which ``check_length`` reports)."""
    x = col(c)
    return F.when(F.length(x) < n, F.rpad(x, n, " ")).otherwise(x)


def char_equal(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Blank-padded comparison: trailing blanks do not count."""
    return F.rtrim(col(a)) == F.rtrim(col(b))


def percent_increase(c: ColumnOrName, percentage) -> Column:
    """``p + p * percentage / 100`` in exact decimal arithmetic."""
    p = col(c)
    pct = percentage if isinstance(percentage, Column) else dec_lit(percentage)
    return p + p * pct * dec_lit(CENT)


def percent_discount(c: ColumnOrName, percentage: ColumnOrName) -> Column:
    """``t - (percentage / 100) * t``."""
    t = col(c)
    return t - t * col(percentage) * dec_lit(CENT)

