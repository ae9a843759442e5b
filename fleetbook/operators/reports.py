"""Report lines: one text row per result row, built in one pass.

The printed reports of the rental system are loops that run a lookup query
per row and append a line to an output buffer. Here each is a join or an
aggregate followed by a string expression; ``write_report`` writes the
lines as text if a file is wanted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetbook.functions.scalars import concat_null_as_empty
from fleetbook.operators.queries import overdue_with_user, promo_usage

LINE = "line"

# The texts of the report lines, around their values
OVERDUE_TEXT = ("User ", " ", " ", "  whose email id is ", " has not returned the car with VIN ", ".")
PROMO_TEXT = ("Promo Code ", " has been used ", " times.")


def _around(texts, *values) -> list:
    return [x for pair in zip(texts, values) for x in pair] + [texts[-1]]


def overdue_report(res: DataFrame, users: DataFrame, **overdue_kwargs) -> DataFrame:
    """``User <first> <middle> <last>  whose email id is <email> has not
    returned the car with VIN <vin>.`` for every overdue reservation.
    A missing name part reads as empty text."""
    rows = overdue_with_user(res, users, **overdue_kwargs)
    text = concat_null_as_empty(
        *_around(OVERDUE_TEXT, F.col("fname"), F.col("mname"), F.col("lname"), F.col("email"),
                 F.rtrim(F.col("vin"))))
    return rows.select(F.col("reservation_id"), text.alias(LINE))


def promo_usage_report(offers: DataFrame, res: DataFrame, **kwargs) -> DataFrame:
    """``Promo Code <code> has been used <n> times.`` per offer that is not
    one-time."""
    usage = promo_usage(offers, res, **kwargs)
    code = kwargs.get("code", "promo_code")
    text = concat_null_as_empty(
        *_around(PROMO_TEXT, F.col(code), F.col("times_used").cast("string")))
    return usage.select(F.col(code), text.alias(LINE))


def write_report(lines: DataFrame, path: str) -> None:
    lines.select(LINE).write.mode("overwrite").text(path)
