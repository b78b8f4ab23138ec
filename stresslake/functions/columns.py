"""Scalar building blocks shared by the operators.

Spark 4 runs in ANSI mode: plain casts raise on bad text. Everything that meets
raw data here uses the ``try_`` forms, so bad text becomes NULL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A decimal number with optional exponent, or an infinity. Possessive quantifiers
# keep the match linear: there is one way only to read a number.
NUMBER_PATTERN = (
    r"^[+-]?+(?:(?:[0-9]++\.?+[0-9]*+|\.[0-9]++)(?:[eE][+-]?+[0-9]++)?+|(?i:inf(?:inity)?+))$"
)


def one_of_type(value, dtype: T.DataType) -> Column:
    """A literal in the type of another column, so coalesce keeps decimals."""
    return F.lit(value).cast(dtype)


def is_number(col: Column) -> Column:
    return F.trim(col).rlike(NUMBER_PATTERN)


def as_number(col: Column) -> Column:
    """Text to double; anything that is not a plain number gives NULL."""
    return F.when(is_number(col), F.trim(col).try_cast("double"))


def as_timestamp(col: Column) -> Column:
    """Text to timestamp: ``yyyy-MM-dd``, with ``HH:mm:ss``, or the ISO ``T`` form."""
    text = F.trim(col)
    return F.when(text.contains("-"), F.try_to_timestamp(text))


def as_date(col: Column, dtype: T.DataType) -> Column:
    """Date of a string, date or timestamp column; bad text gives NULL."""
    if isinstance(dtype, T.StringType):
        return as_timestamp(col).cast("date")
    return F.to_date(col)


WHOLE, FRACTION, TIMED, MIDNIGHT, WORDS = range(5)


def text_kind(col: Column) -> Column:
    """What a text value reads as; NULL stays NULL.

    ``WHOLE`` or ``FRACTION`` for numbers, ``MIDNIGHT`` for a plain date or a timestamp at
    0:00:00, ``TIMED`` for other timestamps, else ``WORDS``. What looks like ``____-__-__``
    is no number and has no time of day, so it is neither matched nor formatted. A value
    is parsed once, and no parse fails by exception on the numbers and words that fill
    most columns.
    """
    text, time = F.trim(col), as_timestamp(col)
    plain = (F.length(text) == 10) & (text.substr(5, 1) == "-") & (text.substr(8, 1) == "-")
    day = F.when(time.isNotNull(), MIDNIGHT).otherwise(WORDS)
    marks = [text.contains(m) for m in (".", "e", "E", "n", "N")]
    number = F.when(reduce(lambda a, b: a | b, marks), FRACTION).otherwise(WHOLE)
    at_midnight = F.date_format(time, "HHmmss") == "000000"
    other = F.coalesce(at_midnight.cast("int") + TIMED, F.lit(WORDS))
    found = F.when(plain, day).when(is_number(col), number).otherwise(other)
    return F.when(col.isNotNull(), found)


def percent(part: Column, whole: Column) -> Column:
    """``part / whole`` in percent, two decimals, half up; 0 when ``whole`` is 0.

    Integer arithmetic, so that the result does not hang on binary rounding.
    """
    part, whole = part.cast("bigint"), whole.cast("bigint")
    hundredths = F.call_function("div", part * 20000 + whole, whole * 2)
    return F.when(whole > 0, hundredths / F.lit(100.0)).otherwise(F.lit(0.0))


def stress_level(factor: Column) -> Column:
    """HIGH from 1.5, MEDIUM from 1.2, else LOW (a NULL factor is LOW too)."""
    return (
        F.when(factor >= F.lit(1.5), "HIGH").when(factor >= F.lit(1.2), "MEDIUM").otherwise("LOW")
    )


def total(cols: list[Column]) -> Column:
    """Sum of columns inside a row; 0 for no columns."""
    return reduce(lambda a, b: a + b, cols, F.lit(0).cast("bigint"))


def exact_product(left: Column, left_type: T.DataType, right: Column, right_type: T.DataType) -> Column:
    """``left * right``, keeping all decimals of a sum.

    ``sum`` widens a decimal to 38 digits, and a product of that width would have
    to drop decimals. The sum is narrowed to 37 digits less those of the right side,
    which leaves the product exact; a larger value raises instead of being rounded.
    """
    if isinstance(left_type, T.DecimalType) and isinstance(right_type, T.DecimalType):
        left = left.cast(T.DecimalType(37 - right_type.precision, left_type.scale))
    return left * right


def literal_frame(spark: SparkSession, rows: Column) -> DataFrame:
    """A small frame from a literal array of structs.

    It stays an expression of the plan, with a size the optimizer can see, where a
    frame made from local objects would be an opaque input.
    """
    return spark.range(0, 1, 1, 1).select(F.inline(rows))
