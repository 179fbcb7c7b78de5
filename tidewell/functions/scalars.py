"""Column helpers shared by the operators. All are built-in expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Nine fraction digits hold every epoch text a chat export writes.
EPOCH_TYPE = T.DecimalType(28, 9)
# The same, and two more digits for the number of fraction digits in the text.
_KEY_TYPE = T.DecimalType(30, 11)
_EPOCH = "^[0-9]{1,18}([.][0-9]{0,9})?$"


def _is_epoch(text: Column) -> Column:
    """Up to 18 digits, and up to nine more after a point: the one rule of what is a time."""
    return text.rlike(_EPOCH)


def epoch(text: Column) -> Column:
    """Epoch-second text as a number, so that ``"999.5" < "1000.25"``; null for anything else."""
    return F.when(_is_epoch(text), text.try_cast(EPOCH_TYPE))


def epoch_key(text: Column) -> Column:
    """One number that orders like :func:`epoch` and still tells the text it came from.

    Nine fraction digits, then the number of them the text had. Aggregates over it run as
    hash aggregates; over the text or a struct they would sort. What :func:`epoch` does not
    take gives null.
    """
    dot = F.instr(text, ".")
    dotted = F.when(dot > 0, text).otherwise(F.concat(text, F.lit(".")))
    places = EPOCH_TYPE.scale
    point = F.instr(dotted, ".")
    digits = F.length(dotted) - point
    padded = F.concat(F.rpad(dotted, point + places, "0"), F.lit("0"), digits.cast("string"))
    return F.when(_is_epoch(text), padded.try_cast(_KEY_TYPE))


def epoch_text(key: Column) -> Column:
    """The text an :func:`epoch_key` was made from."""
    units = (key * F.lit(Decimal("1E11"))).cast("decimal(38,0)")
    digits = (units % 100).cast("int")
    whole = F.floor(key).cast("bigint")
    fraction = F.lpad(F.floor((key - whole) * F.lit(Decimal("1E9"))).cast("bigint").cast("string"), 9, "0")
    dotted = F.concat(whole.cast("string"), F.lit("."), fraction.substr(F.lit(1), digits))
    return F.when(digits > 0, dotted).otherwise(whole.cast("string"))


def or_blank(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def list_size(value: Column) -> Column:
    """Length of a list, 0 when it is absent."""
    return F.coalesce(F.array_size(value), F.lit(0))


def json_text(value: Column) -> Column:
    return F.to_json(value, {"ignoreNullFields": "false"})


def is_blank(value: Column) -> Column:
    return value.isNull() | (value.cast("string") == "")


def day_text(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd")


def first_filled(*values: Column) -> Column:
    """First value that is neither null nor empty."""
    return F.coalesce(*[F.when(~is_blank(v), v) for v in values])
