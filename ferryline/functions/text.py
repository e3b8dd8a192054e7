"""Text helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The numerals written for 1 to 20.
NUMERALS = (
    "一 二 三 四 五 六 七 八 九 十 "
    "十一 十二 十三 十四 十五 十六 十七 十八 十九 二十"
).split()


def camel_case(name: str) -> str:
    """``flight_date`` to ``flightDate``."""
    first, *rest = name.split("_")
    return first + "".join(word[:1].upper() + word[1:] for word in rest)


def snake_case(name: str) -> str:
    """Column name on file (``messageTime``) to column name in tables (``message_time``)."""
    return re.sub(r"(?<!^)([A-Z])", r"_\1", name).lower()


def has_prefix(text: Column, prefix: str) -> Column:
    """Prefix test that is false, not null, for a null text."""
    return F.coalesce(text.startswith(prefix), F.lit(False))


def chinese_numeral(number: Column) -> Column:
    """1 to 20 as a Chinese numeral. Any other number is an error."""
    numerals = F.array(*[F.lit(n) for n in NUMERALS])
    message = F.concat(F.lit("not in 1-20: "), number.cast("string"))
    return F.when(
        number.isNull() | number.between(1, len(NUMERALS)), F.get(numerals, number - 1)
    ).otherwise(F.raise_error(message))
