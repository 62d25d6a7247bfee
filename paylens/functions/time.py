"""Parts of the purchase time, which is published as 'yyyy-MM-dd HH:mm:ss' text.

The text has no zone, so it is read without one: results do not depend on the session
time zone. No purchase time is NULL or blank text; any other text in another format raises.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PURCHASED = "order_purchase_timestamp"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Places of the characters between the numbers, from 1, and the length of such a text.
SEPARATORS = {5: "-", 8: "-", 11: " ", 14: ":", 17: ":"}
LENGTH = 19


def has_time() -> Column:
    return F.col(PURCHASED) != ""


def _part(start: int, length: int) -> Column:
    return F.substring(PURCHASED, start, length)


def purchase_time() -> Column:
    """NULL where there is no time.

    A cast reads a time several times faster than a pattern does, but takes other formats as well; so the
    length, the separators and a digit at the end are asked for first.
    """
    text = F.col(PURCHASED)
    fixed = (F.length(text) == LENGTH) & _part(LENGTH, 1).between("0", "9")
    for place, separator in SEPARATORS.items():
        fixed = fixed & (_part(place, 1) == separator)
    message = F.concat(text, F.lit(f" could not be parsed as {TIME_FORMAT}"))
    at = F.when(fixed, text.try_cast("timestamp_ntz"))
    return F.when(has_time(), F.coalesce(at, F.raise_error(message).cast("timestamp_ntz")))


def month() -> Column:
    """'2017-10'."""
    return F.when(purchase_time().isNotNull(), _part(1, 7))


def quarter() -> Column:
    """'Q4-2017' (text: sorts by quarter number first)."""
    number = F.floor((_part(6, 2).cast("int") + 2) / 3).cast("string")
    parts = F.concat(F.lit("Q"), number, F.lit("-"), _part(1, 4))
    return F.when(purchase_time().isNotNull(), parts)


def iso_weekday() -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(purchase_time()) + 1


def hour() -> Column:
    return F.hour(purchase_time())
