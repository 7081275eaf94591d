"""Values to display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DASH = "—"
DAY, HOUR, MINUTE = 86_400, 3_600, 60
PREVIEW = 60


def whole(value: Column, unit: int) -> Column:
    """Integer division that truncates toward zero."""
    return F.call_function("div", value, F.lit(unit))


def micros(interval: Column) -> Column:
    """A day-time interval as whole microseconds: exact, and free of the session time zone."""
    return (interval.cast("interval second").cast("decimal(20,6)") * F.lit(1_000_000)).cast("bigint")


def duration_short(us: Column) -> Column:
    """Microseconds as the two largest units: ``3d 4h``, ``2h 15m``, ``5m 3s``, ``45s``.

    NULL and zero give a dash, a second or more in the future ``ahora``; every part truncates toward zero.
    """
    total = whole(us, 1_000_000)

    def pair(big: int, big_name: str, small: int, small_name: str) -> Column:
        rest = whole(total % F.lit(big), small)
        return F.concat(whole(total, big).cast("string"), F.lit(big_name), rest.cast("string"), F.lit(small_name))

    return (
        F.when(us.isNull() | (us == 0), F.lit(DASH))
        .when(total < 0, F.lit("ahora"))
        .when(total >= DAY, pair(DAY, "d ", HOUR, "h"))
        .when(total >= HOUR, pair(HOUR, "h ", MINUTE, "m"))
        .when(total >= MINUTE, pair(MINUTE, "m ", 1, "s"))
        .otherwise(F.concat(total.cast("string"), F.lit("s")))
    )


def number_text(value: Column) -> Column:
    """Thousands separators and no decimals, rounded half to even; NULL gives a dash."""
    return F.coalesce(F.format_number(value, 0), F.lit(DASH))


def timestamp_text(moment: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.coalesce(F.date_format(moment, pattern), F.lit(DASH))


def preview_text(text: Column) -> Column:
    """The whole text up to 60 characters, else its first 60 and three dots; NULL shows as ``NULL``."""
    shown = F.when(F.length(text) > PREVIEW, F.concat(F.substring(text, 1, PREVIEW), F.lit("..."))).otherwise(text)
    return F.coalesce(shown, F.lit("NULL"))
