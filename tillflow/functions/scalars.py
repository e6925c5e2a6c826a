"""Column functions: ids, clocks, calendar labels, classes, stores, amounts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillflow import options as o


def blank(c: Column) -> Column:
    return c.isNull() | (c == "")


def number_or_zero(c: Column, to: str = "double") -> Column:
    """Numbers stay, text that is no number and null become 0."""
    value = F.coalesce(c.try_cast("double"), F.lit(0.0))
    # A cast to int drops the fraction; what cannot be an int counts as bad.
    return value if to == "double" else F.coalesce(value.try_cast(to), F.lit(0).cast(to))


def ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0 or either side is missing."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def round2(c: Column) -> Column:
    """Two decimals, halves to even."""
    return F.rint(c * 100) / 100


def money(c: Column) -> Column:
    """A sum of amounts, cleaned of the order in which doubles were added."""
    return F.round(c, 2)


def invoice_id(origin: Column, own: Column) -> Column:
    return F.coalesce(origin, own)


def two_digits(c: Column) -> Column:
    text = c.cast("string")
    return F.when(c.between(0, 9), F.concat(F.lit("0"), text)).otherwise(text)


def clock_text(hour: Column, minute: Column) -> Column:
    """``HH:MM``, null if either part is."""
    return F.concat(two_digits(hour), F.lit(":"), two_digits(minute))


def is_clock(hour: Column, minute: Column) -> Column:
    return hour.between(0, 23) & minute.between(0, 59)


def stay_hours(h_in: Column, m_in: Column, h_out: Column, m_out: Column) -> Column:
    """Hours between two clocks; leaving earlier than arriving means after midnight."""
    minutes = F.pmod((h_out * 60 + m_out) - (h_in * 60 + m_in), F.lit(24 * 60))
    return F.when(is_clock(h_in, m_in) & is_clock(h_out, m_out), round2(minutes / 60))


def parse_time(c: Column, is_text: bool) -> Column:
    """``dd/MM/yyyy HH:mm`` text to a timestamp, null if it is no such text."""
    return F.try_to_timestamp(c, F.lit("dd/MM/yyyy HH:mm")) if is_text else c


def to_minute(c: Column) -> Column:
    return F.date_trunc("minute", c)


def week_label(d: Column) -> Column:
    week, year = F.extract(F.lit("WEEK"), d), F.extract(F.lit("YEAROFWEEK"), d)
    return F.concat(two_digits(week), F.lit("-"), year.cast("string"))


def month_label(d: Column) -> Column:
    return F.concat(two_digits(F.month(d)), F.lit("-"), F.year(d).cast("string"))


def week_label_short(d: Column) -> Column:
    week, year = F.extract(F.lit("WEEK"), d), F.extract(F.lit("YEAROFWEEK"), d)
    return F.concat(week.cast("string"), F.lit("-"), year.cast("string"))


def month_label_short(d: Column) -> Column:
    return F.concat(F.month(d).cast("string"), F.lit("-"), F.year(d).cast("string"))


def calendar(d: Column) -> dict[str, Column]:
    """The four calendar columns every output table starts with."""
    return {
        "date": d.cast("date"),
        "week": week_label(d),
        "month": month_label(d),
        "year": F.year(d),
    }


def business_date(d: Column, close_hour: Column) -> Column:
    """A bill closed in the hour after midnight belongs to the day before."""
    return F.when(close_hour == 0, F.date_sub(d.cast("date"), 1)).otherwise(d.cast("date"))


def close_time(day: Column, hour: Column, minute: Column) -> Column:
    """The closing clock on the given day."""
    return F.when(
        is_clock(hour, minute),
        F.try_make_timestamp(
            F.year(day), F.month(day), F.dayofmonth(day), hour, minute, F.lit(0).cast("decimal(16,6)")
        ),
    )


def customer_class(phone: Column, tier: Column) -> Column:
    no_phone, no_tier = blank(phone), blank(tier)
    return (
        F.when(no_phone & no_tier, o.WALK_IN)
        .when(~no_phone & (no_tier | (tier == o.DEFAULT_TIER)), o.NEW_GUEST)
        .otherwise(o.RETURNING_GUEST)
    )


def has_no_topping_mark(item: Column) -> Column:
    return F.coalesce(F.contains(item, F.lit(o.NO_TOPPING)), F.lit(False))


def store_by_code_anywhere(
    number: Column,
    codes: Iterable[tuple[str, str]] = o.STORE_CODES_ANYWHERE,
    or_missing: tuple[str, str] = o.STORE_CODE_OR_NO_NUMBER,
    other: str = o.OTHER_STORE,
) -> Column:
    """The first code the number contains decides; a missing number goes to ``or_missing``."""
    store = F.when(F.lit(False), F.lit(None).cast("string"))
    for code, name in codes:
        store = store.when(number.contains(code), name)
    return store.when(number.isNull() | number.contains(or_missing[0]), or_missing[1]).otherwise(other)


def store_by_code_at_start(
    store: Column, number: Column, codes: Iterable[tuple[str, str]] = o.STORE_CODES_AT_START
) -> Column:
    """Fill a missing store from the start of the invoice number; a known store stays."""
    missing = store.isNull() | (F.trim(store) == "") | (store == "0")
    filled = F.when(~missing, store)
    for code, name in codes:
        filled = filled.when(number.startswith(code), name)
    return filled.otherwise(store)


def table_of(c: Column) -> Column:
    return F.split(c, "-", 2)[0]


def area_of(c: Column) -> Column:
    return F.trim(F.try_element_at(F.split(c, "-", 2), F.lit(2)))


def clean_text(c: Column) -> Column:
    """Empty text and the text ``null`` are missing values."""
    return F.when(~c.isin("", "null"), c)


def sort_suffix(child: Column) -> Column:
    """Last four characters of the child id; rows without a child sort as ``None``."""
    return F.coalesce(F.right(child, F.lit(4)), F.lit("None"))
