"""Dates of any stored type as TIMESTAMP_NTZ; what is no date becomes null."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from drydock.config import DateRules


_MONTHS = "JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC"


def _part(c: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(c, pattern, group)


def _twelve_hours(c: Column, pattern: str) -> Column:
    """Month, day, year and a time on a clock of twelve hours as ISO text."""
    hour = (_part(c, pattern, 4).try_cast("int") % 12
            + F.when(F.lower(_part(c, pattern, 6)) == "p", 12).otherwise(0))
    return F.concat(_part(c, pattern, 3), F.lit("-"), _part(c, pattern, 1), F.lit("-"), _part(c, pattern, 2), F.lit(" "),
                    hour.cast("string"), _part(c, pattern, 5))


def _month_name(c: Column, pattern: str) -> Column:
    """Day, month by name, and year as ISO text; what names no month becomes null."""
    at = F.instr(F.lit(_MONTHS), F.upper(F.substring(_part(c, pattern, 2), 1, 3)))
    month = F.when((at > 0) & (at % 3 == 1), F.floor((at + 2) / 3).cast("string"))
    return F.concat(_part(c, pattern, 3), F.lit("-"), month, F.lit("-"), _part(c, pattern, 1))


def _from_text(c: Column, rules: DateRules) -> Column:
    forms = [(p, F.regexp_replace(c, p, iso)) for p, iso in rules.rewrites]
    forms += [(p, _twelve_hours(c, p)) for p in rules.twelve_hours] + [(p, _month_name(c, p)) for p in rules.month_names]
    parsed = None
    for pattern, iso in forms:
        hit, value = c.rlike(pattern), iso.try_cast("timestamp_ntz")
        parsed = F.when(hit, value) if parsed is None else parsed.when(hit, value)
    return parsed


def to_date_time(c: Column, data_type: T.DataType, rules: DateRules = DateRules()) -> Column:
    """A column of the given type as a date in the valid range, else null."""
    if isinstance(data_type, T.TimestampNTZType):
        value = c
    elif isinstance(data_type, (T.TimestampType, T.DateType)):
        value = c.cast("timestamp_ntz")
    elif isinstance(data_type, T.StringType):
        value = _from_text(c, rules)
    elif isinstance(data_type, T.IntegralType):
        value = _from_text(c.cast("string"), rules)
    elif isinstance(data_type, (T.FractionalType,)):
        whole = F.when(c == F.floor(c), c)  # 20240130.7 is no day
        value = _from_text(whole.try_cast("decimal(20,0)").cast("string"), rules)
    else:
        value = F.lit(None).cast("timestamp_ntz")
    low = F.lit(rules.earliest).cast("timestamp_ntz")
    high = F.lit(rules.latest).cast("timestamp_ntz")
    return F.when(value.between(low, high), value)


def date_text(c: Column, missing: str = "") -> Column:
    """``yyyy-MM-dd``, or a stand-in where there is no date."""
    return F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit(missing))
