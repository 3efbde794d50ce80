"""Calendar logic: fiscal year, fiscal quarter, seasons, meter time features, labels.

Fixed values that must equal the reference's calendar rules:
  * fiscal year starts on 17 July; label "YYYY/YY" (e.g. "2023/24").
  * fiscal quarter by month only: Jul-Sep Q1, Oct-Dec Q2, Jan-Mar Q3, Apr-Jun Q4.
  * season (a), climate calendar: Mar-May "Pre-Monsoon", Jun-Sep "Monsoon",
    Oct-Nov "Post-Monsoon", otherwise "Winter".
  * season (b), weather enrichment: Jan-Feb "Winter", Mar-May "Pre-Monsoon",
    Jun-Sep "Monsoon", Oct-Dec "Post-Monsoon" (December is Post-Monsoon).
  * peak hours: morning 06-08, evening 18-21 (inclusive); weekend = Sat, Sun.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .exprs import ColumnOrName, col

FY_START_MONTH = 7
FY_START_DAY = 17
SEASONS = ["Winter", "Pre-Monsoon", "Monsoon", "Post-Monsoon"]


def fiscal_year_start(d: ColumnOrName) -> Column:
    d = col(d)
    m, day = F.month(d), F.dayofmonth(d)
    started = (m > FY_START_MONTH) | ((m == FY_START_MONTH) & (day >= FY_START_DAY))
    return F.when(started, F.year(d)).otherwise(F.year(d) - 1)


def fiscal_year(d: ColumnOrName) -> Column:
    """Fiscal-year label, e.g. 2023-07-17 -> "2023/24"; 1999-12-31 -> "1999/00"."""
    start = fiscal_year_start(d)
    return F.concat(
        start.cast("string"), F.lit("/"),
        F.lpad(((start + 1) % 100).cast("string"), 2, "0"),
    )


def fiscal_quarter(d: ColumnOrName) -> Column:
    m = F.month(col(d))
    return (F.when(m.between(7, 9), "Q1")
            .when(m.between(10, 12), "Q2")
            .when(m.between(1, 3), "Q3")
            .otherwise("Q4"))


def fiscal_year_start_date(fy: ColumnOrName) -> Column:
    """"2023/24" -> date 2023-07-17 (first four characters + "-07-17")."""
    return F.to_date(F.concat(F.substring(col(fy), 1, 4), F.lit("-07-17")))


def season_of_month(m: ColumnOrName, dec_is_winter: bool = True) -> Column:
    m = col(m)
    out = (F.when(m.between(3, 5), "Pre-Monsoon")
           .when(m.between(6, 9), "Monsoon"))
    if dec_is_winter:
        out = out.when(m.between(10, 11), "Post-Monsoon")
    else:
        out = out.when(m.between(10, 12), "Post-Monsoon")
    return out.otherwise("Winter")



def is_monsoon(m: ColumnOrName) -> Column:
    return col(m).between(6, 9)


def weekday0(d: ColumnOrName) -> Column:
    """Day of week with Monday = 0 (pandas ``dayofweek``)."""
    return F.weekday(col(d))


def meter_time_features(ts: ColumnOrName = "timestamp") -> dict[str, Column]:
    """Columns added by meter cleaning (C4)."""
    ts = col(ts)
    hour = F.hour(ts)
    dow = F.weekday(ts)
    evening = hour.between(18, 21)
    morning = hour.between(6, 8)
    return {
        "hour": hour,
        "day_of_week": dow,
        "date": F.to_date(ts),
        "is_weekend": dow.isin(5, 6),
        "is_evening_peak": evening,
        "is_morning_peak": morning,
        "is_peak_hour": evening | morning,
    }


def hour_label(h: ColumnOrName) -> Column:
    return F.format_string("%02d:00", col(h))


def day_type(is_weekend: ColumnOrName) -> Column:
    return F.when(col(is_weekend), "Weekend").otherwise("Weekday")


def day_name(d: ColumnOrName) -> Column:
    return F.date_format(col(d), "EEEE")



def iso_week(d: ColumnOrName) -> Column:
    return F.weekofyear(col(d))


_EPOCH_NTZ = "1970-01-01 00:00:00"


def ntz_as_instant(ts: ColumnOrName) -> Column:
    """Zone-less timestamp read as UTC -> TIMESTAMP (an instant), whatever the
    session time zone (watermarks and event-time windows need TIMESTAMP)."""
    micros = F.timestamp_diff("MICROSECOND", F.to_timestamp_ntz(F.lit(_EPOCH_NTZ)), col(ts))
    return F.timestamp_micros(micros)


def instant_as_ntz(ts: ColumnOrName) -> Column:
    """Inverse of ``ntz_as_instant``: the UTC wall-clock time of an instant."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(col(ts)),
                           F.to_timestamp_ntz(F.lit(_EPOCH_NTZ)))


def trunc_ntz(unit: str, ts: ColumnOrName) -> Column:
    """Truncate a zone-less timestamp (or date) to ``unit`` without touching
    the session time zone (``date_trunc`` returns a zoned TIMESTAMP computed
    in the session zone).  Units: year, month, day, hour."""
    c = col(ts)
    zero = F.lit(0)
    unit = unit.lower()
    if unit == "hour":
        return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), zero, zero)
    if unit == "day":
        return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), zero, zero, zero)
    if unit == "month":
        return F.make_timestamp_ntz(F.year(c), F.month(c), F.lit(1), zero, zero, zero)
    if unit == "year":
        return F.make_timestamp_ntz(F.year(c), F.lit(1), F.lit(1), zero, zero, zero)
    raise ValueError(f"unsupported unit {unit!r}")
