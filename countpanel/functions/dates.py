"""Calendar expressions (X1-X3): all JVM-side column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countpanel.session import bounded

# Rush hours and the month -> season map used by the analyses.
RUSH_HOURS = (7, 8, 9, 16, 17, 18)
SEASONS = {12: "Winter", 1: "Winter", 2: "Winter",
           3: "Spring", 4: "Spring", 5: "Spring",
           6: "Summer", 7: "Summer", 8: "Summer",
           9: "Autumn", 10: "Autumn", 11: "Autumn"}


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def weekday0(ts) -> Column:
    """Day of week with 0 = Monday (pandas ``dayofweek``)."""
    return F.weekday(col(ts))


def day_name(ts) -> Column:
    return F.date_format(col(ts), "EEEE")


def floor_hour(ts) -> Column:
    """Truncate to the hour, keeping wall-clock (timestamp_ntz) semantics."""
    return F.date_trunc("hour", col(ts)).cast("timestamp_ntz")


def floor_to(ts, unit: str) -> Column:
    return F.date_trunc(unit, col(ts)).cast("timestamp_ntz")


def is_weekend(ts) -> Column:
    return weekday0(ts) >= 5


def is_rush_hour(hour, hours=RUSH_HOURS) -> Column:
    return col(hour).isin(*hours)


def season(month) -> Column:
    m = F.create_map(*[x for k, v in SEASONS.items() for x in (F.lit(k), F.lit(v))])
    return m[col(month)]


def calendar_parts(df: DataFrame, ts: str, prefix: str = "") -> DataFrame:
    """Add year, month, day, hour, minute, day_of_week (0=Mon), is_weekend."""
    t = F.col(ts)
    return df.withColumns({
        f"{prefix}year": F.year(t),
        f"{prefix}month": F.month(t),
        f"{prefix}day": F.dayofmonth(t),
        f"{prefix}hour": F.hour(t),
        f"{prefix}minute": F.minute(t),
        f"{prefix}day_of_week": weekday0(t),
        f"{prefix}is_weekend": is_weekend(t).cast("int"),
    })


def build_timestamp(year, month, day, hour) -> Column:
    return F.make_timestamp_ntz(col(year), col(month), col(day), col(hour), F.lit(0), F.lit(0))


def holiday_flags(df: DataFrame, ts: str, holidays, date_col: str = "holiday") -> DataFrame:
    """Add ``is_holiday`` and ``is_pre_holiday`` from a holiday calendar.

    A day is "pre-holiday" when the next day is a holiday that is not a
    Sunday.  ``holidays`` is either a list of ISO dates (a few per year:
    the flags become ``isin`` expressions, no join) or a table with a
    ``date_col`` column, which is broadcast - its size is bounded by the
    number of calendar years.
    """
    if not isinstance(holidays, DataFrame):
        import datetime as _dt

        days = sorted({str(x) for x in holidays})
        not_sunday = [x for x in days if _dt.date.fromisoformat(x).weekday() != 6]
        d = F.to_date(F.col(ts))
        lit_dates = lambda xs: [F.lit(x).cast("date") for x in xs]
        return df.withColumns({
            "is_holiday": d.isin(*lit_dates(days)).cast("int"),
            "is_pre_holiday": F.date_add(d, 1).isin(*lit_dates(not_sunday)).cast("int")})
    h = holidays.select(F.col(date_col).cast("date").alias("_hd")).distinct()
    d = F.to_date(F.col(ts))
    out = (df.withColumn("_d", d)
           .join(bounded(h.withColumnRenamed("_hd", "_h1")), F.col("_d") == F.col("_h1"), "left")
           .join(bounded(h.filter(F.dayofweek("_hd") != 1).withColumnRenamed("_hd", "_h2")),
                 F.date_add(F.col("_d"), 1) == F.col("_h2"), "left"))
    return (out.withColumn("is_holiday", F.col("_h1").isNotNull().cast("int"))
            .withColumn("is_pre_holiday", F.col("_h2").isNotNull().cast("int"))
            .drop("_d", "_h1", "_h2"))


def resolve_event_time(df: DataFrame, out: str = "datetime_hour") -> DataFrame:
    """Derive the event time from whichever layout the table has.

    Looks at ``df.columns`` only (no job).  Order of preference:
    datetime, time, start_time, date + hour, year/month/day/hour.
    """
    cols = set(df.columns)
    if "datetime" in cols:
        t = F.col("datetime").cast("timestamp_ntz")
    elif "time" in cols:
        t = F.col("time").cast("timestamp_ntz")
    elif "start_time" in cols:
        t = F.col("start_time").cast("timestamp_ntz")
    elif {"date", "hour"} <= cols:
        t = (F.col("date").cast("date").cast("timestamp_ntz")
             + F.make_dt_interval(hours=F.col("hour").cast("int")))
    elif {"year", "month", "day", "hour"} <= cols:
        t = build_timestamp("year", "month", "day", "hour")
    else:
        raise ValueError(f"cannot derive an event time from columns {sorted(cols)}")
    return df.withColumn(out, floor_hour(t))
