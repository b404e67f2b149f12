"""Date columns: mixed-format parsing, Saturday weeks, calendar features (DT-01 to DT-10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Year, month and day with Hangul units, slashes, dashes or dots, or eight digits. Fixed values of the source files.
_WRITTEN = r"^\s*(?:(\d{2,4})\s*[년/.\-]\s*(\d{1,2})\s*[월/.\-]\s*(\d{1,2})\s*일?|(\d{4})(\d{2})(\d{2}))\s*$"
_WEEK = r"^\s*(\d{2,4})년\s*(\d{1,2})월\s*(\d)주\s*$"


def _number(text: Column) -> Column:
    return F.nullif(text, F.lit("")).cast("int")


def _year(text: Column, pivot: int) -> Column:
    year = _number(text)
    return F.when(F.length(text) > 2, year).otherwise(year + F.when(year < pivot, 2000).otherwise(1900))


def _date(year: Column, month: Column, day: Column) -> Column:
    return F.try_to_date(F.format_string("%04d-%02d-%02d", year, month, day), "yyyy-MM-dd")


def parse_date(text: Column, pivot: int = 50) -> Column:
    """DT-01: dates such as 26년06월11일, 2026/06/11, 2026.6.1 or 20260611; two-digit years below ``pivot`` are 20xx; null if impossible."""
    # one look at the text: year, month and day between slashes behind one more; anything else has no second part
    part = F.split(F.regexp_replace(text, _WRITTEN, "/$1$4/$2$5/$3$6"), "/")
    known = (F.length(F.get(part, F.lit(0))) == 0) & (F.size(part) == 4) & text.rlike(r"^\s*\d")
    year = F.get(part, F.lit(1))
    century = F.when(F.length(year) > 2, "").when(year.try_cast("int") < pivot, "20").otherwise("19")
    day = F.concat(F.lpad(F.concat(century, year), 4, "0"), F.lit("-"), F.get(part, F.lit(2)), F.lit("-"), F.get(part, F.lit(3)))
    return F.when(known, day.try_cast("date"))


def week_label_end(text: Column, pivot: int = 50) -> Column:
    """DT-02: 'YY년MM월W주' is day 7, 14, 21 or 28 of the month, or its last day for week 5."""
    part = lambda i: F.regexp_extract(text, _WEEK, i)
    month = _date(_year(part(1), pivot), _number(part(2)), F.lit(1))
    week = _number(part(3))
    return F.when(text.rlike(_WEEK), F.when(week >= 5, F.last_day(month)).when(week >= 1, F.date_add(month, 7 * week - 1)))


def saturday_week(date: Column) -> Column:
    """DT-03: the Saturday that ends the date's Sunday-to-Saturday week; a Saturday is its own."""
    return F.next_day(F.date_sub(date, 1), "SAT")


def month_week(date: Column) -> Column:
    """DT-07: the week of the month, 1 to 5."""
    return F.least(F.ceil(F.dayofmonth(date) / 7), F.lit(5)).cast("int")


def calendar_spine(spark: SparkSession, first: str, last: str, step: str = "1 day", name: str = "date") -> DataFrame:
    """DT-04: every date from ``first`` to ``last`` by ``step``."""
    return spark.range(1).select(F.explode(F.expr(f"sequence(date'{first}', date'{last}', interval {step})")).alias(name))


def spine_of(df: DataFrame, date: str) -> DataFrame:
    """DT-04: every date from the first to the last of ``df``."""
    return df.agg(F.min(date).alias("__a"), F.max(date).alias("__b")).where("__a is not null").select(F.explode(F.sequence("__a", "__b")).alias(date))


def calendar_features(df: DataFrame, date: str = "date", keys: tuple[str, ...] = ()) -> DataFrame:
    """DT-05: trend in years by row, weekday 1 to 6 and month 2 to 12 dummies (the first of each is the base)."""
    w = Window.partitionBy(*keys).orderBy(date)
    cols = {"trend": (F.row_number().over(w) - 1) / 365.25}
    cols |= {f"weekday_{k}": (F.weekday(date) == k).cast("double") for k in range(1, 7)}
    cols |= {f"month_{k}": (F.month(date) == k).cast("double") for k in range(2, 13)}
    return df.withColumns(cols)


def month_chunks(first: Column, last: Column) -> Column:
    """DT-08: the months that cover a range, as an array of (start, end) cut at the range's ends."""
    months = F.sequence(F.trunc(first, "MM"), last, F.expr("interval 1 month"))
    return F.transform(months, lambda m: F.struct(F.greatest(m, first).alias("start"), F.least(F.last_day(m), last).alias("end")))


def freshness(date: Column, today: Column, max_age: int = 1) -> Column:
    """DT-09: 'fresh' up to ``max_age`` days old, else 'stale'; 'missing' without a date."""
    return F.when(date.isNull(), "missing").when(F.datediff(today, date) <= max_age, "fresh").otherwise("stale")
