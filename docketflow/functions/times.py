"""Dates and times (I27-I37, C9). Instants are UTC; the publication day is the day in New York."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ZONE = "America/New_York"
#: The federal holidays. Month, day, name; and month, weekday (Monday 0), which one (-1: last), name.
FIXED_HOLIDAYS = ((1, 1, "New Year's Day"), (6, 19, "Juneteenth National Independence Day"), (7, 4, "Independence Day"), (11, 11, "Veterans Day"), (12, 25, "Christmas Day"))
FLOATING_HOLIDAYS = (
    (1, 0, 3, "Birthday of Martin Luther King, Jr."), (2, 0, 3, "Washington's Birthday"), (5, 0, -1, "Memorial Day"),
    (9, 0, 1, "Labor Day"), (10, 0, 2, "Columbus Day"), (11, 3, 4, "Thanksgiving Day"),
)
#: Date patterns in the order they are tried.
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def publication_day(ts: Column | str) -> Column:
    """The calendar day in New York of a UTC instant (TIMESTAMP, or TIMESTAMP_NTZ in UTC)."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(ZONE), _c(ts).cast("timestamp_ntz")))


def local(ts: Column | str) -> Column:
    """The wall clock in New York of a UTC instant."""
    return F.convert_timezone(F.lit("UTC"), F.lit(ZONE), _c(ts).cast("timestamp_ntz"))


def filing_day(policy: Column | str, date_issued: Column | str, first_seen: Column | str) -> Column:
    """The write-once filing day: the cover date under the `cover` policy where there is one, else the day first seen."""
    ny = publication_day(first_seen)
    return F.when(_c(policy) == "cover", F.coalesce(_c(date_issued).cast("date"), ny)).otherwise(ny)


def found_date(s: Column | str) -> Column:
    """The first valid date of a text: ISO, then Month d, Y, then d Month Y, then m/d/y with two- or four-digit years."""
    s = _c(s)

    def first_valid(pattern: str, group: int, parse) -> Column:
        found = F.transform(F.regexp_extract_all(s, F.lit(pattern), F.lit(group)), parse)
        return F.try_element_at(F.filter(found, lambda d: d.isNotNull()), F.lit(1))

    day = lambda fmt: lambda x: F.to_date(F.try_to_timestamp(F.regexp_replace(x, r"[,.\s]+", " "), F.lit(fmt)))
    us = lambda x: F.coalesce(F.to_date(F.try_to_timestamp(x, F.lit("M/d/yyyy"))), F.to_date(F.try_to_timestamp(x, F.lit("M/d/yy"))))
    return F.coalesce(
        first_valid(r"\b(\d{4}-\d{2}-\d{2})", 1, lambda x: F.to_date(F.try_to_timestamp(x, F.lit("yyyy-MM-dd")))),
        first_valid(rf"\b((?:{MONTHS})\s+\d{{1,2}},?\s+\d{{4}})", 1, day("MMMM d yyyy")),
        first_valid(rf"\b(\d{{1,2}}\s+(?:{MONTHS}),?\s+\d{{4}})", 1, day("d MMMM yyyy")),
        first_valid(r"\b(\d{1,2}/\d{1,2}/(?:\d{4}|\d{2}))\b", 1, us),
    )


def claimed_day(s: Column | str) -> Column:
    """The publisher's own day. RFC 822 with a zone becomes the day in New York, without one it is taken
    at face value; then an ISO prefix; then any date in the text."""
    t = F.regexp_replace(F.trim(_c(s)), r"^[A-Za-z]{3},\s*", "")
    zoned = F.coalesce(F.try_to_timestamp(t, F.lit("d MMM yyyy HH:mm:ss Z")), F.try_to_timestamp(t, F.lit("d MMM yyyy HH:mm:ss z")), F.try_to_timestamp(t, F.lit("d MMM yyyy HH:mm Z")))
    zoneless = F.coalesce(F.try_to_timestamp(t, F.lit("d MMM yyyy HH:mm:ss")), F.try_to_timestamp(t, F.lit("d MMM yyyy HH:mm")))
    iso = F.to_date(F.try_to_timestamp(F.regexp_extract(t, r"^(\d{4}-\d{2}-\d{2})", 1), F.lit("yyyy-MM-dd")))
    return F.coalesce(F.to_date(F.from_utc_timestamp(zoned, ZONE)), F.to_date(zoneless), iso, found_date(t))


def bulletin_stamp(s: Column | str) -> Column:
    """MM/DD/YYYY HH:MM AM with a zone's name, which is dropped."""
    return F.try_to_timestamp(F.regexp_extract(_c(s), r"(\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2} [AP]M)", 1), F.lit("M/d/yyyy h:mm a"))


def work_window(day: Column | str, now: Column | str, grace_hours: int = 6) -> tuple[Column, Column]:
    """From midnight to midnight in New York as UTC instants, plus the grace, not beyond now."""
    start = F.to_utc_timestamp(_c(day).cast("timestamp"), ZONE)
    end = F.to_utc_timestamp(F.date_add(_c(day), 1).cast("timestamp"), ZONE) + F.expr(f"INTERVAL {grace_hours} HOURS")
    return start, F.least(end, _c(now).cast("timestamp"))


def clock(ts: Column | str) -> Column:
    """HH:mm:ss in New York."""
    return F.date_format(local(ts), "HH:mm:ss")


def holidays(spark: SparkSession, first: int, last: int) -> DataFrame:
    """Day, holiday for the years first to last: statutory days, observed days, and the observed
    31 December of a following New Year's Day on a Saturday."""
    years = spark.range(first, last + 2).select(F.col("id").cast("int").alias("y"))
    fixed = F.array(*[F.struct(F.make_date("y", F.lit(m), F.lit(d)).alias("day"), F.lit(n).alias("holiday")) for m, d, n in FIXED_HOLIDAYS])
    fixed = years.select(F.explode(fixed).alias("x")).select("x.day", "x.holiday")
    shift = F.when(F.weekday("day") == 5, -1).when(F.weekday("day") == 6, 1)
    observed = fixed.filter(shift.isNotNull()).select(F.date_add("day", shift).alias("day"), F.concat("holiday", F.lit(" (observed)")).alias("holiday"))

    def nth(m: int, weekday: int, k: int) -> Column:
        start = F.make_date("y", F.lit(m), F.lit(1))
        if k > 0:
            return F.date_add(start, F.pmod(F.lit(weekday) - F.weekday(start), F.lit(7)) + 7 * (k - 1))
        end = F.last_day(start)
        return F.date_sub(end, F.pmod(F.weekday(end) - F.lit(weekday), F.lit(7)))

    floating = F.array(*[F.struct(nth(m, w, k).alias("day"), F.lit(n).alias("holiday")) for m, w, k, n in FLOATING_HOLIDAYS])
    floating = years.select(F.explode(floating).alias("x")).select("x.day", "x.holiday")
    return fixed.union(observed).union(floating).filter(F.year("day").between(first, last))


def publishing(day: Column | str, holiday: Column | str) -> Column:
    """Weekend before holiday before normal."""
    return F.when(F.weekday(_c(day)) >= 5, "weekend").when(_c(holiday).isNotNull(), "holiday").otherwise("normal")


def within_days(day: Column | str, today: Column | str, days: int) -> Column:
    """Whether a day is one of the last `days` before today, or today; null days aren't."""
    return F.coalesce((_c(day) >= F.date_sub(_c(today), days)) & (_c(day) <= _c(today)), F.lit(False))


def iso_day(s: Column | str) -> Column:
    """The day that a text's first ten characters are in ISO form, else null."""
    head = F.substring(_c(s), 1, 10)
    return F.when(head.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.to_date(F.try_to_timestamp(head, F.lit("yyyy-MM-dd"))))


def month_day(s: Column | str, year: Column | str) -> Column:
    """A day written as a month's first three letters and a number (`Jan 5`, `5-Jan`), in the year that a header states."""
    month = F.initcap(F.regexp_extract(_c(s), r"(?i)\b(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)", 1))
    number = F.regexp_extract(_c(s), r"\b(\d{1,2})\b", 1)
    return F.when((month != "") & (number != ""), F.to_date(F.try_to_timestamp(F.concat_ws(" ", month, number, _c(year).cast("string")), F.lit("MMM d yyyy"))))


def instant(s: Column | str) -> Column:
    """The UTC instant of a stamp in any of the dialects that writers use (`2024-01-02T03:04:05Z`, with an offset, with
    parts of a second, with a space instead of the T, without a zone: then UTC), to the second; null if it is none.

    Text order of such stamps isn't their order in time, as suffixes differ; compare these."""
    m = r"^\s*(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2})(:\d{2})?(?:[.,]\d+)?\s*(Z|z|[+-]\d{2}:?\d{2}|[+-]\d{2})?\s*$"
    got = lambda k: F.regexp_extract(_c(s), m, k)
    zone = F.when(got(4).isin("", "Z", "z"), "+00:00").otherwise(F.regexp_replace(F.regexp_replace(got(4), r"^([+-]\d{2})$", "$1:00"), r"^([+-]\d{2})(\d{2})$", "$1:$2"))
    stamp = F.concat(got(1), F.lit(" "), got(2), F.when(got(3) == "", ":00").otherwise(got(3)), zone)
    return F.when(got(1) != "", F.try_to_timestamp(stamp, F.lit("yyyy-MM-dd HH:mm:ssxxx")))
