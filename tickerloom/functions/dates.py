"""Permissive date parsing.

A value is rewritten once into ``year-month-day|rest`` by a short list of
shapes, and the assembled ISO text is cast once. No format is tried by
exception, so a column of unparsable values costs the same as a column of good
ones. The steps are separate projections: each is computed once per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.functions.naming import col
from tickerloom.functions.text import trim_ws

ISO_OUT = "yyyy-MM-dd HH:mm:ss"

_MONTH = (r"(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|"
          r"aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)\.?")
_MONTH_HEADS = "janfebmaraprmayjunjulaugsepoctnovdec"
_WEEKDAY = (r"(?i)\b(?:mon(?:day)?|tue(?:s(?:day)?)?|wed(?:nesday)?|"
            r"thu(?:r(?:s(?:day)?)?)?|fri(?:day)?|sat(?:urday)?|sun(?:day)?)\b\.?,?")
_DAY = r"(\d{1,2})(?:st|nd|rd|th)?"
_GAP = r"[\s\-/.,]*"
_SEP = r"([-/. ])"
_YEAR = r"(\d{4}|\d{2})"
_OVER_12 = r"(1[3-9]|[23]\d)"
_CLOCK = (r"^[\s,Tt]*(?:at\s+)?(\d{1,2})(?::?(\d{2}))?(?::?(\d{2})(?:[.,](\d{1,6})\d*)?)?"
          r"\s*([AaPp])?[Mm]?\s*([+-]\d{2}(?::?\d{2})?|Z|[A-Z]{3,5})?$")


def _shapes(day_first: bool, year_day_month: bool) -> list[tuple[str, str]]:
    """(pattern, rewrite) pairs for text that starts with a digit; the first match decides."""
    shapes = []
    if year_day_month:
        shapes.append((rf"^(\d{{4}}){_SEP}(\d{{1,2}})\2(0?[1-9]|1[0-2])(?!\d)(.*)$",
                       "$1-$4-$3|$5"))
    shapes += [
        (rf"^(\d{{4}}){_SEP}(\d{{1,2}})\2(\d{{1,2}})(?!\d)(.*)$", "$1-$3-$4|$5"),
        (r"^(\d{4})(\d{2})(\d{2})(?!\d)(.*)$", "$1-$2-$3|$4"),
    ]
    # A number above 12 can only be the day, whatever the preference.
    if day_first:
        shapes.insert(0, (rf"^(\d{{4}}){_SEP}{_OVER_12}\2(\d{{1,2}})(?!\d)(.*)$",
                          "$1-$4-$3|$5"))
        shapes.append((rf"^(\d{{1,2}}){_SEP}{_OVER_12}\2{_YEAR}(?!\d)(.*)$", "$4-$1-$3|$5"))
        preferred = "$4-$3-$1|$5"
    else:
        shapes.append((rf"^{_OVER_12}{_SEP}(\d{{1,2}})\2{_YEAR}(?!\d)(.*)$", "$4-$3-$1|$5"))
        preferred = "$4-$1-$3|$5"
    return shapes + [
        (rf"^(\d{{1,2}}){_SEP}(\d{{1,2}})\2{_YEAR}(?!\d)(.*)$", preferred),
        (rf"(?i)^{_DAY}{_GAP}{_MONTH}{_GAP}(\d{{4}}(?!\d)|\d{{2}}(?![\d:]))(.*)$", "$3-$2-$1|$4"),
        (rf"(?i)^(\d{{4}}){_GAP}{_MONTH}{_GAP}{_DAY}(?!\d)(.*)$", "$1-$2-$3|$4"),
        (r"^(\d{4})[-/](\d{1,2})$", "$1-$2-1|"),
        (r"^(\d{4})$", "$1-1-1|"),
    ]


# Shapes of text that starts with a month name.
_NAMED = [
    (rf"(?i)^{_MONTH}{_GAP}{_DAY}[\s\-/.,]+{_YEAR}(?![\d:])(.*)$", "$3-$1-$2|$4"),
    (rf"(?i)^{_MONTH}\s+{_DAY}\s+(\d{{1,2}}:[\d:.]+)\s+(\d{{4}})$", "$4-$1-$2|$3"),
    (rf"(?i)^{_MONTH}{_GAP}(\d{{4}})$", "$2-$1-1|"),
]


def _first_shape(text: Column, shapes: list[tuple[str, str]]) -> Column:
    canon = F.lit(None).cast("string")
    for pattern, rewrite in reversed(shapes):
        canon = F.when(text.rlike(pattern),
                       F.regexp_replace(text, pattern, rewrite)).otherwise(canon)
    return canon


def _resolve(df: DataFrame, source: str, day_first: bool,
             year_day_month: bool) -> DataFrame:
    """Add ``__local`` (ISO text without zone) and ``__offset`` (``+hh:mm``)."""
    df = df.withColumn("__text", trim_ws(col(source).cast("string")))
    df = df.withColumn(
        "__text",
        F.when(
            F.col("__text").rlike(_WEEKDAY),
            F.regexp_replace(F.regexp_replace("__text", _WEEKDAY, " "),
                             r"^[\s,]+|[\s,]+$", ""),
        ).otherwise(F.regexp_replace("__text", r"^(\d{8})\.0$", "$1")),
    )
    text = F.col("__text")
    initial = F.substring(text, 1, 1)
    df = df.withColumn("__canon", F.when(
        initial.between("0", "9"), _first_shape(text, _shapes(day_first, year_day_month)),
    ).when(F.lower(initial).between("a", "s"), _first_shape(text, _NAMED)))
    df = df.withColumns({
        "__ymd": F.split(F.substring_index("__canon", "|", 1), "-"),
        "__rest": F.expr("substring(__canon, instr(__canon, '|') + 1)"),
    })
    month = F.get("__ymd", F.lit(1))
    head = F.lower(F.substring(month, 1, 3))
    number = F.when(month.rlike(r"^\d"), month).otherwise(
        F.expr(f"cast((locate(__head, '{_MONTH_HEADS}') + 2) div 3 as string)"))
    df = df.withColumn("__head", head).withColumn("__month", number)

    # The clock is matched once; what holds a bar cannot match, so its parts are safe.
    parts = F.when(~F.col("__rest").contains("|") & (F.trim("__rest") != ""), F.split(
        F.regexp_replace("__rest", _CLOCK, "$1|$2|$3|$4|$5|$6"), r"\|"))
    df = df.withColumn("__clock", parts)

    def piece(group: int) -> Column:
        return F.get("__clock", F.lit(group - 1))

    df = df.withColumns({
        "__hour": piece(1).try_cast("int"), "__min": piece(2), "__sec": piece(3),
        "__frac": piece(4), "__half": F.lower(piece(5)), "__zone": piece(6),
    })
    hour, half = F.col("__hour"), F.col("__half")
    hour24 = (F.when(half == "", hour)
              .when(~hour.between(1, 12), F.lit(None))
              .when(half == "p", hour % 12 + 12).otherwise(hour % 12))
    clock = F.when(F.trim("__rest") == "", F.lit("00:00:00")).otherwise(
        F.concat(hour24.cast("string"), F.lit(":"),
                 F.when(F.col("__min") == "", F.lit("00")).otherwise(F.col("__min")),
                 F.lit(":"),
                 F.when(F.col("__sec") == "", F.lit("00")).otherwise(F.col("__sec")),
                 F.when(F.col("__frac") == "", F.lit("")).otherwise(
                     F.concat(F.lit("."), F.col("__frac")))))
    zone = F.col("__zone")
    offset = (F.when(F.coalesce(zone, F.lit("")) == "", F.lit("+00:00"))
              .when(zone.rlike(r"^[+-]\d{2}:?\d{2}$"),
                     F.regexp_replace(zone, r"^([+-]\d{2}):?(\d{2})$", "$1:$2"))
              .when(zone.rlike(r"^[+-]\d{2}$"), F.concat(zone, F.lit(":00")))
              .otherwise(F.lit("+00:00")))
    return df.withColumns({
        "__local": F.concat(_whole_year(F.get("__ymd", F.lit(0))), F.lit("-"), F.col("__month"),
                            F.lit("-"), F.get("__ymd", F.lit(2)), F.lit(" "), clock),
        "__offset": offset,
    })


def _whole_year(year: Column) -> Column:
    """Two digits below 70 are of this century, others of the last."""
    century = F.when(year < "70", F.lit("20")).otherwise(F.lit("19"))
    return F.when(F.length(year) == 2, F.concat(century, year)).otherwise(year)


def parse_mixed(df: DataFrame, source: str, target: str,
                day_first: bool = False, gap_fill: bool = False) -> DataFrame:
    """Common formats to a UTC timestamp; unparsable values become null.

    ``day_first`` decides only where both readings are possible, and ISO text
    is always year-month-day. Text without an offset is UTC; zone names are
    ignored. A time alone is null rather than a time today. ``gap_fill`` gives
    rows still null a second, free-form, day-first reading.
    """
    keep = [c for c in df.columns if c != target]
    out = _resolve(df, source, day_first, year_day_month=False)
    parsed = F.concat("__local", "__offset").try_cast("timestamp")
    if not gap_fill:
        return out.select(*[col(c) for c in keep], parsed.alias(target))
    first = out.select(*[col(c) for c in df.columns], parsed.alias("__first"))
    second = _resolve(first, source, day_first=True, year_day_month=True)
    again = F.concat("__local", "__offset").try_cast("timestamp")
    return second.select(*[col(c) for c in keep],
                         F.coalesce("__first", again).alias(target))


def parse_complex(df: DataFrame, source: str, target: str) -> DataFrame:
    """Free-form day-first text such as ``May 26, 2020, Tuesday``.

    Here the day-first preference reaches ``yyyy-..-..`` text as well.
    """
    keep = [c for c in df.columns if c != target]
    out = _resolve(df, source, day_first=True, year_day_month=True)
    return out.select(*[col(c) for c in keep],
                      F.concat("__local", "__offset").try_cast("timestamp").alias(target))


def parse_exact(c: Column, pattern: str = "yyyyMMdd") -> Column:
    """One exact pattern, anything else null; ``20200526.0`` counts as digits."""
    digits = F.regexp_replace(c.cast("string"), r"^(\d+)\.0$", "$1")
    return F.try_to_timestamp(digits, F.lit(pattern))


def parse_dates(df: DataFrame, source: str, target: str, *, pattern: str | None = None,
                complex_dates: bool = False, day_first: bool = False) -> DataFrame:
    """Pick the parser a rule asks for."""
    if complex_dates:
        return parse_complex(df, source, target)
    if pattern:
        return df.withColumn(target, parse_exact(col(source), pattern))
    return parse_mixed(df, source, target, day_first=day_first)


def to_event_date(df: DataFrame, source: str, target: str) -> DataFrame:
    """The calendar date a timestamp text shows, without moving it to UTC."""
    keep = [c for c in df.columns if c != target]
    out = _resolve(df, source, day_first=False, year_day_month=False)
    return out.select(*[col(c) for c in keep],
                      F.col("__local").try_cast("timestamp_ntz").cast("date").alias(target))


def to_iso_utc(c: Column) -> Column:
    return F.date_format(c, ISO_OUT)


def floor_to_day(c: Column) -> Column:
    return F.to_date(c)
