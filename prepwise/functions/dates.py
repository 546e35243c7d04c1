"""Date parsing as a chain of JVM expressions (no per-row Python)."""
from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from prepwise.functions.text import WS

S = WS + "*"
CN_YMD = "(\\d{4})" + S + "年" + S + "(\\d{1,2})" + S + "月" + S + "(\\d{1,2})" + S + "日"
CN_YM = "(\\d{4})" + S + "年" + S + "(\\d{1,2})" + S + "月"
CN_MD = "(\\d{1,2})" + S + "月" + S + "(\\d{1,2})" + S + "日"

# The general spellings (T9): a date part, an optional weekday before it and an optional time after
# it.  The time may have seconds, 1-9 fraction digits, AM/PM and a zone; the wall clock is kept
# as written, the zone is dropped.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
MONTH = ("(?:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|June?|July?|Aug(?:ust)?|"
         "Sept?(?:ember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?)")
WEEKDAY = "(?:(?:Mon|Tues?|Wed(?:nes)?|Thu(?:rs)?|Fri|Sat(?:ur)?|Sun)(?:day)?,?" + S + ")?"
TIME = ("([0-9]{1,2}):([0-9]{2})(?::([0-9]{2})(?:[.,]([0-9]{1,9}))?)?" + S + "([AaPp]\\.?[Mm]\\.?)?" + S
        + "(?:Z|UTC|GMT|[+-][0-9]{2}:?[0-9]{2})?")
AFTER = "(?:(?:T|,?" + WS + "+)" + TIME + ")?$"
ORD = "(?:st|nd|rd|th)?"
# spelling -> groups of year, month and day (0: missing), group of the hour
GENERAL_SHAPES = [
    ("([0-9]{4})[-/.]([0-9]{1,2})[-/.]([0-9]{1,2})" + AFTER, 1, 2, 3, 4),
    ("([0-9]{4})[-/.]([0-9]{1,2})" + AFTER, 1, 2, 0, 3),
    ("([0-9]{1,2})[-/.]([0-9]{1,2})[-/.]([0-9]{4}|[0-9]{2})" + AFTER, 3, 1, 2, 4),
    ("(" + MONTH + ")\\.?" + S + "([0-9]{1,2})" + ORD + ",?" + WS + "+([0-9]{4})" + AFTER, 3, 1, 2, 4),
    ("(" + MONTH + ")\\.?" + WS + "+([0-9]{1,2})" + ORD + AFTER, 0, 1, 2, 3),
    ("(" + MONTH + ")\\.?,?" + WS + "+([0-9]{4})$", 2, 1, 0, 0),
    ("([0-9]{1,2})" + ORD + "(?:-|" + WS + "+)(" + MONTH + ")\\.?,?(?:-|" + WS + "+)([0-9]{4}|[0-9]{2})" + AFTER, 3, 2, 1, 4),
    ("([0-9]{1,2})" + ORD + WS + "+(" + MONTH + ")$", 0, 2, 1, 0),
]
CTIME = "(" + MONTH + ")" + WS + "+([0-9]{1,2})" + WS + "+" + TIME + WS + "+([0-9]{4})$"
LONGEST_DATE = 256         # blank runs collapsed, only a fraction of second of some 200 digits is longer; prose is not matched against the shapes

# Candidate single formats for role detection (one hit rate each).
DETECT_FORMATS = [
    "yyyy-M-d", "yyyy/M/d", "yyyy-M-d H:mm:ss", "yyyy/M/d H:mm:ss", "yyyy-M-d H:mm",
    "yyyy-M-d'T'H:mm:ss", "M/d/yyyy", "d/M/yyyy", "M/d/yyyy H:mm:ss", "yyyyMMdd",
    "yyyy年M月d日", "MMM d, yyyy",
]


def shape_regex(fmt: str) -> str:
    """A cheap regex that every string the pattern can parse must match.

    Failed parses are exceptions inside the JVM parser, so testing the shape
    first keeps non-dates (most cells of most columns) off that slow path."""
    out, i = ["^"], 0
    while i < len(fmt):
        ch = fmt[i]
        j = i
        while j < len(fmt) and fmt[j] == ch:
            j += 1
        run = j - i
        if ch == "'":
            k = fmt.index("'", i + 1)
            out.append(re.escape(fmt[i + 1:k]))
            i = k + 1
            continue
        if ch == "y":
            out.append("[0-9]{4}" if run >= 4 else "[0-9]{2}")
        elif ch in "MdHhms" and run <= 2 and not (ch == "M" and run > 2):
            out.append("[0-9]{2}" if run == 2 and ch in "ms" or (run == 2 and fixed_width(fmt)) else "[0-9]{1,2}")
        elif ch == "M":
            out.append("[A-Za-z]{3}" if run == 3 else "[A-Za-z]+")
        elif ch == "S":
            out.append("[0-9]{%d}" % run)
        elif ch.isascii() and ch.isalpha():
            out.append(".+")
        else:
            out.append(re.escape(ch) * run)
        i = j
    out.append("$")
    return "".join(out)


def fixed_width(fmt: str) -> bool:
    """Patterns without separators (yyyyMMdd) need fixed-width fields."""
    return not any(c in fmt for c in "-/.: ,年月日T'")


def try_format(c: Column, fmt: str) -> Column:
    return F.when(c.rlike(shape_regex(fmt)), F.try_to_timestamp(c, F.lit(fmt)))


def _ymd(y: Column, m: Column, d: Column) -> Column:
    return F.try_to_timestamp(F.concat_ws("-", y, m, d), F.lit("y-M-d"))


def _number(c: Column) -> Column:
    return c.try_cast("int")


def _month(c: Column) -> Column:
    name = F.lower(F.substring(c, 1, 3))
    return F.coalesce(_number(c), F.nullif(F.array_position(F.array(*[F.lit(m) for m in MONTHS]), name), F.lit(0)).cast("int"))


def _year(c: Column, current_year: int) -> Column:
    """Two digits mean the year nearest to the current one (less than 50 years ahead)."""
    y = _number(c)
    near = y + F.lit(current_year // 100 * 100)
    near = F.when(near >= current_year + 50, near - 100).when(near < current_year - 50, near + 100).otherwise(near)
    return F.when(F.length(c) <= 2, near).otherwise(y)


_GAP = "\x01"              # between the groups of a match: no shape takes it


def _stamp(s: Column, pattern: str, y: int, m: int, d: int, h: int, current_year: int) -> Column:
    """The time that a matching cell names; the pattern runs once, for all its groups together."""
    last = max(y, m, d, h + 4 if h else 0)
    groups = F.split(F.regexp_replace(s, pattern, "".join(f"${i}{_GAP}" for i in range(1, last + 1))), _GAP)
    return F.transform(F.array(groups), lambda found: _of_groups(lambda i: found[i - 1], pattern, y, m, d, h, current_year))[0]


def _of_groups(g, pattern: str, y: int, m: int, d: int, h: int, current_year: int) -> Column:
    year = _year(g(y), current_year) if y else F.lit(current_year)
    month = _month(g(m))
    day = _number(g(d)) if d else F.lit(1)
    if pattern.startswith("(?i)^" + WEEKDAY + "([0-9]{1,2})[-/.]"):
        month, day = F.when(month > 12, day).otherwise(month), F.when(month > 12, month).otherwise(day)    # day first
    hour, minute, second = F.lit(0), F.lit(0), F.lit(0).cast("decimal(16,6)")
    if h:
        hour, minute = F.coalesce(_number(g(h)), F.lit(0)), F.coalesce(_number(g(h + 1)), F.lit(0))
        fraction = F.substring(F.concat(g(h + 3), F.lit("000000")), 1, 6)
        second = F.coalesce(F.concat(g(h + 2), F.lit("."), fraction).try_cast("decimal(16,6)"), F.lit(0).cast("decimal(16,6)"))
        half = F.upper(F.substring(g(h + 4), 1, 1))
        hour = F.when(half == "P", F.when(hour == 12, 12).when(hour < 12, hour + 12)).when(
            half == "A", F.when(hour == 12, 0).when(hour < 12, hour)).otherwise(hour)
    return F.try_make_timestamp(year, month, day, hour, minute, second)


def try_parse(c: Column, current_year: int) -> Column:
    """The first general spelling that fits; parts that are missing are those of January 1 of the
    current year; month first where a date of numbers can be read both ways."""
    c = F.when(F.length(c) <= LONGEST_DATE, c).otherwise(F.regexp_replace(c, WS + "{2,}", " "))
    shapes = [("(?i)^" + WEEKDAY + p, *rest) for p, *rest in GENERAL_SHAPES]
    shapes.append(("(?i)^" + WEEKDAY + CTIME, 8, 1, 2, 3))
    out = F.when(F.lit(False), F.lit(None).cast("timestamp"))
    for pattern, y, m, d, h in shapes:
        out = out.when(c.rlike(pattern), _stamp(c, pattern, y, m, d, h, current_year))
    return F.when(F.length(c) <= LONGEST_DATE, out)


def parse_date_text(c: Column, current_year: int, general: bool = True) -> Column:
    """T4–T9 on a string column: Chinese spellings (searched anywhere),
    compact digits, then the general format list."""
    s = F.trim(F.regexp_replace(c, "^" + WS + "+|" + WS + "+$", ""))
    cn = s.contains("月")      # in all Chinese spellings: the searches stay off other cells
    ymd = F.when(cn & s.rlike(CN_YMD), _ymd(F.regexp_extract(s, CN_YMD, 1), F.regexp_extract(s, CN_YMD, 2),
                                          F.regexp_extract(s, CN_YMD, 3)))
    ym = F.when(cn & s.rlike(CN_YM), _ymd(F.regexp_extract(s, CN_YM, 1), F.regexp_extract(s, CN_YM, 2), F.lit("1")))
    md = F.when(cn & s.rlike(CN_MD), _ymd(F.lit(str(current_year)), F.regexp_extract(s, CN_MD, 1),
                                     F.regexp_extract(s, CN_MD, 2)))
    compact8 = F.when(s.rlike("^[0-9]{8}$"), F.try_to_timestamp(s, F.lit("yyyyMMdd")))
    compact14 = F.when(s.rlike("^[0-9]{14}$"), F.try_to_timestamp(s, F.lit("yyyyMMddHHmmss")))
    parts = [ymd, ym, md, compact8, compact14]
    if general:
        parts.append(try_parse(s, current_year))
    return F.coalesce(*parts)


def looks_like_date(c: Column, current_year: int) -> tuple[Column, Column]:
    """(Chinese-pattern hit count, any-parse hit) per cell, for content detection."""
    s = c.cast("string")
    cn = F.when(s.contains("月"), s.rlike(CN_YMD).cast("int") + s.rlike(CN_YM).cast("int") + s.rlike(CN_MD).cast("int")).when(s.isNotNull(), 0)
    parsed = parse_date_text(s, current_year).isNotNull().cast("int")
    return cn, parsed


def py_to_java_format(fmt: str) -> str:
    """strftime → Spark datetime pattern for the common directives."""
    table = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss",
             "%y": "yy", "%b": "MMM", "%B": "MMMM", "%f": "SSSSSS"}
    out, i = [], 0
    while i < len(fmt):
        two = fmt[i:i + 2]
        if two in table:
            out.append(table[two])
            i += 2
        else:
            ch = fmt[i]
            out.append("'" + ch + "'" if ch.isalpha() else ch)
            i += 1
    return "".join(out)
