"""Numbers, booleans, dates and their rendering as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldlens.functions.steps import compose
from fieldlens.functions.text import (ASCII_SPACE, PHRASE_KEY_STEPS, SPACE, VALUE_KEY_STEPS, is_ascii, is_null_second,
                                      strip_space, value_key)

# Accepted spellings of yes and no (first pack, second pack).
TRUE_WORDS = ("oui", "true", "vrai", "1", "yes", "o", "y", "t")
FALSE_WORDS = ("non", "false", "faux", "0", "no", "n", "f")
TRUE_WORDS_SECOND = TRUE_WORDS + ("x",)
FALSE_WORDS_SECOND = FALSE_WORDS

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _plain_number(text: Column) -> Column:
    """Double for plain number text only: a bare cast would also take '1d', 'NaN' and 'Infinity'."""
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def _finite(number: Column) -> Column:
    return F.when(F.abs(number) < float("inf"), number)


def _no_space(c: Column) -> Column:
    return F.when(is_ascii(c), F.regexp_replace(c, ASCII_SPACE, "")).otherwise(F.regexp_replace(c, SPACE, ""))


def _dot(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit("."))


def _no_underscore(c: Column) -> Column:
    return F.regexp_replace(c, r"(?<=\d)_(?=\d)", "")


# Number of the first pack: all blanks removed, comma accepted; null when not finite.
NUMBER_STEPS = [_no_space, lambda c: _no_underscore(_dot(c)), _plain_number, _finite]
number_first = compose(NUMBER_STEPS)


# Number of the second pack: comma accepted, plain blanks removed.
NUMBER_SECOND_STEPS = [
    lambda c: F.when(~is_null_second(c), F.replace(_dot(c), F.lit(" "), F.lit(""))), strip_space, _plain_number, _finite]
number_second = compose(NUMBER_SECOND_STEPS)


def bad_number_second(c: Column) -> Column:
    return ~is_null_second(c) & number_second(c).isNull()


def _yes_no(key: Column) -> Column:
    return F.when(key.isin(*TRUE_WORDS), True).when(key.isin(*FALSE_WORDS), False)


def _yes_no_second(key: Column) -> Column:
    return F.when(key.isin(*TRUE_WORDS_SECOND), True).when(key.isin(*FALSE_WORDS_SECOND), False)


BOOL_STEPS = [*VALUE_KEY_STEPS, _yes_no]
bool_first = compose(BOOL_STEPS)
# a null token is no word of either list, so it needs no test of its own
BOOL_SECOND_STEPS = [*PHRASE_KEY_STEPS, _yes_no_second]
bool_second = compose(BOOL_SECOND_STEPS)


def bad_bool_second(c: Column) -> Column:
    return ~is_null_second(c) & bool_second(c).isNull()


# Number behind a value that different file formats write differently ('5', '5.0'); null for other text.
COMPARABLE_NUMBER_STEPS = [strip_space, lambda c: _no_underscore(_dot(c)), _plain_number, _finite]


def comparable(c: Column) -> Column:
    """Value for equality tests across file formats: numbers by value, the rest by key, null as ''."""
    return F.coalesce(compose(COMPARABLE_NUMBER_STEPS)(c).cast("string"), value_key(c))


ISO_DATE = r"^\d{4}(-\d{1,2}(-\d{1,2})?)?$"
ISO_STAMP = r"^\d{4}-\d{1,2}-\d{1,2}[T ]\d{1,2}(:\d{1,2}(:\d{1,2}([.,]\d+)?)?)?$"
OFFSET = r"(?<=\d)\s*(Z|UTC|[+-]\d{2}:?(\d{2})?)$"
DAY_FIRST = r"^(\d{1,2})[/.\- ](\d{1,2})[/.\- ](\d{4}|\d{2})(?:[T ,]+(\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?))?$"
DAY_NAME_MONTH = r"(?i)^(\d{1,2})[ \-.]+([a-z]{3})[a-z]*[ \-.,]+(\d{4})(?:[T ,]+(\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?))?$"
NAME_MONTH_DAY = r"(?i)^([a-z]{3})[a-z]*[ \-.]+(\d{1,2})[ \-.,]+(\d{4})(?:[T ,]+(\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?))?$"
SLASH_YEAR_FIRST = r"^(\d{4})[/.](\d{1,2})[/.](\d{1,2})(?:[T ,]+(\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?))?$"
MONTH_NAMES = "janfebmaraprmayjunjulaugsepoctnovdec"


def _stamp(year: Column, month: Column, day: Column, clock: Column) -> Column:
    text = F.concat(year, F.lit("-"), month, F.lit("-"), day, F.lit(" "),
                    F.when(clock == "", "00:00").otherwise(clock))
    return text.try_cast("timestamp_ntz")


def _wall_time(t: Column) -> Column:
    return F.when(t.rlike(r"\d:\d{2}|T\d"), F.regexp_replace(t, OFFSET, "")).otherwise(t)


def _iso(t: Column) -> Column:
    dashed = F.regexp_replace(t, r"^(\d{4})(\d{2})(\d{2})(?=$|T)", "$1-$2-$3")
    full = F.replace(F.regexp_replace(dashed, r"([T ]\d{1,2})$", "$1:00"), F.lit(","), F.lit("."))
    return F.when(dashed.rlike(f"{ISO_DATE}|{ISO_STAMP}"), full.try_cast("timestamp_ntz"))


def _day_first(t: Column) -> Column:
    first, second, year, clock = (F.regexp_extract(t, DAY_FIRST, i) for i in (1, 2, 3, 4))
    year = F.when(F.length(year) == 4, year).otherwise(
        F.concat(F.when(year.try_cast("int") <= 68, "20").otherwise("19"), year))
    swap = second.try_cast("int") > 12
    return F.when(t.rlike(DAY_FIRST), _stamp(year, F.when(swap, first).otherwise(second),
                                             F.when(swap, second).otherwise(first), clock))


def _named_month(t: Column) -> Column:
    def named(pattern, day_at, month_at):
        at = F.instr(F.lit(MONTH_NAMES), F.lower(F.regexp_extract(t, pattern, month_at)))
        month = F.when((at > 0) & (at % 3 == 1), ((at + 2) / 3).cast("int").cast("string"))
        return F.when(t.rlike(pattern), _stamp(F.regexp_extract(t, pattern, 3), month,
                                               F.regexp_extract(t, pattern, day_at), F.regexp_extract(t, pattern, 4)))
    year_first = F.when(t.rlike(SLASH_YEAR_FIRST), _stamp(*(F.regexp_extract(t, SLASH_YEAR_FIRST, i) for i in (1, 2, 3, 4))))
    return F.coalesce(named(DAY_NAME_MONTH, 1, 2), named(NAME_MONTH_DAY, 2, 1), year_first)


def _as_parsed(t: Column) -> Column:
    return F.struct(t.alias("t"), _iso(t).alias("d"))


# Timestamp without zone: ISO 8601 first, then day-first forms; the wall time of an offset is kept.
DATE_STEPS = [
    strip_space, _wall_time, _as_parsed,
    lambda s: F.struct(s["t"].alias("t"), F.coalesce(s["d"], _day_first(s["t"])).alias("d")),
    lambda s: F.coalesce(s["d"], _named_month(s["t"]))]
parse_date = compose(DATE_STEPS)


def _sci_to_general(sci: Column) -> Column:
    power = F.regexp_extract(sci, "e([+-][0-9]+)$", 1).try_cast("int")
    plain = sci.try_cast("decimal(38,15)").cast("string")
    short = F.regexp_replace(sci, r"\.?0*(e[+-][0-9]+)$", "$1")
    return F.when((power < -4) | (power >= 6), short).otherwise(F.regexp_replace(plain, r"(\.\d*?)0+$|\.$", "$1"))


def _digits(c: Column) -> Column:
    """17 significant digits of a double, and on which side of their decimal text its binary value lies."""
    size = F.abs(c)
    shown = F.concat(F.lit("0."), F.regexp_extract(c.cast("string"), r"^-?\d+\.(\d+)$", 1)).try_cast("double")
    return F.when(c.isNotNull(), F.struct(F.format_string("%.16e", c).alias("s"), F.coalesce(
        F.signum(size - F.floor(size) - shown), F.lit(0.0)).alias("side")))


def _six_digits(p: Column) -> Column:
    """Head of six digits rounded as C does: by the binary value, exact ties to even."""
    m = F.regexp_replace(F.regexp_extract(p["s"], "^-?(.*)e", 1), r"\.", "")
    head, rest = F.substring(m, 1, 6).try_cast("long"), F.substring(m, 7, 11)
    tie = F.lit("50000000000")
    up = (rest > tie) | ((rest == tie) & ((p["side"] > 0) | ((p["side"] == 0) & (head % 2 == 1))))
    return F.when(p.isNotNull(), F.struct(F.when(F.startswith(p["s"], F.lit("-")), "-").otherwise("").alias("sign"),
                                          (head + up.cast("long")).alias("head"),
                                          F.regexp_extract(p["s"], "e(.*)$", 1).try_cast("int").alias("e")))


def _sci_text(p: Column) -> Column:
    carried = p["head"] == 1000000
    digits, e = F.when(carried, "100000").otherwise(p["head"].cast("string")), p["e"] + carried.cast("int")
    digits = F.lpad(digits, 6, "0")
    return F.concat(p["sign"], F.substring(digits, 1, 1), F.lit("."), F.substring(digits, 2, 5), F.lit("e"),
                    F.when(e < 0, "-").otherwise("+"), F.lpad(F.abs(e).cast("string"), 2, "0"))


# A number in its shortest 6-digit form, as ``%g`` writes it.
GENERAL_STEPS = [_digits, _six_digits, _sci_text, _sci_to_general, lambda t: F.regexp_replace(t, r"\.$", "")]


general_format = compose(GENERAL_STEPS)


def double_text(c: Column) -> Column:
    """Shortest text of a double with the exponent limits of Python's ``str``."""
    text = c.cast("string")
    whole = F.regexp_replace(text.try_cast("decimal(38,18)").cast("string"), r"(\.\d+?)0+$", "$1")
    sci = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(text), r"\.0e", "e"), r"e(\d)", "e+$1"), r"e([+-])(\d)$", "e$10$2")
    return F.when(~F.contains(text, F.lit("E")), text).when(F.abs(c).between(1e-4, 9.999999999999998e15), whole).otherwise(sci)


def day_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """Share in percent, half-even as numpy rounds."""
    return F.bround(100 * part / whole, digits)
