"""Mixed-format timestamps to ISO-8601 UTC."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from twinledger.functions.text import strip_ws
from twinledger.schema import EPOCH_MS_THRESHOLD, ISO_UTC_FORMAT

# Whole numbers of up to 13 digits; more would be milliseconds beyond the range below.
_EPOCH_SHAPE = r"^0*[0-9]{1,13}$"
_LATEST_SECONDS = 9_223_372_036
_LATEST_MS = 9_223_372_036_854

# The years a 64-bit count of nanoseconds since 1970 reaches.
_YEAR = r"(?:167[7-9]|16[89]\d|1[7-9]\d\d|2[01]\d\d|22[0-5]\d|226[0-2])"

# A calendar date must lead, so that a bare time of day is not read as "today".
_ISO_SHAPE = rf"^{_YEAR}-\d{{1,2}}(-\d{{1,2}}([T ].*)?)?$"
_FREE_FORM_SHAPE = rf"\d.*\b{_YEAR}\b|^{_YEAR}/|[A-Za-z]{{3}} .*\b{_YEAR}\b|^\d{{1,2}}/\d{{1,2}}/\d\d\b"
_COMPACT_SHAPE = rf"^{_YEAR}\d{{4}}T\d{{6}}Z?$"
# A day of the week in front and a zone word behind say nothing more.
_AROUND = r"^[A-Za-z]{3,9}, (?=\d)| (?:GMT|UTC|Z)$"
_CENTURY_TURNS = 2068

# Texts that already are what ``format_iso_utc`` writes; the 29th of February goes the long way.
_DAY_OF_MONTH = r"(?:(?:0[1-9]|1[0-2])-(?:0[1-9]|1\d|2[0-8])|(?:0[13-9]|1[0-2])-(?:29|30)|(?:0[13578]|1[02])-31)"
_NORMAL_SHAPE = rf"^{_YEAR}-{_DAY_OF_MONTH}T(?:[01]\d|2[0-3]):[0-5]\d:[0-5]\dZ\z"

_NAMED = r"^[A-Za-z]{3} "
_AFTERNOON = r"(?i) [AP]M$"
#: Shape of a free-form text, and the one layout that can read it. The first shape that fits decides.
#: Month comes first in the numeric ones.
FREE_FORM_LAYOUTS = [
    (rf"^\d+/\d+/\d{{4}} .*{_AFTERNOON}", "M/d/yyyy h:mm[:ss] a"),
    (r"^\d+/\d+/\d{4}", "M/d/yyyy[ H:mm[:ss[.SSSSSS][.SSS]]]"),
    (r"^\d+-\d+-\d{4}", "M-d-yyyy[ H:mm[:ss]]"),
    (r"^\d{4}/", "yyyy/M/d[ H:mm[:ss]]"),
    (r"^\d+ [A-Za-z]{3} ", "d MMM yyyy[ H:mm[:ss]]"),
    (r"^\d+ [A-Za-z]+ ", "d MMMM yyyy[ H:mm[:ss]]"),
    (r"^\d+-[A-Za-z]", "d-MMM-yyyy[ H:mm[:ss]]"),
    (rf"{_NAMED}.*{_AFTERNOON}", "MMM d[,] yyyy h:mm[:ss] a"),
    (_NAMED, "MMM d[,] yyyy[ H:mm[:ss]]"),
    (rf"^[A-Za-z]+ \d.*{_AFTERNOON}", "MMMM d[,] yyyy h:mm[:ss] a"),
    (r"^[A-Za-z]+ \d", "MMMM d[,] yyyy[ H:mm[:ss]]"),
]
_TWO_DIGIT_YEAR_SHAPE = r"^\d{1,2}/\d{1,2}/\d\d\b"
_TWO_DIGIT_YEAR_LAYOUT = "M/d/yy[ H:mm[:ss]]"


def _from_epoch(text: Column) -> Column:
    number = text.cast("bigint")
    return F.when(
        number > EPOCH_MS_THRESHOLD,
        F.when(number <= _LATEST_MS, F.timestamp_micros(number * 1_000)),
    ).when(number <= _LATEST_SECONDS, F.timestamp_micros(number * 1_000_000))


def _free_form(text: Column, bare: Column) -> Column:
    """The layout that the text's shape names, and no other: a text that a layout cannot read costs an exception."""
    short = F.try_to_timestamp(bare, F.lit(_TWO_DIGIT_YEAR_LAYOUT))
    # Two digits from 69 on are of the last century.
    short = F.when(F.year(short) > _CENTURY_TURNS, short - F.expr("INTERVAL 100 YEARS")).otherwise(short)
    found = F.when(text.rlike(_TWO_DIGIT_YEAR_SHAPE), short)
    for shape, layout in FREE_FORM_LAYOUTS:
        found = found.when(bare.rlike(shape), F.try_to_timestamp(bare, F.lit(layout)))
    return found


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once however often it is used.

    An expression that repeats another is written out in full by Spark, and past 8,000 bytes the JVM no longer compiles it.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def parse_timestamp(c: Column) -> Column:
    """Epoch seconds or milliseconds, ISO text, or a known free-form layout; else NULL.

    A text is classed by its shape once, and then read by one parser.
    """

    def read(text: Column) -> Column:
        compact = F.try_to_timestamp(F.regexp_replace(text, "Z$", ""), F.lit("yyyyMMdd'T'HHmmss"))
        free_form = _bound(F.regexp_replace(text, _AROUND, ""), lambda bare: _free_form(text, bare))
        return (
            F.when(text.rlike(_ISO_SHAPE), text.try_cast("timestamp"))
            .when(text.rlike(_EPOCH_SHAPE), _from_epoch(text))
            .when(text.rlike(_COMPACT_SHAPE), compact)
            .when(text.rlike(_FREE_FORM_SHAPE), free_form)
        )

    return _bound(strip_ws(c), read)


def format_iso_utc(ts: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ssZ``; fractions of a second are dropped."""
    return F.date_format(ts, ISO_UTC_FORMAT)


def normalize_iso8601(c: Column) -> Column:
    """Text in any known layout as ``yyyy-MM-ddTHH:mm:ssZ``; what has that form already is not parsed."""
    return F.when(c.rlike(_NORMAL_SHAPE), c).otherwise(format_iso_utc(parse_timestamp(c)))
