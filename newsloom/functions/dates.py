"""Date layouts with readable placeholders.

A layout such as ``{DAY_NUM} {MONTH_LONG} {YEAR_LONG}`` is translated once on
the driver into a regular expression and a replacement string. On the cluster a
single ``regexp_replace`` per row, with both given as columns, normalises the
text into separated fields, so sites with different layouts share one plan.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.urls import let

# English names as printed in dates.
MONTHS = (
    "January", "February", "March", "April", "May", "June", "July",
    "August", "September", "October", "November", "December",
)
DAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

# Placeholder -> (accepted text, field it sets or None).
# Possessive digits: a number takes two digits whenever two are there.
PLACEHOLDERS = {
    "DAY_LONG": ("(?i:" + "|".join(DAYS) + ")", None),
    "DAY_SHORT": ("(?i:" + "|".join(d[:3] for d in DAYS) + ")", None),
    "DAY_NUM": (r"(\d{1,2}+)", "day"),
    "MONTH_LONG": ("((?i:" + "|".join(MONTHS) + "))", "month"),
    "MONTH_SHORT": ("((?i:" + "|".join(m[:3] for m in MONTHS) + "))", "month"),
    "MONTH_NUM": (r"(\d{1,2}+)", "month"),
    "YEAR_LONG": (r"(\d{4})", "year"),
    "YEAR_SHORT": (r"(\d{2})", "year"),
    "HOURS": (r"(\d{1,2}+)", "hour"),
    "MINUTES": (r"(\d{2})", "minute"),
    "SECONDS": (r"(\d{2})(?:[.,]\d++)?", "second"),
    "ZONE_OFFSET": (r"[+-](?:[01]\d|2[0-4])[0-5]\d", None),
    "ZONE_ABBREV": (r"(?:GMT[+-]\d{1,2}+|[+-]\d{1,2}+|ChST|MeST|[A-Z]{3,4}+)", None),
}
FIELDS = ("year", "month", "day", "hour", "minute", "second")
SEPARATOR = "\x01"
_TOKEN = re.compile(r"\{([A-Z_]+)\}| +|.", re.S)


@dataclass(frozen=True)
class DateLayout:
    """What the cluster needs to read one layout."""

    pattern: str
    rewrite: str


def translate_layout(layout: str, default_year: int | None = None) -> DateLayout:
    """Layout -> regex and rewrite. A layout needs a year or a ``default_year``.

    Unknown text stays literal; a run of spaces accepts any run of spaces; when
    a field occurs twice the later one counts.
    """
    pattern, group_of, groups = "", {}, 0
    for token in _TOKEN.finditer(layout):
        name = token.group(1)
        if name in PLACEHOLDERS:
            accepted, field = PLACEHOLDERS[name]
            pattern += accepted
            if field:
                groups += 1
                group_of[field] = groups
        elif token.group().isspace() and token.group().strip(" ") == "":
            pattern += " *" if token.end() == len(layout) else " +"
        else:
            pattern += re.escape(token.group())
    if "year" not in group_of and default_year is None:
        raise ValueError(f"date format {layout!r} has no year and no default_year is set")
    defaults = {"year": f"{default_year:04d}" if default_year is not None else "", "month": "1",
                "day": "1", "hour": "0", "minute": "0", "second": "0"}
    rewrite = SEPARATOR.join(
        f"${group_of[f]}" if f in group_of else defaults[f]
        for f in FIELDS
    )
    return DateLayout(pattern=r"\A" + pattern + r"\z", rewrite=rewrite)


def parse_date(
    text: Column, pattern: Column, rewrite: Column, layouts: list[tuple[str, str]] | None = None
) -> Column:
    """The printed calendar date, null when the text does not follow the layout.

    Offsets and zone names are checked but never shift the date. A pattern from a
    column is compiled whenever it differs from the row before; ``layouts``, all the
    (pattern, rewrite) that occur, give each a branch with literals instead.
    """
    clean = F.translate(text, SEPARATOR, "")
    if layouts is None:
        fields = F.regexp_replace(clean, pattern, rewrite)
    else:
        fields = F.lit(None).cast("string")
        for known, wanted in layouts:
            here = (pattern == known) & (rewrite == wanted)
            fields = F.when(here, F.regexp_replace(clean, F.lit(known), F.lit(wanted))).otherwise(fields)
    return let(F.split(fields, SEPARATOR), _date_of)


def _date_of(fields: Column) -> Column:
    year, month = F.get(fields, F.lit(0)), F.lower(F.get(fields, F.lit(1)))
    short_months = F.array(*[F.lit(m[:3].lower()) for m in MONTHS])
    # two-digit years pivot at 69
    century = F.when(F.length(year) > 2, 0).when(year >= "69", 1900).otherwise(2000)
    full_year = year.try_cast("int") + century
    month_number = F.when(
        month.rlike("^[0-9]+$"), month.try_cast("int")
    ).otherwise(F.array_position(short_months, F.substring(month, 1, 3)).cast("int"))
    day, hour, minute, second = (F.get(fields, F.lit(i)).try_cast("int") for i in range(2, 6))
    followed = (F.size(fields) == len(FIELDS)) & (hour < 24) & (minute < 60) & (second < 60)
    printed = F.format_string("%04d-%02d-%02d", full_year, month_number, day)
    return F.when(followed & (full_year > 0), F.try_to_date(printed, "yyyy-MM-dd"))


def zero_date() -> Column:
    return F.lit("0001-01-01").cast("date")
