"""Text expressions: addresses, request texts, loosely written ages and ratios."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import half_even_sql

# The road pattern, the age words and the words that mean "missing".
ROAD = r"([가-힣A-Za-z0-9\- ]+(로|길))"
YOUNG_WORDS = [
    "10대", "10 대", "10s", "teens", "youth",
    "20대", "20 대", "20s", "1020", "10-20", "10~20",
]
SENIOR_WORDS = ["이상", "고령"]
# Age bands by the first of these numbers in a label; young words come before it, senior words after.
AGE_NUMBER = "(10|20|30|40|50|60)"
AGE_BAND = {"10": "10s", "20": "10s", "30": "30s", "40": "40s", "50": "50s", "60": "60p"}
# One rule list serves columns and headers: (pattern, band; None: the band of the number found).
AGE_RULES = [("|".join(YOUNG_WORDS), "10s"), (AGE_NUMBER, None), ("|".join(SENIOR_WORDS), "60p")]
NO_RATIO = ["", "None", "none", "nan", "NaN", "-999999.9", "--", "-", "na", "NA"]
NO_NAME = ["", "nan", "none"]

# Characters that count as blank, and the same as a regex class.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B)))
BLANKS += "\u2028\u2029\u202f\u205f\u3000"
BLANK = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
NO_NUMBER = r"^[+-]?(?i:nan|inf|infinity)$"
NUMBER = r"^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(text: str | Column) -> Column:
    """Drop blanks at both ends."""
    return F.btrim(_col(text), F.lit(BLANKS))


def road_name(address: str | Column) -> Column:
    """The run of words that ends in a road suffix; NULL where there is none."""
    return F.regexp_substr(_col(address), F.lit(ROAD))


def normalize_text(text: str | Column) -> Column:
    """Keep letters, digits, ``_`` and ``*``; any other run of characters becomes one blank."""
    return F.regexp_replace(strip(F.coalesce(_col(text), F.lit(""))), r"[^\p{L}\p{N}_*]+", " ")


def masked_tokens(text: str | Column) -> Column:
    """Words with a ``*`` in them, joined by blanks; NULL if there are none."""
    words = F.split(_col(text), f"[{BLANK}]+")
    starred = F.filter(words, lambda w: w.contains("*"))
    return F.nullif(F.array_join(starred, " "), F.lit(""))


def age_group(label: str | Column) -> Column:
    """Age band of a freely written age label; NULL where no age is recognised."""
    s = F.lower(strip(label))
    bands = F.create_map(*[F.lit(v) for pair in AGE_BAND.items() for v in pair])
    found = [
        F.when(s.rlike(rule), F.lit(band) if band else bands[F.regexp_substr(s, F.lit(rule))])
        for rule, band in AGE_RULES
    ]
    return F.coalesce(*found)


def header_age_group(header: str) -> str | None:
    """age_group for one column header, which is metadata on the driver."""
    text = header.strip().lower()
    hits = ((re.search(rule, text), band) for rule, band in AGE_RULES)
    return next((band or AGE_BAND[hit[0]] for hit, band in hits if hit), None)


def parse_ratio(column: str) -> Column:
    """A ratio in [0, 1] to four decimals out of texts such as ``35``, ``0.35``, ``35%``, ``1,2``.

    Above 1 the number is taken as a percent. Missing words, other texts and anything outside the
    range give NULL. The steps are nested one-element transforms, so that each is worked out once
    however often the next one mentions it.
    """
    blanks = "'" + "".join(f"\\u{ord(c):04x}" for c in BLANKS) + "'"
    missing = ", ".join(f"'{w}'" for w in NO_RATIO)
    steps = [
        ("bare", f"replace(btrim(cast({column} AS STRING), {blanks}), ',', '')"),
        ("digits", f"if(bare IN ({missing}), NULL, btrim(regexp_replace(bare, '%$', ''), {blanks}))"),
        ("value", f"if(digits RLIKE r'{NUMBER}', try_cast(replace(digits, '_', '') AS DOUBLE), NULL)"),
        ("part", "if(value > 1, value / 100D, value)"),
        ("ratio", f"if(part BETWEEN 0 AND 1, {half_even_sql('part', 4)}, NULL)"),
    ]
    sql = steps[0][1]
    for (name, _), (_, step) in zip(steps, steps[1:]):
        sql = f"transform(array({sql}), {name} -> {step})[0]"
    return F.expr(sql)


def number(text: Column) -> Column:
    """A number text as a double; NULL for texts that only the JVM takes for numbers (`30d`)."""
    bare = strip(text)
    return F.when(bare.rlike(NUMBER) | bare.rlike(NO_NUMBER), F.replace(bare, F.lit("_"), F.lit("")).try_cast("double"))


def span_age_group(youngest: str | Column, oldest: str | Column) -> Column:
    """Age band of the middle of an age span. A missing end counts as the oldest band, a text that
    is not a number gives NULL."""
    low, high = _col(youngest).cast("string"), _col(oldest).cast("string")
    a, b = number(low), number(high)
    readable = (low.isNull() | a.isNotNull()) & (high.isNull() | b.isNotNull())
    middle = (a + b) / 2.0
    return F.when(
        readable,
        F.when(middle < 30, "10s").when(middle < 40, "30s").when(middle < 50, "40s").when(middle < 60, "50s")
        .otherwise("60p"),
    )


def channel_name(cell: str | Column) -> Column:
    """Channel key: lower case, blanks as ``_``; NULL for a missing name."""
    name = F.lower(strip(_col(cell).cast("string")))
    return F.when(~name.isin(NO_NAME), F.replace(name, F.lit(" "), F.lit("_")))


def keyword_name(cell: str | Column) -> Column:
    """Keyword key: blanks dropped, case kept; NULL for a missing keyword."""
    word = strip(_col(cell).cast("string"))
    return F.when(~F.lower(word).isin(NO_NAME), F.replace(word, F.lit(" "), F.lit("")))
