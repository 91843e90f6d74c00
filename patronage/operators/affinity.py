"""Affinity tables (age band x channel or keyword) out of loosely structured wide tables.

The role of each column is read off its header, which is driver metadata; the rows stay in Spark. A
layout says which cells a table has: for each value column where its age band and its item come from.
One melt then serves all layouts. Input frames carry a ``row_ord`` column with the order of their rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import (
    age_group,
    channel_name,
    header_age_group,
    keyword_name,
    parse_ratio,
    span_age_group,
)
from ..schemas import RATIO
from .keyed import dedupe_last, replace

ROW_ORDER = "row_ord"


@dataclass(frozen=True)
class Role:
    """Columns whose header holds one of the parts, and none of the others."""

    parts: tuple[str, ...]
    without: tuple[str, ...] = ()
    any_case: bool = False

    def fits(self, header: str) -> bool:
        text = header.lower() if self.any_case else header
        return any(p in text for p in self.parts) and not any(p in text for p in self.without)


# Header parts that tell the role of a column.
MEDIA_ITEM = Role(("채널", "매체", "channel", "media", "플랫폼", "platform", "service", "서비스"), any_case=True)
VIDEO_ITEM = Role(("플랫폼", "platform", "채널", "service", "서비스"), any_case=True)
INTEREST_ITEM = Role(("키워드", "keyword", "관심", "theme", "주제"), any_case=True)
MIN_AGE = Role(("최소나이", "최소 나이", "min", "최소", "min_age"))
MAX_AGE = Role(("최대나이", "최대 나이", "max", "최대", "max_age"))
MEDIUM = Role(("매체",))
CONTACT_RATE = Role(("접촉률",))
WEEKLY = Role(("주간",), without=("시간",))
TOTAL = Role(("_전체", "_개인"))
RATE_SUFFIX = "비율"


@dataclass(frozen=True)
class Kind:
    """What differs between the affinity inputs."""

    item: str
    role: Role

    def name(self, cell: Column) -> Column:
        return channel_name(cell) if self.item == "channel" else keyword_name(cell)


MEDIA, VIDEO, INTEREST = Kind("channel", MEDIA_ITEM), Kind("channel", VIDEO_ITEM), Kind("keyword", INTEREST_ITEM)


@dataclass(frozen=True)
class Sheet:
    """A wide table whose columns go by their place, since headers may differ in case only."""

    headers: list[str]
    rows: DataFrame

    @classmethod
    def of(cls, df: DataFrame) -> Sheet:
        headers = [c for c in df.columns if c != ROW_ORDER]
        places = iter(range(len(headers)))
        return cls(headers, df.toDF(*(ROW_ORDER if c == ROW_ORDER else f"c{next(places)}" for c in df.columns)))

    def all(self, *roles: Role) -> list[int]:
        return [i for i, h in enumerate(self.headers) if any(r.fits(h) for r in roles)]

    def first(self, role: Role) -> int | None:
        return next(iter(self.all(role)), None)

    def item(self, kind: Kind) -> int:
        """The column with the item names: by header, else the first one."""
        found = self.first(kind.role)
        return 0 if found is None else found

    def span(self) -> tuple[Column, Column]:
        """The youngest and the oldest age as written."""
        low, high = self.first(MIN_AGE), self.first(MAX_AGE)
        if low is None or high is None:
            raise ValueError(f"no youngest / oldest age column among {self.headers}")
        return cell(low).cast("string"), cell(high).cast("string")


def cell(place: int) -> Column:
    return F.col(f"c{place}")


@dataclass(frozen=True)
class Cell:
    """A value column with the age band and the item of its values."""

    age: Column
    item: Column
    value: int


@dataclass(frozen=True)
class SpanCell:
    """A value column of a table with an age span per row, with the column of its item's name or, where
    the item has a fixed name, that."""

    name: Column
    value: int
    label: str | None = None


def _melt(sheet: Sheet, cells: list[Cell], kind: Kind) -> DataFrame:
    """One row per cell with the text read as a ratio; those without age, item or value drop out."""
    parts = [
        F.struct(c.age.alias("age_group"), c.item.alias(kind.item), cell(c.value).cast("string").alias("text"))
        for c in cells
    ]
    rows = sheet.rows.select(ROW_ORDER, F.posexplode(F.array(*parts)).alias("col_ord", "cell"))
    # what can't count isn't read as a ratio
    rows = rows.filter(f"cell.text IS NOT NULL AND cell.age_group IS NOT NULL AND cell.`{kind.item}` IS NOT NULL")
    out = rows.select(ROW_ORDER, "col_ord", "cell.*").withColumn("affinity", parse_ratio("text")).drop("text")
    return out.dropna(subset=["age_group", kind.item, "affinity"])


def _last_cell(cells: DataFrame, kind: Kind, order: list[str]) -> DataFrame:
    last = dedupe_last(cells, ["age_group", kind.item], order)
    return last.select("age_group", kind.item, F.col("affinity").cast(RATIO).alias("affinity"))


def _mean_cells(sheet: Sheet, cells: list[SpanCell], kind: Kind) -> DataFrame:
    """Mean per age band and item, rounded once to four decimals, ties to even. In whole
    ten-thousandths, so the result does not depend on the order of rows.

    Cells that are written alike are counted first and read once, so that reading ages and ratios grows
    with the different cells and not with the rows.
    """
    low, high = sheet.span()
    parts = [
        F.struct(F.lit(c.label).alias("label"), c.name.alias("name"), cell(c.value).cast("string").alias("text")) for c in cells
    ]
    written = sheet.rows.select(low.alias("low"), high.alias("high"), F.inline(F.array(*parts))).filter("text IS NOT NULL")
    alike = written.groupBy("low", "high", "label", "name", "text").agg(F.count("*").alias("_rows"))
    item = F.when(F.col("label").isNull(), kind.name(F.col("name"))).otherwise(F.col("label"))
    # bound to the count, or Spark would move the filters, and the reading with them, to before the count
    counted = F.col("_rows") > 0
    age = F.when(counted, span_age_group("low", "high"))
    known = alike.select(age.alias("age_group"), F.when(counted, item).alias(kind.item), "text", "_rows")
    known = known.dropna(subset=["age_group", kind.item])
    unit = F.round(F.col("affinity") * 10000).cast("long")
    read = known.withColumn("affinity", F.when(counted, parse_ratio("text"))).dropna(subset=["affinity"])
    sums = read.groupBy("age_group", kind.item).agg(F.sum(unit * F.col("_rows")).alias("s"), F.sum("_rows").alias("n"))
    mean = F.expr("s div n + if(2 * (s % n) > n or (2 * (s % n) = n and (s div n) % 2 = 1), 1, 0)")
    return sums.select("age_group", kind.item, (mean.cast("decimal(10,0)") / 10000).cast(RATIO).alias("affinity"))


def by_age(df: DataFrame, kind: Kind) -> DataFrame | None:
    """Layout with one column per age label. NULL cells and unknown names drop out; of two cells
    for one key the later row, then the later column wins. None if no header names an age."""
    sheet = Sheet.of(df)
    name = kind.name(cell(sheet.item(kind)))
    bands = [(i, header_age_group(h)) for i, h in enumerate(sheet.headers)]
    cells = [Cell(F.lit(band), name, i) for i, band in bands if band]
    return _last_cell(_melt(sheet, cells, kind), kind, [ROW_ORDER, "col_ord"]) if cells else None


def ages_down(df: DataFrame, kind: Kind) -> DataFrame | None:
    """Transposed layout: ages down the item column, one column per item. Of two cells for one key the
    later column, then the later row wins, as if the table were turned first. None if the first column
    names no age."""
    sheet = Sheet.of(df)
    if df.limit(1).count() == 0 or not sheet.rows.filter(age_group(cell(0)).isNotNull()).head(1):
        return None
    ages = sheet.item(kind)
    band = age_group(cell(ages))
    cells = [Cell(band, kind.name(F.lit(h)), i) for i, h in enumerate(sheet.headers) if i != ages]
    return _last_cell(_melt(sheet, cells, kind), kind, ["col_ord", ROW_ORDER])


def media_by_span(df: DataFrame) -> DataFrame:
    """Layout with an age span per row and pairs of media and rate columns, paired by position."""
    sheet = Sheet.of(df)
    pairs = list(zip(sheet.all(MEDIUM), sheet.all(CONTACT_RATE, WEEKLY)))
    if not pairs:
        raise ValueError(f"no media / rate column pair among {sheet.headers}")
    return _mean_cells(sheet, [SpanCell(cell(m).cast("string"), r) for m, r in pairs], MEDIA)


def interest_by_span(df: DataFrame) -> DataFrame:
    """Layout with an age span per row and columns paired by name (``X`` with ``X비율`` or
    ``X_비율``); columns of totals stand for a keyword by their own header."""
    sheet = Sheet.of(df)
    place = {h: i for i, h in reversed(list(enumerate(sheet.headers)))}
    named = {i: h.removesuffix(RATE_SUFFIX).rstrip("_") for i, h in enumerate(sheet.headers) if h.endswith(RATE_SUFFIX)}
    pairs = {i: place[base] for i, base in named.items() if base in place}
    totals = [i for i in sheet.all(TOTAL) if i not in pairs]
    if not pairs and not totals:
        raise ValueError(f"no interest / rate column pair among {sheet.headers}")
    cells = [SpanCell(cell(base).cast("string"), rate) for rate, base in pairs.items()]
    cells += [SpanCell(F.lit(None).cast("string"), i, sheet.headers[i].strip()) for i in totals]
    return _mean_cells(sheet, cells, INTEREST)


def media_affinity(df: DataFrame) -> DataFrame:
    table = by_age(df, MEDIA)
    return media_by_span(df) if table is None else table


def interest_affinity(df: DataFrame) -> DataFrame:
    table = by_age(df, INTEREST)
    return interest_by_span(df) if table is None else table


def video_affinity(df: DataFrame) -> DataFrame | None:
    table = by_age(df, VIDEO)
    return ages_down(df, VIDEO) if table is None else table


def merge_sources(sources: list[DataFrame], item: str) -> DataFrame:
    """One table out of several, the later source wins a clash."""
    numbered = [s.withColumn("source_ord", F.lit(i)) for i, s in enumerate(sources)]
    both = reduce(DataFrame.unionByName, numbered)
    return dedupe_last(both, ["age_group", item], ["source_ord"]).drop("source_ord")


def load_affinity(
    media: DataFrame, interest: DataFrame, video: DataFrame | None, version: str
) -> tuple[DataFrame, DataFrame]:
    """Channel and keyword affinity of one version, video over media."""
    sources = [media_affinity(media)]
    extra = video_affinity(video) if video is not None else None
    channels = merge_sources(sources + ([extra] if extra is not None else []), "channel")
    stamp = F.lit(version).alias("version")
    return channels.select(stamp, "*"), interest_affinity(interest).select(stamp, "*")


def replace_affinity(target: DataFrame, source: DataFrame, item: str) -> DataFrame:
    """Stored table with the rows of the source in place of equal keys."""
    return replace(target, source, ["version", "age_group", item], ["version"])
