"""CSV input: every column as text, charset found by a strict check, missing words to NULL."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

# Cell texts that count as missing.
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
KOREAN = "x-windows-949"  # JVM name of cp949, which contains euc-kr


@contextmanager
def _settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Settings of the session that hold inside a block only."""
    names = {k: k.replace("__", ".") for k in values}
    before = {k: spark.conf.get(name) for k, name in names.items()}
    for k, name in names.items():
        spark.conf.set(name, values[k])
    try:
        yield
    finally:
        for k, name in names.items():
            spark.conf.set(name, before[k])


def detect_charsets(spark: SparkSession, path: str) -> dict[str, str]:
    """Charset by file, off one pass: UTF-8 if every line decodes as such, else cp949 if every line
    does, else an error. A wrong charset would not fail later on but give replacement characters."""
    with _settings(spark, spark__sql__legacy__javaCharsets="true", spark__sql__legacy__codingErrorAction="true"):
        korean = F.decode(F.col("value").cast("binary"), KOREAN)
        lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value")
        verdicts = lines.groupBy("file").agg(
            F.bool_and(F.is_valid_utf8("value")).alias("utf8"), F.bool_and(~korean.contains("�")).alias("korean")
        )
        found = verdicts.collect()  # one row a file
    for r in found:
        if not (r["utf8"] or r["korean"]):
            raise ValueError(f"{r['file']} is neither UTF-8 nor cp949")
    return {r["file"]: "UTF-8" if r["utf8"] else KOREAN for r in found}


def blank_missing(df: DataFrame) -> DataFrame:
    """Missing words to NULL in every text column."""
    return df.select(
        [
            F.when(~F.col(f"`{f.name}`").isin(MISSING), F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def read_text_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """All columns as strings, header in the first line, quotes doubled inside quotes.

    ``multiline`` allows line breaks inside quotes, at the price of one task per file.
    """
    charsets = detect_charsets(spark, path)
    reader = (
        spark.read.option("header", True).option("escape", '"').option("multiLine", multiline).option("inferSchema", False)
    )
    korean = sorted(f for f, charset in charsets.items() if charset == KOREAN)
    if not korean:
        return blank_missing(reader.option("encoding", "UTF-8").csv(path))
    # the JVM's charsets are open to Spark in this block only, so these files are read inside of it
    with _settings(spark, spark__sql__legacy__javaCharsets="true"):
        parts = [cut_lineage(reader.option("encoding", KOREAN).csv(korean))]
    others = sorted(set(charsets) - set(korean))
    if others:
        parts.insert(0, reader.option("encoding", "UTF-8").csv(others))
    return blank_missing(reduce(DataFrame.unionByName, parts))


def write_charsets(df: DataFrame, parts: dict[str, Column], folder: str) -> None:
    """Rows as CSV below a folder, those of each part in its charset: "utf8" or "cp949"."""
    with _settings(df.sparkSession, spark__sql__legacy__javaCharsets="true"):
        for charset, rows in parts.items():
            written = df.filter(rows).write.option("header", True).option("escape", '"')
            written.option("encoding", KOREAN if charset == "cp949" else "UTF-8").csv(f"{folder}/{charset}")


def read_ordered_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """The same with a ``row_ord`` column, which grows with the place of the row: these are sheets of some
    hundred rows, whose files are read one task each."""
    rows = read_text_csv(spark, path, multiline)
    return rows.withColumn("row_ord", F.monotonically_increasing_id())


# The delimiters between year, month and day may be any one mark; without any, the digits tell.
_PARTED = r"^\s*(\d{4}|\d{2})[^0-9A-Za-z\s](\d{1,2})[^0-9A-Za-z\s](\d{1,2})(?:[T\s].*)?$"
_COMPACT = r"^\s*(\d{4}|\d{2})(\d{2})(\d{2})\s*$"


def as_date(text: Column) -> Column:
    """A date out of `2022-10-24`, `2022/10/24`, `2022.1.4`, `20221024` or with a year of two digits (70
    to 99 are of the last century); a time after it is dropped. NULL for everything else."""
    compact = text.rlike(_COMPACT)

    def part(i: int) -> Column:
        return F.when(compact, F.regexp_extract(text, _COMPACT, i)).otherwise(F.regexp_extract(text, _PARTED, i))

    century = F.when(F.length(part(1)) == 4, "").when(part(1) >= "70", "19").otherwise("20")
    whole = F.concat(century, part(1), F.lit("-"), F.lpad(part(2), 2, "0"), F.lit("-"), F.lpad(part(3), 2, "0"))
    return F.when(compact | text.rlike(_PARTED), whole.try_cast("date"))


def _fitted(df: DataFrame, field: T.StructField) -> Column:
    """A text column cast to a declared type; NULL where it does not fit or is absent."""
    if field.name not in df.columns:
        return F.lit(None).cast(field.dataType)
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.DateType) and isinstance(df.schema[field.name].dataType, T.StringType):
        return as_date(column)
    return column.try_cast(field.dataType)


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast text columns to a target schema; what does not fit becomes NULL, what is absent too."""
    return df.select([_fitted(df, f).alias(f.name) for f in schema.fields])


def lost(df: DataFrame, schema: T.StructType) -> dict[str, Column]:
    """By column of the target schema the number of cells that `typed` turns to NULL, as an aggregate."""
    have = [f for f in schema.fields if f.name in df.columns]
    return {f.name: F.count_if(F.col(f"`{f.name}`").isNotNull() & _fitted(df, f).isNull()) for f in have}
