"""Text parsing and formatting, as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of the feed, of geocoded addresses and of district pages.
UPDATETIME_PATTERN = r"<updatetime><!\[CDATA\[(\d+)\]\]></updatetime>"
POSTAL_CODE_PATTERN = r"^.* (\d+) Barcelona, Spain"
SIZE_PATTERN = r"^\s*(\d+,\d+)"
POPULATION_DENSITY_PATTERN = r"^\s*(\d+,\d+)\D+(\d+(\.\d+)?,\d+)"
SNAPSHOT_FILE_PATTERN = r"_(\d{4}-\d{2}-\d{2}_\d{2}\.\d{2}\.\d{2})_UTC\.xml$"

NULL_TEXT = "NULL"
INTEGER_PATTERN = r"^-?[0-9]+$"


def first_group(text: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, null when there is none."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def updatetime_seconds(content: Column) -> Column:
    # No match is the empty text, which is no number; one evaluation of the pattern is enough.
    return F.regexp_extract(content, UPDATETIME_PATTERN, 1).try_cast("bigint")


def updatetime_millis(content: Column) -> Column:
    return updatetime_seconds(content) * 1000


def int_or_null(text: Column) -> Column:
    """Digits with an optional minus; blanks, other signs and overflow are null."""
    return F.when(text.rlike(INTEGER_PATTERN), text.try_cast("int"))


def int_or(text: Column, default: int) -> Column:
    return F.coalesce(int_or_null(text), F.lit(default))


def int_list(text: Column, bad: int = -1) -> Column:
    return F.transform(F.split(text, ","), lambda item: int_or(item, bad))


def null_text(text: Column) -> Column:
    """The text NULL stands for a missing value in the station dimension."""
    return F.nullif(text, F.lit(NULL_TEXT))


def address(street: Column, number: Column) -> Column:
    return F.when(street.isNull(), "").otherwise(F.concat_ws(" ", street, number.cast("string")))


def double_quotes(text: Column) -> Column:
    return F.translate(text, "'", '"')


def postal_code(text: Column) -> Column:
    return first_group(text, POSTAL_CODE_PATTERN)


def local_decimal(text: Column) -> Column:
    """``1.234,5`` as 1234.5."""
    return F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("double")


def comma_integer(text: Column) -> Column:
    """``107,426`` as 107426."""
    return F.replace(text, F.lit(","), F.lit("")).try_cast("bigint")


def district_size(text: Column) -> Column:
    return local_decimal(first_group(text, SIZE_PATTERN))


def district_population(text: Column) -> Column:
    return comma_integer(first_group(text, POPULATION_DENSITY_PATTERN, 1))


def district_density(text: Column) -> Column:
    return local_decimal(first_group(text, POPULATION_DENSITY_PATTERN, 2))


def point_text(longitude: Column, latitude: Column) -> Column:
    return F.concat(F.lit("POINT("), longitude.cast("string"), F.lit(" "), latitude.cast("string"), F.lit(")"))


def message_key(datasource: Column, timestamp_ms: Column) -> Column:
    return F.concat(datasource, timestamp_ms.cast("string"))


def content_key(content: Column) -> Column:
    """A key that a replay reproduces."""
    return F.sha2(content, 256)


def snapshot_file_time(path: Column) -> Column:
    """The UTC snapshot time that an archived file carries in its name."""
    stamp = first_group(path, SNAPSHOT_FILE_PATTERN)
    return F.to_timestamp_ntz(stamp, F.lit("yyyy-MM-dd_HH.mm.ss"))
