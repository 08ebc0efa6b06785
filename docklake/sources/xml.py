"""Station observations from XML snapshot documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from docklake.functions import text
from docklake.schemas import SNAPSHOT_XML


def with_document(raw: DataFrame, content: str = "content") -> DataFrame:
    """Add ``document``: the parsed snapshot, null fields where the text is not well-formed.
    The schema is explicit, nothing is inferred, and the name of the root element is free."""
    return raw.withColumn("document", F.from_xml(F.col(content), SNAPSHOT_XML))


def _snapshot_seconds() -> Column:
    return F.col("document.updatetime").try_cast("bigint")


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(_snapshot_seconds().isNotNull())


def rejected(parsed: DataFrame) -> DataFrame:
    """Documents without a readable snapshot time."""
    return parsed.where(_snapshot_seconds().isNull()).drop("document")


def flagged(raw: DataFrame, content: str = "content") -> DataFrame:
    """Raw snapshots with ``bad_time`` (no time or key could be read) and ``bad_xml`` (the document has no readable time)."""
    undated = F.col("timestamp_ms").isNull() | F.col("key").isNull()
    flags = {"bad_time": undated, "bad_xml": _snapshot_seconds().isNull()}
    return with_document(raw, content).withColumns(flags).drop("document")


def station_rows(parsed: DataFrame, *carry: str) -> DataFrame:
    """One row of raw text fields per station of every accepted document."""
    # The condition sits inside the generator: as a filter it would be pushed below the parsing
    # and every document would be parsed twice.
    stations = F.when(_snapshot_seconds().isNotNull(), F.col("document.station"))
    rows = parsed.select(*carry, _snapshot_seconds().alias("updatetime"), F.explode(stations).alias("station"))
    return rows.select(*carry, "updatetime", "station.*")


def typed_stations(rows: DataFrame, *carry: str) -> DataFrame:
    """Text fields typed; optional numbers fall back to their defaults, required ones to null."""
    c = F.col
    return rows.select(
        *carry,
        "updatetime",
        F.timestamp_seconds("updatetime").alias("timetag"),
        text.int_or_null(c("id")).alias("station"),
        c("lat").try_cast("double").alias("latitude"),
        c("long").try_cast("double").alias("longitude"),
        "street",
        text.int_or(c("height"), 0).alias("height"),
        text.int_or(c("streetNumber"), -1).alias("street_number"),
        text.int_list(c("nearbyStationList")).alias("nearby"),
        "status",
        text.int_or(c("slots"), 0).alias("slots"),
        text.int_or(c("bikes"), 0).alias("bikes"),
    )


def _usable() -> Column:
    return F.col("station").isNotNull() & F.col("latitude").isNotNull() & F.col("longitude").isNotNull()


def observations(raw: DataFrame, *carry: str, content: str = "content") -> DataFrame:
    """Typed observations of all readable stations; ``carry`` columns of ``raw`` are kept."""
    rows = station_rows(with_document(raw, content), *carry)
    return typed_stations(rows, *carry).where(_usable())


def rejected_stations(raw: DataFrame, *carry: str, content: str = "content") -> DataFrame:
    """Stations of readable documents that lack an id or a position."""
    rows = station_rows(with_document(raw, content), *carry)
    return typed_stations(rows, *carry).where(~_usable())


# What can become of a document: each of its stations is one of the first two, a document without a readable time the third.
STATION, NO_PLACE, NO_TIME = "station", "station without id or place", "document without time"


def outcomes(raw: DataFrame, *carry: str, content: str = "content") -> DataFrame:
    """All that a parse yields, in one pass: typed stations tagged by ``outcome``, rejected ones and documents among them.

    A job that stores stations, rejects and times takes each from this frame, so that every document is parsed once.
    A document without stations has no rows unless it is rejected; the fields of a rejected document are null.
    """
    parsed = with_document(raw, content)
    # One array a document: its stations, or a single null for a document that can't be read.
    stations = F.when(_snapshot_seconds().isNotNull(), F.col("document.station")).otherwise(F.array(F.lit(None)))
    rows = parsed.select(*carry, _snapshot_seconds().alias("updatetime"), F.explode(stations).alias("station"))
    typed = typed_stations(rows.select(*carry, "updatetime", "station.*"), *carry)
    outcome = F.when(F.col("updatetime").isNull(), NO_TIME).when(_usable(), STATION).otherwise(NO_PLACE)
    return typed.withColumn("outcome", outcome)


def counted_outcomes(rows: DataFrame, name: str | Observation) -> DataFrame:
    """``outcomes`` that counts them as it is written or read: the counts by cause come with the job that stores the rows."""
    count = lambda which: F.count_if(F.col("outcome") == which)
    return rows.observe(name, count(STATION).alias("stations"), count(NO_PLACE).alias("no_place"), count(NO_TIME).alias("no_time"))


def snapshot_times(raw: DataFrame, content: str = "content") -> DataFrame:
    """The ``updatetime`` of each accepted document."""
    return accepted(with_document(raw, content)).select(_snapshot_seconds().alias("updatetime"))
