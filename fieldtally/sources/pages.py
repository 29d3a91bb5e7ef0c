"""Landed API pages: one row per page, its JSON text in one column.

Pages are split where they lie, one task per input split; the records come out as JSON text, ready to
be published or parsed. Raw control characters inside strings are accepted, as the services send them.

No page is lost without a word. A page can be read if it is one JSON document, alone, whose list of records is a
list (of items that all have ``data``, where the source wraps its records). Any other page, ``{}``, null,
an error message or two documents in a row among them, gives no records: ``mode="FAILFAST"`` fails the query,
otherwise ``rejected_pages`` has it. Accepted and rejected pages together are all pages.

Whole numbers survive at any length. Fractions are written as a double reads them, so that ``1.10`` is ``1.1``
and ``1.0`` stays ``1.0``, no whole number to a parser with a schema. ``numbers="exact"`` keeps up to 38
digits of a fraction, through Spark's VARIANT type; there ``1.0`` is ``1``, members are sorted by name, and a page with an object
that has a member twice cannot be read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fieldtally.schemas import check_source

# The part of each source's page envelope that is read.
_ENVELOPES = {
    "gbif": "results: array<string>, endOfRecords: boolean",
    "idigbio": "items: array<map<string, string>>, itemCount: bigint",
    "obis": "results: array<string>",
}
_LISTS = {"gbif": "results", "idigbio": "items", "obis": "results"}

_OPTIONS = {"allowUnquotedControlChars": "true"}
NUMBERS = ("double", "exact")

# Fixed value: records asked for per page where the end shows in the page's own count.
IDIGBIO_PAGE_SIZE = 100


def unnest_pages(
    pages: DataFrame,
    source: str,
    column: str = "page",
    mode: str = "PERMISSIVE",
    numbers: str = "double",
) -> DataFrame:
    """One row ``(topic, value)`` per record of every page; an empty page gives none."""
    records = _records(source, column, mode, numbers)
    return pages.select(F.lit(source).alias("topic"), F.explode(records).alias("value"))


def unnest_with_places(
    pages: DataFrame,
    source: str,
    column: str = "page",
    mode: str = "PERMISSIVE",
    numbers: str = "double",
    page_key: Sequence[str] = (),
) -> DataFrame:
    """``unnest_pages`` with each record's ``page_key`` and ``position`` in its page.

    A page is known by the columns ``page_key``, or by its text where none are named: two pages of
    the same text are then one page that has come twice.
    """
    records = _records(source, column, mode, numbers)
    known_by = F.to_json(F.struct(*page_key)) if page_key else F.sha2(F.col(column).cast("binary"), 256)
    found = pages.select(known_by.alias("page_key"), F.posexplode(records).alias("position", "value"))
    return found.select(F.lit(source).alias("topic"), "value", "page_key", "position")


def rejected_pages(
    pages: DataFrame, source: str, column: str = "page", numbers: str = "double"
) -> DataFrame:
    """The rows of ``pages`` whose page cannot be read: those that give no records without being empty."""
    return pages.where(_records(source, column, "PERMISSIVE", numbers).isNull())


def page_status(
    pages: DataFrame,
    source: str,
    column: str = "page",
    page_size: int = IDIGBIO_PAGE_SIZE,
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """The pages' other columns with ``record_count``, ``last_page`` and ``next_cursor``.

    ``next_cursor`` is the ``id`` of the last record where the source pages by cursor, else NULL.
    All three are NULL for a page that cannot be read.
    """
    others = [name for name in pages.columns if name != column]
    records, envelope = F.col("records"), F.col("envelope")
    opened = pages.select(
        *others,
        _records(source, column, mode, "double").alias("records"),
        F.get(_documents(source, column, mode), F.lit(0)).alias("envelope"),
    )
    no_cursor = F.lit(None).cast("string")
    last_page, cursor = {
        "gbif": lambda: (envelope["endOfRecords"], no_cursor),
        "idigbio": lambda: (envelope["itemCount"] <= page_size, no_cursor),
        "obis": lambda: (
            F.array_size(records) == 0,
            F.get_json_object(F.try_element_at(records, F.lit(-1)), "$.id"),
        ),
    }[source]()
    return opened.select(
        *others,
        F.array_size(records).alias("record_count"),
        F.when(records.isNotNull(), last_page).alias("last_page"),
        cursor.alias("next_cursor"),
    )


def _alone(column: str) -> Column:
    # With an end behind it a page must be the first of two; one that closes the list early is the only one.
    return F.concat(F.lit("["), F.col(column), F.lit(",null]"))


def _documents(source: str, column: str, mode: str) -> Column:
    check_source(source)
    return F.from_json(_alone(column), f"array<struct<{_ENVELOPES[source]}>>", {**_OPTIONS, "mode": mode})


def _records(source: str, column: str, mode: str, numbers: str) -> Column:
    """The page's records as a list of texts, null if it cannot be read."""
    if numbers not in NUMBERS:
        raise ValueError(f"numbers are read as {' or '.join(NUMBERS)}, not {numbers!r}")
    opened = _documents(source, column, mode)
    # A list of one element makes what is parsed a variable, so it is parsed once and looked at often.
    records = F.get(F.transform(F.array(opened), lambda pages: _listed(pages, source)), F.lit(0))
    if numbers == "exact":
        records = F.when(records.isNotNull(), _exact(source, column))
    if mode != "FAILFAST":
        return records
    text = F.coalesce(F.substring(column, 1, 200), F.lit("NULL"))
    message = F.concat(F.lit(f"Malformed page of {source}: "), text)
    return F.coalesce(records, F.raise_error(message).cast("array<string>"))


def _listed(pages: Column, source: str) -> Column:
    alone = (F.size(pages) == 2) & F.get(pages, F.lit(1)).isNull()
    listed = F.get(pages, F.lit(0))[_LISTS[source]]
    if source == "idigbio":
        whole = F.forall(listed, lambda item: F.coalesce(F.map_contains_key(item, "data"), F.lit(False)))
        alone, listed = alone & whole, F.transform(listed, lambda item: F.try_element_at(item, F.lit("data")))
    return F.when(alone, listed)


def _exact(source: str, column: str) -> Column:
    page = F.get(F.from_json(_alone(column), "array<variant>", _OPTIONS), F.lit(0))
    listed = F.try_variant_get(page, f"$.{_LISTS[source]}", "array<variant>")
    if source == "idigbio":
        listed = F.transform(listed, lambda item: F.try_variant_get(item, "$.data", "variant"))
    text = F.transform(listed, lambda record: F.to_json(record))
    # As in the other way, a record that is null is a message without text.
    return F.transform(text, lambda record: F.nullif(record, F.lit("null")))
