from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: how a missing kingdom is shown in merged counts.
UNTITLED_KINGDOM = "Title Unavailable"

# Fixed pattern: the authority of a URL, after an optional scheme and "//".
_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"


def source_name(url: Column) -> Column:
    """First dot label of the URL's authority: ``https://gbif.org`` gives ``gbif``.

    A URL without ``//`` gives the empty string. User info and port stay in the label and case
    is kept. ``try_parse_url`` is not used because it rejects URLs with blanks or other
    characters that URI syntax forbids, and their source would be lost.
    """
    clean = F.translate(F.ltrim(url), "\t\r\n", "")
    return F.substring_index(F.regexp_extract(clean, _AUTHORITY, 1), ".", 1)


def source_url(name: Column) -> Column:
    return F.concat(F.lit("http://"), name, F.lit(".org"))


def source_label(topic: Column) -> Column:
    return F.upper(topic)


def is_kingdom(kingdom: Column, name: str) -> Column:
    """Case-insensitive match; NULL for a missing kingdom, so it never counts."""
    return F.lower(kingdom) == F.lit(name)


def kingdom_label(kingdom: Column) -> Column:
    return F.coalesce(kingdom, F.lit(UNTITLED_KINGDOM))
