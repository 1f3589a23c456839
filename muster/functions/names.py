"""File names and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The name markers of each file type, in order of precedence.
TYPE_MARKERS = (
    ("p02", ("p02", "921465")),
    ("ivr", ("ivr",)),
    ("sms", ("sms",)),
)


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def extension(path: Column) -> Column:
    """Text after the last dot of the base name, empty when there is none."""
    return F.regexp_extract(base_name(path), r"\.([^.]*)\z", 1)


def has_csv_extension(path: Column) -> Column:
    return F.lower(extension(path)) == "csv"


def file_type(path: Column) -> Column:
    """Type by the first marker found in the base name, null when none is."""
    name = F.lower(base_name(path))
    kind = F.lit(None).cast("string")
    for label, markers in reversed(TYPE_MARKERS):
        found = name.contains(markers[0])
        for marker in markers[1:]:
            found = found | name.contains(marker)
        kind = F.when(found, F.lit(label)).otherwise(kind)
    return kind


def plain_path(uri: Column) -> Column:
    """Undo the percent encoding of ``_metadata.file_path`` and spell local files ``file:/...``."""
    decoded = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "file:/")
