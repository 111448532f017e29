from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratelake.values import EXTENSION_BY_SUFFIX


def without_query(url: Column) -> Column:
    return F.substring_index(url, "?", 1)


def suffix_extension(suffix: Column) -> Column:
    """Extension name of the text behind the last dot."""
    low = F.lower(suffix)
    out = F.when(low.isNull(), "UNKNOWN")
    for text, extension in EXTENSION_BY_SUFFIX.items():
        out = out.when(low == text, extension)
    return out.otherwise("UNKNOWN")


def url_extension(url: Column) -> Column:
    """Extension of the path of a URL, by its text: without scheme, host, query and fragment.

    A text that is no URL, or a path without a dot, gives UNKNOWN; blanks and bars in a path do no harm.
    """
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)
    return suffix_extension(F.substring_index(F.when(F.contains(path, F.lit(".")), path), ".", -1))
