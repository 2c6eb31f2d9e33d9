"""Text cleaning and page-title extraction."""

from __future__ import annotations

import html
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Send the decoder by value, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def squeeze(text: Column) -> Column:
    """Collapse every run of white space, also non-ASCII, to one blank and strip the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def key_text(value: Column) -> Column:
    """A key as stripped text."""
    return F.trim(value.cast("string"))


def non_empty(text: Column) -> Column:
    return text.isNotNull() & (text != "")


@F.pandas_udf(StringType())
def decode_entities(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Decode ``&amp;`` and its kind; Spark has no expression for it."""
    for batch in batches:
        yield batch.map(html.unescape, na_action="ignore")


# HTML that is not shown as markup: a title inside it does not count.
_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
_META = r"(?is)<meta\b(?=[^>]*\bproperty\s*=\s*[\"']og:title[\"'])[^>]*>"
_CONTENT = r"(?is)\bcontent\s*=\s*(?:\"([^\"]*)\"|'([^']*)')"
_TITLE = r"(?is)<title\b[^>]*>(.*?)</title\s*>"
_HEADING = r"(?is)<h1\b[^>]*>(.*?)</h1\s*>"


def _found(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract(text, pattern, group)


def _candidates(page: Column) -> list[Column]:
    """og:title, title and first h1 as written in the page, in that order."""
    visible = F.regexp_replace(page, _HIDDEN, "")
    meta = _found(visible, _META, 0)
    social = F.concat(_found(meta, _CONTENT, 1), _found(meta, _CONTENT, 2))
    heading = F.regexp_replace(_found(visible, _HEADING), r"(?s)<[^>]*>", " ")
    return [social, _found(visible, _TITLE), heading]


def page_name(page: Column) -> Column:
    """The first non-empty of og:title, title and h1 as shown; NULL if there is none.

    The three decoder calls share one Arrow exchange per batch.
    """
    shown = [squeeze(decode_entities(text)) for text in _candidates(page)]
    return F.coalesce(*[F.nullif(text, F.lit("")) for text in shown])


def packed_id(text: Column) -> Column:
    """An id as bytes, for joins and shuffles: pairs of hex digits as one byte each, else as it is.

    The first byte says which, so that different ids stay different; see ``unpacked_id``.
    """
    return F.when(
        text.rlike("^([0-9a-f][0-9a-f])+$"), F.concat(F.lit(b"\x00"), F.unhex(text))
    ).otherwise(F.concat(F.lit(b"\x01"), text.cast("binary")))


def unpacked_id(packed: Column) -> Column:
    """The id that ``packed_id`` packed."""
    rest = F.substring(packed, 2, 1 << 30)
    return F.when(F.substring(packed, 1, 1) == F.lit(b"\x00"), F.lower(F.hex(rest))).otherwise(
        rest.cast("string")
    )
