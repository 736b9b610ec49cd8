"""Normalisation and formatting of text columns. All are JVM expressions but Unicode composition, an Arrow function."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


@F.pandas_udf(StringType())
def _compose(text: pd.Series) -> pd.Series:
    return text.map(lambda t: t if t is None else unicodedata.normalize("NFC", t))


def nfc(text: Column) -> Column:
    """Unicode composition; texts of ASCII alone are not sent to Python."""
    return F.coalesce(_compose(F.when(text.rlike("[^\\x00-\\x7F]"), text)), text)


def strip(text: Column) -> Column:
    """Without U+0000 to U+0020 on both ends; other white space stays."""
    return F.regexp_replace(text, "^[\\x00-\\x20]+|[\\x00-\\x20]+$", "")


def collapse(text: Column) -> Column:
    """Runs of ASCII white space become one space."""
    return F.regexp_replace(text, "\\s+", " ")


def plain(text: Column) -> Column:
    """Stripped and collapsed; what is empty then is null. Composition comes before, see nfc."""
    return F.nullif(collapse(strip(text)), F.lit(""))


def composed_key(text: Column) -> Column:
    """Of composed text the key of a record: stripped and lower-cased; inner white space stays, blank is null."""
    return F.nullif(F.lower(strip(text)), F.lit(""))


def doi_key(text: Column) -> Column:
    """The key of a record: composed, stripped and lower-cased; inner white space stays, blank is null."""
    return composed_key(nfc(text))


def date_parts(issued: Column) -> Column:
    """The first list of 1 to 3 date parts, else null."""
    first = F.get(issued, F.lit(0))
    return F.when(F.size(first).between(1, 3), first)


def partial_date(parts: Column) -> Column:
    """YYYY, YYYY-MM or YYYY-MM-DD. Parts aren't checked; a null part is the text null."""
    part = lambda k: F.get(parts, F.lit(k))
    year, month, day = F.format_string("%04d", part(0)), F.format_string("-%02d", part(1)), F.format_string("-%02d", part(2))
    n = F.size(parts)
    return F.when(n == 1, year).when(n == 2, F.concat(year, month)).when(n == 3, F.concat(year, month, day))


def instant(text: Column) -> Column:
    """An ISO instant with date, time and zone; null if it isn't one, whatever the day or the session's zone."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}:\d{2})\z"), F.try_to_timestamp(text))


def log_safe(text: Column) -> Column:
    """White space and equals signs become underscores."""
    return F.regexp_replace(text, "[\\s=]", "_")


def html_escape(text: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def duration_text(ms: Column) -> Column:
    """Seconds with thousandths, and milliseconds; null is `Not run`."""
    seconds = F.concat((F.floor(ms / 1000)).cast("string"), F.lit("."), F.lpad((ms % 1000).cast("string"), 3, "0"))
    return F.when(ms.isNull(), "Not run").otherwise(F.concat(seconds, F.lit(" s ("), ms.cast("string"), F.lit(" ms)")))


def header_millis(text: Column) -> Column:
    """Milliseconds of a header such as 500ms or 1s; null if it has another form."""
    n, unit = F.regexp_extract(text, "^\\s*(\\d+)(ms|s)?\\s*$", 1), F.regexp_extract(text, "^\\s*(\\d+)(ms|s)?\\s*$", 2)
    return F.when(n != "", n.cast("bigint") * F.when(unit == "ms", 1).otherwise(1000))


def uuid_bytes(text: Column) -> Column:
    return F.unhex(F.replace(text, F.lit("-")))


def uuid_text(data: Column) -> Column:
    h = F.lower(F.hex(data))
    cut = lambda a, n: F.substring(h, a, n)
    return F.concat_ws("-", cut(1, 8), cut(9, 4), cut(13, 4), cut(17, 4), cut(21, 12))


def elapsed_millis(start: Column, end: Column) -> Column:
    return F.floor((F.unix_micros(end) - F.unix_micros(start)) / 1000).cast("bigint")
