"""Identifier cleaning (accents, non-identifier characters, prefix, length).

Two forms that agree character for character:

* :func:`clean_name` -- plain Python, for schema metadata (column names,
  table names: a handful of strings on the driver);
* :func:`clean_identifier` -- a Column expression for values in the data.
"""

from __future__ import annotations

import re
import sys
import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import types as T
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

# Fixed values that must equal the source system's naming rules:
# allowed identifier characters, the replacement character, the prefix used
# when a name does not start with a letter or underscore, the maximum length,
# and the table suffix for sub-task types.
IDENTIFIER_CHARS = "a-zA-Z0-9_"
REPLACEMENT = "_"
PREFIX = "_"
MAX_IDENTIFIER_LENGTH = 128
SUBTASK_SUFFIX = "_subtask"


def _combining_ranges() -> list[tuple[int, int]]:
    """Code point ranges whose canonical combining class is non-zero.

    Generated from the running interpreter's Unicode tables (the same rule
    the Python form uses), not from a hand-written list.
    """
    ranges: list[tuple[int, int]] = []
    start = None
    for cp in range(sys.maxunicode + 1):
        if unicodedata.combining(chr(cp)):
            if start is None:
                start = cp
        elif start is not None:
            ranges.append((start, cp - 1))
            start = None
    if start is not None:
        ranges.append((start, sys.maxunicode))
    return ranges


def _re2_class(ranges: list[tuple[int, int]]) -> str:
    parts = []
    for lo, hi in ranges:
        parts.append(f"\\x{{{lo:x}}}" if lo == hi else f"\\x{{{lo:x}}}-\\x{{{hi:x}}}")
    return "[" + "".join(parts) + "]"


_COMBINING = _combining_ranges()
COMBINING_CLASS_RE2 = _re2_class(_COMBINING)
_COMBINING_CLASS = re.compile("[" + "".join(f"{chr(lo)}-{chr(hi)}" for lo, hi in _COMBINING) + "]+")


def without_accents(text: str) -> str:
    """Driver form of :func:`strip_accents`: the same ranges, as one pattern."""
    return _COMBINING_CLASS.sub("", unicodedata.normalize("NFKD", text))


def clean_name(name: str | None) -> str:
    """Clean one identifier: accents stripped, other characters -> ``_``,
    ``_`` prefixed unless it starts with a letter or ``_``, cut to 128.
    An empty (or NULL) name becomes ``_``."""
    text = without_accents(name or "")
    out = "".join(ch if (ch.isascii() and (ch.isalnum() or ch == "_")) else REPLACEMENT for ch in text)
    if not out or not (out[0].isalpha() or out[0] == "_"):
        out = PREFIX + out
    return out[:MAX_IDENTIFIER_LENGTH]


def type_table_name(name: str, subtask: bool) -> str:
    """Target table of one document type: cleaned name, ``_subtask`` if flagged."""
    return clean_name(name) + (SUBTASK_SUFFIX if subtask else "")


@arrow_udf(T.StringType())
def _strip_accents_arrow(values: pa.Array) -> pa.Array:
    decomposed = pc.utf8_normalize(values, "NFKD")
    return pc.replace_substring_regex(decomposed, COMBINING_CLASS_RE2, "")


def strip_accents(col: Column | str) -> Column:
    """NFKD + combining marks removed, over whole strings, Arrow-batched.

    ASCII strings are their own NFKD form, so only non-ASCII values are
    sent to Python (ASCII rows travel as NULLs and are taken back as is).
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(_strip_accents_arrow(F.when(c.rlike("[^\\x00-\\x7F]"), c)), c)


def clean_identifier(col: Column | str) -> Column:
    """Column form of :func:`clean_name` (NULL stays NULL)."""
    c = F.col(col) if isinstance(col, str) else col
    replaced = F.regexp_replace(strip_accents(c), f"[^{IDENTIFIER_CHARS}]", REPLACEMENT)
    prefixed = F.when(replaced.rlike("^[A-Za-z_]"), replaced).otherwise(F.concat(F.lit(PREFIX), replaced))
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(F.substring(prefixed, 1, MAX_IDENTIFIER_LENGTH))


def type_table_name_col(name: Column | str, subtask: Column | str | None = None) -> Column:
    """Column form of :func:`type_table_name`; NULL flag counts as not sub-task."""
    n = F.col(name) if isinstance(name, str) else name
    base = clean_identifier(n)
    if subtask is None:
        return base
    s = F.col(subtask) if isinstance(subtask, str) else subtask
    return F.concat(base, F.when(F.coalesce(s, F.lit(False)), F.lit(SUBTASK_SUFFIX)).otherwise(F.lit("")))
