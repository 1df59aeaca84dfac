"""One notation for labels, ids and hashes that were written in several.

Every function takes and returns a Column and stays inside code generation. Null, empty and placeholder values
become null: they name nothing and so relate nothing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What stands for "no value" once trimmed and lower-cased.
PLACEHOLDERS = ("", "none", "null", "nil", "nan", "n/a", "na", "unknown", "undefined", "-", "--", "?")
#: Blanks and invisible characters cut from both ends.
BLANKS = " \t\n\r\x0b\x0c ​  　﻿"


def _plain(c: Column) -> Column:
    return F.lower(F.trim(c, F.lit(BLANKS)))


def _known(c: Column) -> Column:
    return F.when(~c.isin(*PLACEHOLDERS), c)


def label(c: Column) -> Column:
    """Categories and sources: lower case, words joined by `_`."""
    return _known(F.translate(_plain(c), "- ", "__"))


def document_id(c: Column) -> Column:
    """Document ids: lower case, joined by `-`."""
    return _known(F.translate(_plain(c), "_ ", "--"))


def record_id(c: Column) -> Column:
    """Sample ids: lower case, trimmed."""
    return _plain(c)


def content_hash(c: Column) -> Column:
    """Hex digests: lower case, without the algorithm's name and a leading 0x; all zeros is a placeholder."""
    bare = F.regexp_replace(_plain(c), r"^(?:(?:sha-?256|sha-?1|md5)\s*[:=]\s*)?(?:0x)?", "")
    return F.when(~bare.rlike(r"^0+$"), _known(bare))


def split(c: Column) -> Column:
    """train, val, test or eval; null and placeholders mean train."""
    s = label(c)
    return F.coalesce(F.when(s == "validation", "val").otherwise(s), F.lit("train"))


def measured(c: Column) -> Column:
    """A double that was measured: NaN becomes null, -0.0 becomes 0.0."""
    return F.when(~F.isnan(c), c + F.lit(0.0))
