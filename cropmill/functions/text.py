"""Text functions as column expressions, with an Arrow UDF only where Spark has none (Unicode NFC, word distance)."""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters that a strip removes, as a class of a pattern.
STRIPPED = r"\x09-\x0d\x1c-\x20\x85\xa0  -     　"
#: Delimiters around a formula, of which the first pair that fits is removed once.
DELIMITERS = (("$$", "$$"), (r"\[", r"\]"), (r"\(", r"\)"), ("$", "$"))
#: Fixed value: a cell that is a number, as sign, digits, decimals and percent.
NUMERIC_CELL = r"([+-]?)(\d[\d,]*)(\.\d+)?(%)?"


def digest(value: Any) -> str:
    """SHA-256 of the canonical JSON of a value: keys sorted, non-ASCII kept, `, ` and `: ` as separators."""
    return hashlib.sha256(json.dumps(value, sort_keys=True, ensure_ascii=False).encode()).hexdigest()


def json_string(c: Column) -> Column:
    """A string as JSON writes it; null as null."""
    inner = F.get_json_object(F.lit("{}"), "$.x")  # keeps the type where every branch is null
    for plain, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f")):
        c = F.replace(c, F.lit(plain), F.lit(escaped))
    return F.coalesce(F.concat(F.lit('"'), c, F.lit('"')), inner, F.lit("null"))


def digest_list(*parts: Column | int | str) -> Column:
    """`digest` of a list of strings and integers, inside the JVM."""
    each = [json_string(p if isinstance(p, Column) else F.lit(p)) if not isinstance(p, int) else F.lit(str(p)) for p in parts]
    return F.sha2(F.concat(F.lit("["), F.concat_ws(", ", *each), F.lit("]")), 256)


def unit_hash(digested: Column) -> Column:
    """The first 32 bits of a hex digest as a number in [0, 1)."""
    return F.conv(F.substring(digested, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^[{STRIPPED}]+|[{STRIPPED}]+$", "")


def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore")


def nfc(c: Column) -> Column:
    """Unicode NFC; only text beyond Latin-1 leaves the JVM, as all below is composed."""
    open_ = c.rlike(r"[^\x00-ÿ]")
    return F.when(open_, F.pandas_udf(_nfc, "string")(F.when(open_, c))).otherwise(c)


def _nfc_arrays(s: pd.Series) -> pd.Series:
    return s.map(lambda xs: [None if x is None else unicodedata.normalize("NFC", x) for x in xs], na_action="ignore")


def nfc_array(c: Column) -> Column:
    """NFC of each string of an array; arrays without a character beyond Latin-1 stay in the JVM."""
    open_ = F.exists(c, lambda x: F.coalesce(x.rlike(r"[^\x00-ÿ]"), F.lit(False)))
    return F.when(open_, F.pandas_udf(_nfc_arrays, "array<string>")(F.when(open_, c))).otherwise(c)


def normalize_text(c: Column) -> Column:
    return strip(F.replace(nfc(c), F.lit("\r\n"), F.lit("\n")))


def strip_delimiters(c: Column) -> Column:
    """A formula without the first pair of delimiters that is around it, stripped."""
    out = c
    for left, right in reversed(DELIMITERS):
        inner = F.substring(c, F.lit(len(left) + 1), F.greatest(F.char_length(c) - (len(left) + len(right)), F.lit(0)))
        out = F.when(c.startswith(left) & c.endswith(right), strip(inner)).otherwise(out)
    return out


def normalize_formula(c: Column) -> Column:
    return strip_delimiters(normalize_text(c))


def normalized_distance(a: Column, b: Column) -> Column:
    """Edit distance over the length of the longer text, in code points; 0 for two empty texts."""
    return F.levenshtein(a, b) / F.greatest(F.char_length(a), F.char_length(b), F.lit(1))


def cer(pred: Column, gt: Column) -> Column:
    """Character error rate; may exceed 1. Null for an empty gt."""
    return F.when(F.char_length(gt) > 0, F.levenshtein(pred, gt) / F.char_length(gt))


def edit_distance(a: Sequence, b: Sequence) -> int:
    """Edit distance of two sequences, a column of the table at a time as bit vectors (Myers, Hyyrö)."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return len(b)
    where: dict = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full, last, score = (1 << len(a)) - 1, 1 << (len(a) - 1), len(a)
    up, down = full, 0  # rows where the column rises, and falls, by 1
    for y in b:
        same = where.get(y, 0)
        across = (((same & up) + up) ^ up) | same
        right, left = (down | ~(across | up)) & full, up & across
        score += ((right & last) != 0) - ((left & last) != 0)
        right, left = right << 1 | 1, left << 1
        fall = right & (same | down)
        up, down = (left | ~(same | down | right)) & full, fall & full
    return score


def _word_errors(pred: str | None, gt: str | None) -> float | None:
    if pred is None or gt is None or " " not in gt or not gt.split():
        return None
    return 0.0 if pred == gt else edit_distance(pred.split(), gt.split()) / len(gt.split())


def _wer(pred: pd.Series, gt: pd.Series) -> pd.Series:
    return pd.Series([_word_errors(p, g) for p, g in zip(pred, gt)], dtype="float64")


def wer(pred: Column, gt: Column) -> Column:
    """Word error rate; null where the gt has no blank."""
    return F.pandas_udf(_wer, "double")(pred, gt)


def _wer_arrays(preds: pd.Series, gts: pd.Series) -> pd.Series:
    return pd.Series([None if ps is None else [_word_errors(p, g) for p, g in zip(ps, gs)] for ps, gs in zip(preds, gts)])


def wer_array(preds: Column, gts: Column) -> Column:
    """Word error rates of two arrays, pair by pair."""
    return F.pandas_udf(_wer_arrays, "array<double>")(preds, gts)


def escape_html(c: Column, quote: bool = True) -> Column:
    for plain, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")) + ((('"', "&quot;"), ("'", "&#x27;")) if quote else ()):
        c = F.replace(c, F.lit(plain), F.lit(escaped))
    return c


def data_uri(content: Column) -> Column:
    """A PNG's bytes as a data URI."""
    return F.concat(F.lit("data:image/png;base64,"), F.base64(content))


def is_numeric_cell(c: Column) -> Column:
    return c.rlike(f"^(?:{NUMERIC_CELL})$")


def plain_endpoint(c: Column) -> Column:
    """Whether a URL is http(s) with a host and without credentials, query and fragment."""
    part = lambda p: F.try_parse_url(c, F.lit(p))
    return F.coalesce(part("PROTOCOL").isin("http", "https") & part("HOST").isNotNull() & part("USERINFO").isNull() & part("QUERY").isNull() & part("REF").isNull(), F.lit(False))


def missing_glyphs(text: Column, covered: Sequence[str]) -> Column:
    """Characters of a text that a font's character map lacks."""
    return F.array_sort(F.array_except(F.array_distinct(F.split(F.regexp_replace(text, r"\s", ""), "")), F.array(F.lit(""), *[F.lit(x) for x in covered])))
