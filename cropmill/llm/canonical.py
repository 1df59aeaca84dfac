"""One form for text that looks the same.

The form composes accents (NFC), narrows wide characters and spaces, drops characters that do not show, unfolds
ligatures and radicals that are drawn as the letters they stand for, and gives look-alike letters of other scripts one
script a word. What shows stays: case, accents, superscripts, and letters and digits of one script that resemble each
other.

Text is normalised where it needs it only. A pattern made from the Unicode quick-check properties finds the segments
that may be unstable; each is widened to the characters it can combine with, normalised by itself and spliced into the
unchanged rest. Text without such a segment is returned as it is, mostly without leaving the JVM.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Letters of Cyrillic and Greek drawn as a Latin letter, beside that letter. The list holds letters that have
#: the same shape in common upright fonts. It leaves out look-alikes that a reader can tell apart (v and ѵ, y and
#: ү), letters of other scripts (Armenian, Cherokee, Coptic), and small Greek letters other than omicron, nu and the two lunates.
CYRILLIC = "АВЕЅІЈКМНОРСТУХасеѕіјорухһԁԛԝӏ", "ABESIJKMHOPCTYXacesijopyxhdqwl"
GREEK = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονϲϳ", "ABEZHIKMNOPTYXovcj"
#: Characters that are drawn as another, beyond what Unicode's compatibility mappings say.
DRAWN_AS = {"‐": "-", "‑": "-", "ʹ": "'", "ꞌ": "'", "∶": ":", "∕": "/", "ꓽ": ":"}
#: Kinds of compatibility mapping that keep the look. Of the kind <compat> only letters and radicals do.
KEPT_LOOK = ("<wide>", "<narrow>", "<noBreak>", "<initial>", "<medial>", "<final>", "<isolated>")
#: Invisible characters beside the category Cf: fillers and variation selectors.
INVISIBLE = {0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0x180B, 0x1810), *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)}
#: Text of these characters only is stable. For the JVM, where $ also holds before a final line terminator.
STABLE = r"^[\n\t -~]*\z"


def _fold(ch: str) -> str:
    """What a single character is drawn as: itself, another, several, or nothing."""
    kind = unicodedata.category(ch)
    if ord(ch) in INVISIBLE or (kind == "Cf" and not 0x600 <= ord(ch) <= 0x6DD) or (kind == "Cc" and ch not in "\t\n\r"):
        return ""
    if ch in DRAWN_AS:
        return DRAWN_AS[ch]
    if kind == "Zs":
        return " "
    if ch in "  \x85":
        return "\n"
    how, _, codes = unicodedata.decomposition(ch).partition(" ")
    if how in KEPT_LOOK or how == "<compat>" and (kind == "So" and 0x2E80 <= ord(ch) <= 0x2FDF or 0xFB00 <= ord(ch) <= 0xFB4F or ch == "µ" or 0x0132 <= ord(ch) <= 0x01CC and kind[0] == "L"):
        return "".join(_fold(chr(int(x, 16))) for x in codes.split())
    return ch


@lru_cache(1)
def _tables() -> tuple:
    """(fold by character, pattern of unstable segments), by rule from the Unicode data."""
    fold, no, joins = {}, [], set()
    for n in range(128, sys.maxunicode + 1):
        if 0xD800 <= n <= 0xDFFF or 0xAC00 <= n <= 0xD7A3 or 0x4E00 <= n <= 0x9FFF:
            continue
        ch = chr(n)
        to = _fold(ch)
        if to != ch:
            fold[n] = to
            no.append(n)  # changes by itself
            continue
        if not unicodedata.is_normalized("NFC", ch):
            no.append(n)  # quick check: no
        if unicodedata.combining(ch):
            joins.add(n)
        d = unicodedata.decomposition(ch)
        if d and d[0] != "<" and unicodedata.is_normalized("NFC", ch):
            joins.update(int(x, 16) for x in d.split()[1:])  # quick check: maybe, as it can compose with what stands before
    joins.update(range(0x1161, 0x1176), range(0x11A8, 0x11C3))

    def ranges(points) -> str:
        out, points = [], sorted(points)
        i = 0
        while i < len(points):
            j = i
            while j + 1 < len(points) and points[j + 1] == points[j] + 1:
                j += 1
            out.append(re.escape(chr(points[i])) + ("-" + re.escape(chr(points[j])) if j > i else ""))
            i = j + 1
        return "".join(out)

    for n in range(0x20):
        if n not in (9, 10, 13):
            fold[n] = ""
            no.append(n)
    fold[0x7F] = ""
    no.append(0x7F)
    odd = ranges({*no, *joins})
    # A starter, then at least one unstable character: the starter is the context that a mark may compose with.
    unstable = re.compile(f"[^{odd}]?(?:[{odd}])+")
    return fold, unstable


#: Runs of letters of the three scripts with their marks, and what shows that a text has letters of the other two.
_WORD = re.compile("[A-Za-z\u00aa-\u00ff\u0100-\u052f\u1e00-\u1fff]+")
_OTHER = re.compile("[\u0370-\u052f]")
_TO_LATIN = {ord(a): b for a, b in [*zip(*CYRILLIC), *zip(*GREEK)]}
_TO_CYRILLIC = {ord(b): a for a, b in zip(*CYRILLIC)}
_TO_GREEK = {ord(b): a for a, b in zip(*GREEK)}


def _word(m: re.Match) -> str:
    """One script for a word: that of its letters which only one script has; Latin if there are none, or of several.

    The choice depends on what shows only, so two words that look the same get the same form.
    """
    if not _OTHER.search(m[0]):
        return m[0]
    plain = unicodedata.normalize("NFD", m[0]).translate(_TO_LATIN)
    scripts = set()
    for ch in plain:
        n = ord(ch)
        if 0x400 <= n <= 0x52F:
            scripts.add("c")
        elif 0x370 <= n <= 0x3FF:
            scripts.add("g")
        elif ch.isalpha() and n not in _TO_CYRILLIC and n not in _TO_GREEK:
            scripts.add("l")
    if scripts == {"c"}:
        plain = plain.translate(_TO_CYRILLIC)
    elif scripts == {"g"}:
        plain = plain.translate(_TO_GREEK)
    return unicodedata.normalize("NFC", plain)


def _segment(m: re.Match) -> str:
    return unicodedata.normalize("NFC", m[0].translate(_tables()[0]))


def canonical(text: str | None) -> str | None:
    """The form of one text; null stays null, empty stays empty. Of linear cost, so texts of any length are taken whole."""
    if text is None or text.isascii() and re.match(r"[\n\t -~]*\Z", text):
        return text
    spliced = _tables()[1].sub(_segment, text.replace("\r\n", "\n").replace("\r", "\n"))
    if not unicodedata.is_normalized("NFC", spliced):  # dropping what does not show can bring a mark to its letter
        spliced = unicodedata.normalize("NFC", spliced)
    return _WORD.sub(_word, spliced) if _OTHER.search(spliced) else spliced


def _canonical_series(s: pd.Series) -> pd.Series:
    return s.map(canonical, na_action="ignore")


def canonical_column(c: Column) -> Column:
    """The form of a string column. Rows should be split by `stable` first, as Spark runs the UDF on every row it sees."""
    return F.pandas_udf(_canonical_series, "string")(c)


def stable(c: Column) -> Column:
    """Whether the text is its own form for certain, by a test in the JVM."""
    return c.rlike(STABLE)


def _canonical_arrays(s: pd.Series) -> pd.Series:
    return s.map(lambda texts: [canonical(t) for t in texts], na_action="ignore")


def canonical_texts(samples: DataFrame) -> DataFrame:
    """All texts of all samples: (id, is_gt, candidate_id, text, canonical); candidate_id is null for the gt.

    Null texts give no row, empty texts an empty form. Deliveries of a sample in several rows give one row; candidates of
    one id, or of none, with different texts are all there.
    """
    pair = F.concat(
        F.array(F.struct(F.lit(True).alias("is_gt"), F.lit(None).cast("string").alias("candidate_id"), F.col("gt").alias("text"))),
        F.coalesce(F.transform("candidates", lambda c: F.struct(F.lit(False).alias("is_gt"), c["id"].alias("candidate_id"), c["text"].alias("text"))), F.array()),
    )
    texts = samples.select("id", F.explode(pair).alias("__t")).select("id", "__t.*").filter(F.col("text").isNotNull()).distinct()
    fixed = texts.filter(stable(F.col("text"))).withColumn("canonical", F.col("text"))
    moved = texts.filter(~stable(F.col("text"))).withColumn("canonical", canonical_column(F.col("text")))
    return fixed.unionByName(moved)


def equal_answers(samples: DataFrame) -> DataFrame:
    """(id, candidate_id): candidates whose text differs from the gt of their sample as a string and equals it in form.

    Null gt, null text and empty lists give no row. Pairs of two stable texts are their own forms and were seen to
    differ. The gt of a sample is normalised once, with all candidates that are open.
    """
    differs = lambda c: F.coalesce((c["text"] != F.col("gt")) & ~(F.col("__stable") & stable(c["text"])), F.lit(False))
    rows = samples.filter(F.col("gt").isNotNull() & F.col("id").isNotNull()).withColumn("__stable", stable(F.col("gt")))
    rows = rows.select("id", "gt", F.filter("candidates", differs).alias("__open")).filter(F.size("__open") > 0)
    texts = F.concat(F.array("gt"), F.transform("__open", lambda c: c["text"]))
    # Nondeterministic, so that no filter on the result computes it again.
    forms = rows.select("id", F.col("__open.id").alias("__ids"), F.pandas_udf(_canonical_arrays, "array<string>").asNondeterministic()(texts).alias("__forms"))
    each = forms.select("id", F.get("__forms", F.lit(0)).alias("a"), F.explode(F.arrays_zip(F.col("__ids").alias("candidate_id"), F.slice("__forms", F.lit(2), F.size("__ids")).alias("b"))).alias("__c"))
    return each.filter(F.col("a") == F.col("__c.b")).select("id", F.col("__c.candidate_id").alias("candidate_id")).distinct()
