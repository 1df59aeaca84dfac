import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cropmill.llm import canonical as c

SAME = [("ＡＢ１２", "AB12"), ("été", "été"), ("a​b­c﻿", "abc"), ("a b c", "a b c"), ("аpple", "apple"), ("Ω", "Ω"), ("ﬁx", "fix"), ("⽂", "文"), ("a‑b‐c", "a-b-c"), ("e‍́", "é"), ("ёлка", "ёлkа".replace("k", "к")), ("маcca", "масса"), ("СОР", "COP"), ("a\r\nb", "a\nb"), ("⾕", "谷")]
OTHER = [("m²", "m2"), ("é", "e"), ("A", "a"), ("O", "0"), ("l", "1"), ("rn", "m"), ("a b", "a  b"), ("ß", "ss"), ("ё", "е"), ("。", "."), ("ж", "k"), ("½", "1/2"), ("°", "o")]


@pytest.mark.parametrize("a,b", SAME)
def test_same_look(a, b):
    assert c.canonical(a) == c.canonical(b)


@pytest.mark.parametrize("a,b", OTHER)
def test_other_look(a, b):
    assert c.canonical(a) != c.canonical(b)


def test_words_keep_their_script():
    assert c.canonical("Русский текст, ёлка") == "Русский текст, ёлка"
    assert c.canonical("Αθήνα") == unicodedata.normalize("NFC", "Αθήνα")
    assert c.canonical("pаge") == "page" and c.canonical("pусcкий") == "русский"


def brute(s):
    """Every character folded by itself, then composed; no segments, no splicing."""
    s = "".join(c._tables()[0].get(ord(x), x) for x in s.replace("\r\n", "\n").replace("\r", "\n"))
    s = unicodedata.normalize("NFC", unicodedata.normalize("NFC", s))
    return c._WORD.sub(c._word, s) if c._OTHER.search(s) else s


chars = st.sampled_from(list("aeo \n\r1-") + ["é", "́", "̈", "̧", "​", "﻿", " ", "Ａ", "ﬁ", "а", "е", "ж", "Ω", "Ω", "中", "⽂", "가", "ᄀ", "ᅡ", "ᆨ", "̀", "̈́", "ß"])


@settings(max_examples=500, deadline=None)
@given(st.text(chars, max_size=12))
def test_splicing_equals_whole_normalisation(s):
    got = c.canonical(s)
    assert got == brute(s)
    assert c.canonical(got) == got


def test_long_text_is_linear():
    import time

    t = time.time()
    for s in ("а" * 300_000, "é" * 200_000, "​" * 300_000, "中" * 300_000 + "ж"):
        c.canonical(s)
    assert time.time() - t < 20


SCHEMA = "id string, gt string, candidates array<struct<id:string,text:string>>, extra int"


def test_equal_answers_and_texts(spark):
    rows = [("a", "x 1", [("c0", "x 1"), ("c1", "x 1"), ("c2", "x 2"), ("c3", None)], 1), ("a", "x 1", [("c0", "x 1")], 2), ("b", None, [("c0", "x")], 1), ("c", "q", None, 1), ("d", "q", [], 1), ("e", "", [("c0", "​"), ("c1", "")], 1), (None, "a", [("c0", "а")], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {tuple(r) for r in c.equal_answers(df).collect()} == {("a", "c0"), ("e", "c0")}
    texts = {(r.id, r.candidate_id): r.canonical for r in c.canonical_texts(df).collect()}
    assert texts["a", "c0"] == texts["a", None] == "x 1" and texts["e", "c0"] == "" and ("b", None) not in texts and ("a", "c3") not in texts
    assert c.equal_answers(df.limit(0)).count() == 0


def test_final_line_terminators_are_not_stable(spark):
    ends = ["\n", "\r", "\r\n", chr(0x85), chr(0x2028), chr(0x2029)]
    rows = [(f"r{i}", f"abc{e}", [("c0", "abc\n")], 1) for i, e in enumerate(ends)]
    df = spark.createDataFrame(rows, SCHEMA)
    texts = {r.id: r.canonical for r in c.canonical_texts(df).filter("is_gt").collect()}
    assert texts == {f"r{i}": c.canonical(f"abc{e}") for i, e in enumerate(ends)}
    assert {r[0] for r in c.equal_answers(df).collect()} == {f"r{i}" for i, e in enumerate(ends) if c.canonical(f"abc{e}") == "abc\n" and e != "\n"} >= {"r1", "r2"}


def test_candidates_without_an_id_are_all_there(spark):
    rows = [("a", "q", [(None, "x"), (None, "ｙ"), ("c", "q")], 1), (None, "p", [(None, "p")], 1), (None, "r", None, 1)]
    got = sorted((r.id or "", r.is_gt, r.text, r.canonical) for r in c.canonical_texts(spark.createDataFrame(rows + rows[:1], SCHEMA)).collect())
    assert got == [("", False, "p", "p"), ("", True, "p", "p"), ("", True, "r", "r"), ("a", False, "q", "q"), ("a", False, "x", "x"), ("a", False, "ｙ", "y"), ("a", True, "q", "q")]
    assert {tuple(r) for r in c.equal_answers(spark.createDataFrame([("a", "y", [(None, "ｙ"), ("d", "y")], 1)], SCHEMA)).collect()} == {("a", None)}
