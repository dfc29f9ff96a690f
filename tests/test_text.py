from __future__ import annotations

import unicodedata

import pytest
from pyspark.sql import functions as F

from pagelode.functions import text as X
from pagelode.functions.similarity import lexical_scores, title_scores
from pagelode.operators import quality


def one(spark, expression, value):
    return spark.createDataFrame([(value,)], "t string").select(expression(F.col("t")).alias("x")).first()[0]


@pytest.mark.parametrize(
    "given, expected",
    [("Legi de compoziþie. Sã facem cunoºtinþã.", "Legi de compoziţie. Să facem cunoştinţă."), ("2 \x96 5", "2 – 5"), ("\x81a", "\x81a"), (None, "")],
)
def test_stored_repair(spark, given, expected):
    assert one(spark, X.stored_repair, given) == expected


@pytest.mark.parametrize("given", ["compoziþie", "compoziÆie", "compoziție", "COMPOZIŢIE"])
def test_legacy_spellings_match(spark, given):
    assert one(spark, X.match_form, given) == "compozitie"


@pytest.mark.parametrize("given, expected", [("façade", "fasade"), ("são", "sao"), ("Straße", "strasse"), ("Ælfric", "tlfric"), ("²x_y", "²x_y"), ("λόγος!", "λογοσ"), ("", "")])
def test_match_form_traps(spark, given, expected):
    assert one(spark, X.match_form, given) == expected


@pytest.mark.parametrize(
    "given, expected",
    [("1.1. Titlu", "1.1"), ("Capitolul 3) Inele", "3"), ("chapter 2.4 Rings", "2.4"), ("1.1.Titlu", None), ("3", None), ("1.2.3.4.5.6 x", None), ("６ — Titlu", "6"), ("Titlu 1", None)],
)
def test_section_label(spark, given, expected):
    assert one(spark, X.section_label, given) == expected


@pytest.mark.parametrize("given, expected", [("Inele ........ 12", "Inele"), ("x 12345", "x 12345"), ("Inele12", "Inele12"), ("x. 5", "x."), ("12", "")])
def test_without_page(spark, given, expected):
    assert one(spark, X.without_page, given) == expected


def test_contents_line_has_no_word_boundary(spark):
    assert one(spark, X.contents_page, "x 12345") == 2345
    assert one(spark, X.contents_title, "1.1. Legi ........ 3") == "Legi"


def test_white_space_class(spark):
    spaces = [c for c in map(chr, range(0x3002)) if c.isspace()]
    assert len(spaces) == 29
    out = spark.createDataFrame([(c,) for c in map(chr, range(1, 0x3002)) if not 0xD800 <= ord(c) < 0xE000], "c string").where(F.col("c").rlike(f"^{X.SPACE}$")).collect()
    assert sorted(r[0] for r in out) == sorted(spaces)


def test_control_escape_and_restore(spark):
    df = spark.createDataFrame([("x\x1dy",)], "t string").select(X.count_controls(F.col("t")).alias("n"), X.escape_controls(F.col("t")).alias("e"))
    df = df.select("n", X.restore_word(F.col("e")).alias("r"), X.unresolved_codes(F.col("e")).alias("c"))
    assert tuple(df.first()) == (1, "x�y", ["U+001D"])


def test_quality_gate(spark):
    rows = [("\x02\x03\x04\x05abc",), ("Aceasta este o propoziție curată.",), ("\f\f",), (None,), ("a" * 199 + "\x01",), ("a" * 99 + "��",), ("x\x85y",)]
    out = quality.assess(spark.createDataFrame(rows, "text string")).collect()
    assert [r["status"] for r in out] == ["UNUSABLE", "GOOD", "EMPTY", "EMPTY", "GOOD", "SUSPECT", "UNUSABLE"]
    assert out[6]["control_count"] == 1 and out[6]["non_whitespace_count"] == 2
    text = "aă Îß²5"
    assert one(spark, lambda c: X.character_counts(c)["alphabetic_count"], text) == sum(map(str.isalpha, text)) == 4


def test_flag_names_and_slug_and_snippet(spark):
    assert one(spark, lambda c: X.flag_names(F.lit(19)), "") == ["superscript", "italic", "sans", "proportional", "bold"]
    assert one(spark, lambda c: X.slug(c, "lesson"), "  Legi de Compoziție! ") == "legi-de-compozitie"
    assert one(spark, lambda c: X.slug(c, "query"), "!!!") == "query"
    assert one(spark, X.snippet, "a  b\n" * 300).endswith("…") and len(one(spark, X.snippet, "ab " * 300)) <= 420
    assert one(spark, X.snippet, " a \n b ") == "a b"


def test_composed_is_nfc(spark):
    text = unicodedata.normalize("NFD", "mulțimi în spațiu")
    assert one(spark, X.composed, text) == unicodedata.normalize("NFC", text)


def _python_score(query: str, title: str) -> float:
    from difflib import SequenceMatcher

    if not query or not title:
        return 0.0
    if query == title:
        return 1.0
    a, b = query.split(), title.split()
    jac = len({*a} & {*b}) / len({*a} | {*b})
    short, long = (query, title) if len(a) <= len(b) else (title, query)
    run = min(len(a), len(b)) >= 2 and f" {short} " in f" {long} "
    return min(1.0, max(0.55 * jac + 0.45 * SequenceMatcher(None, query, title).ratio(), 0.75 + 0.25 * len(short) / len(long) if run else 0.0))


def test_prefilter_loses_no_title(spark):
    words = ["legi", "de", "compozitie", "grupuri", "inele", "pe", "o", "multime", "e", "c"]
    titles = sorted({" ".join(words[(i * j + k) % 10] for k in range(1 + (i + j) % 5)) for i in range(12) for j in range(12)} | {"", "legi de compozitie", "de compozitie"})
    queries = ["legi de compozitie", "inele", "e c", "grupuri de inele pe o multime"]
    pairs = spark.createDataFrame([(q, t) for q in queries for t in titles], "query string, title string")
    got = {(r["query"], r["title"]): round(r["title_score"], 9) for r in title_scores(pairs).collect()}
    expected = {(q, t): round(s, 9) for q in queries for t in titles if (s := _python_score(q, t)) >= 0.42}
    assert got == expected
    assert lexical_scores(pairs).where("containment > 0 AND query = 'e c'").where("title = 'de compozitie'").count() == 0


def test_similarity_is_planned_once(spark):
    pairs = spark.createDataFrame([("a b", "a b c")], "query string, title string").distinct()
    plan = title_scores(pairs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_normal_forms_are_complete(spark):
    """Every character alone and between letters: the short ways give what the full functions do."""
    import unicodedata

    signs = [chr(n) for n in range(1, 0x10000) if not 0xD800 <= n <= 0xDFFF] + [chr(n) for n in range(0x10000, 0x1FFFF, 7)]
    texts = [form for c in signs for form in (c, f"a{c}b")] + ["ș\u0327", "e\u0301", "ſß", "İI", None]
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string")
    for r in df.select("t", X.composed(F.col("t")).alias("c"), X.folded(F.col("t")).alias("f"), X.search_folded(F.col("t")).alias("s"), X.folded(X.search_repair(F.col("t"))).alias("s2")).toLocalIterator():
        t = r["t"] or ""
        assert r["c"] == unicodedata.normalize("NFC", t) and r["s"] == r["s2"], t
        assert r["f"] == "".join(c for c in unicodedata.normalize("NFD", t) if unicodedata.category(c) != "Mn").casefold(), t
