from __future__ import annotations

import pytest

from pagelode.llm import confusables as C
from pagelode.llm import mojibake as M

SENTENCE = "Să arătăm că mulțimea numerelor întregi îndeplinește toate condițiile din ipoteză, și totodată suma parțială"
LEXICON = {w: 50 for w in M.UNITS.findall(SENTENCE.lower())} | {"→": 40, "∈": 40, "∪": 40, "π": 40, "δ": 30, "„": 60, "”": 60, "–": 60, "³": 30, "·": 30, "că": 90, "şi": 3, "razão": 9, "façade": 9, "þing": 9, "º": 9}


@pytest.fixture(scope="module")
def decoder():
    return M.Decoder(LEXICON)


@pytest.mark.parametrize("page", ["cp1252", "latin-1", "cp1250", "iso8859-2", "mac_roman", "cp850", "cp437", "cp852"])
def test_round_trip(decoder, page):
    shown = "".join(bytes([b]).decode(page, "ignore") or chr(b) for b in SENTENCE.encode())
    restored, channels = decoder.decode(shown)
    assert restored == SENTENCE and channels


def test_twice_and_in_part(decoder):
    once = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in SENTENCE.encode())
    twice = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in once.encode())
    assert decoder.decode(twice)[0] == SENTENCE
    assert decoder.decode("Să arătÄƒm că n â†’ 3")[0] == "Să arătăm că n → 3"


@pytest.mark.parametrize("given, expected", [("totodatã mulþimea ºi", "totodată mulțimea și"), ("totodatã mulæimea", "totodată mulțimea"), ("\x84suma\x94 \x96 x", "„suma” – x"), ("mulÈ�imea cÄ� suma", "mulțimea că suma"), ("Â· (x + 2)Â³", "· (x + 2)³")])
def test_legacy_and_lost(decoder, given, expected):
    assert decoder.decode(given)[0] == expected


@pytest.mark.parametrize("text", ["(termenul portughez „razão”)", "(cuvântul francez „façade”)", "(în islandeză „þing”)", "vezi ediția a 2ª, nota 1º", "unghiul de 35º", "Ångström", "„Übung” și „naïve”", "det�rmină", "x\x02y", "x² și y³ – π/4 → ∈", "λόγος множество", ""])
def test_right_text_stays(decoder, text):
    assert decoder.decode(text) == (text, ())


def test_decoded_rows(spark):
    rows = [("t", "m", "1", "totodatÄƒ", "x"), ("t", "m", "2", "totodată", "x"), ("t", None, "3", None, "x"), ("t", "m", "4", "", "x"), ("t", "m", "5", "suma " * 50_000 + "totodatÄƒ", "x")]
    df = spark.createDataFrame(rows, "source_table string, manual_id string, record_id string, text string, restored string")
    out = M.decoded(df, LEXICON, ["source_table", "manual_id", "record_id"], "text").collect()
    assert {r["record_id"] for r in out} == {"1", "5"} and all("totodată" in r["restored"] for r in out)
    assert M.decoded(df.limit(0), LEXICON, ["record_id"], "text").count() == 0
    assert M.lexicon([df.select("text"), df.select("text").limit(0)]) == {}


SAME = "Soluția finită a secțiunii X-a"


@pytest.mark.parametrize(
    "text",
    ["Soluţia finită a secţiunii X-a", "Soluția finită a secțiunii X-a", "Soluția finită a　secțiunii X-a", "So​luția fi­nită a secțiunii﻿ X-a", "Soluția ﬁnită a secțiunii X-a", "Soluția finită a secțiunii X‑a", "Ｓｏｌｕția ｆｉｎｉtă ａ ｓｅｃțｉｕｎｉｉ Ｘ－ａ", "Sоluțiа finită а sеcțiunii Х-а", "Sοluția finită a secțiunii Χ-a", "Soluția finitӑ a secțiunii X-a", "Soluţia finită a secțiunii X-a"],
)
def test_one_form(text):
    if "ӑ" in text:
        text = text.replace("ӑ", "ӑ")
    assert C.ordinary(text) == SAME and C.skeleton(text) == C.skeleton(SAME)


@pytest.mark.parametrize("text", ["Δ = 3, α + β, Σ k, π/4, ν", "x² + y³", "cuvântul „множество”", "termenul „число”", "în greacă „λόγος”", "„ghilimele” – și — linii", "det�rmină \x02", "Ångström naïve", SAME, ""])
def test_ordinary_text_stays(text):
    assert C.ordinary(text) == text


def test_single_letters_of_another_alphabet():
    assert C.ordinary("74х + 388у, М(901), А ∪ В, Α ∪ Β") == "74x + 388y, M(901), A ∪ B, A ∪ B"


def test_consistent_rows_and_classes(spark):
    rows = [("1", SAME, "x"), ("2", SAME.replace("ț", "ţ"), "x"), ("2", SAME.replace("ț", "ţ"), "x"), ("3", None, "x"), ("4", "", "x"), ("5", "totodatÄƒ suma", "x"), ("6", "a " * 50_000 + " ", "x")]
    df = spark.createDataFrame(rows, "record_id string, text string, skeleton string")
    out = C.consistent(df, ["record_id"], "text", LEXICON).collect()
    assert sorted((r["record_id"], r["misread"]) for r in out) == [("2", False), ("2", False), ("5", True), ("6", False)]
    assert [tuple(r) for r in C.classes(df, "text").collect()] == [(SAME, 2, 3)]
    assert C.classes(df.limit(0), "text").count() == 0 and C.consistent(df.limit(0), ["record_id"], "text").count() == 0


@pytest.mark.parametrize("page", ["cp1251", "cp1253"])
def test_code_pages_of_other_alphabets(decoder, page):
    shown = "".join(bytes([b]).decode(page, "ignore") or chr(b) for b in SENTENCE.encode())
    assert decoder.decode(shown)[0] == SENTENCE
    for right in ("ГОСТ” и „РОССИИ”", "множество ВГД", "Δ² – βx², Γ·x"):
        assert decoder.decode(right) == (right, ())


def test_any_number_of_lost_bytes(decoder):
    words = "mulțimea condițiile totodată îndeplinește".split()
    shown = ["".join(bytes([b]).decode("cp1252", "ignore") if b < 0x80 or b >= 0xC0 else "�" for b in w.encode()) for w in words]
    text = "că  " + " ".join(shown * 6)
    assert decoder.decode(text)[0] == "că  " + " ".join(words * 6)
    strange = "q".join(["È�"] * 40) + "Äƒ"
    assert "�" in decoder.decode(strange)[0]


def test_best_reading_equals_all_readings(decoder):
    import random
    from itertools import product

    rng = random.Random(3)
    pool = ["ă", "ș", "ț", "–", "m", "a", "c", "Ș", "→", "i"]
    for _ in range(300):
        parts = [tuple(rng.sample(pool, rng.choice((1, 1, 2, 3)))) for _ in range(rng.randrange(1, 6))]
        every = [decoder.likelihood("".join(r)) - M.CAPITAL_COST * sum(c > "\x7f" and c.isupper() for c in r) for r in product(*parts)]
        assert decoder.best(parts)[0] >= max(every) - 1e-9


@pytest.mark.parametrize("given, expected", [("mаtеmatiкa", "matematika"), ("множеctво", "множеctво"), ("Аո օrice", "An orice"), ("Ⅷ și 𝐱𝑦", "VIII și xy"), ("ℝ ⊂ ℂ, sinα + Δx", "ℝ ⊂ ℂ, sinα + Δx"), ("a\U000e0041b", "ab")])
def test_mixed_words_and_styles(given, expected):
    assert C.ordinary(given) == expected
