from __future__ import annotations

import math
import random
from collections import defaultdict

import pytest

from pagelode.llm import quality as Q

PROSE = "Elevul atent verifică soluția problemei după câteva înlocuiri, iar profesorul explică regula de calcul. Clasa noastră citește enunțul de două ori și notează răspunsul corect."
COMMON = frozenset(w.lower() for w in Q.LONG.findall(PROSE + " mulțimea numerelor întregi soluția grupul ciclic divizorul comun planul secant limita căutată"))


def kind(text):
    listed, table, junk, repetition = Q.shares(text, COMMON)
    if repetition >= 0.8 and table < 0.5:
        return "junk"
    if listed + table + junk < 0.5:
        return None
    return "junk" if junk >= table and junk >= listed else "table" if table >= listed else "list"


WRAPPED = "Elevul atent verifică soluția\nproblemei după câteva\nînlocuiri, iar profesorul\nexplică regula de calcul. Clasa\nnoastră citește enunțul de două\nori și notează răspunsul."


@pytest.mark.parametrize(
    "text, expected",
    [
        (PROSE, None), (WRAPPED, None), ("– " + PROSE + "\n– " + PROSE, None), (PROSE * 2 + "\n- grupul ciclic\n- planul secant", None),
        ("- grupul ciclic\n- divizorul comun\n- planul secant\n- limita căutată", "list"), ("1.1. grupul ciclic ........ 3\n1.2. planul secant ........ 17\n2.1. limita căutată ..... 20", "list"),
        ("12,5\tgrupul ciclic\t7\n3,1\tplanul secant\t8", "table"), ("1;2;3\n4;5;6\n7;8;9", "table"), ("3 ¦ 4 ¦ grupul ciclic\n5 ¦ 6 ¦ planul secant", "table"),
        ("zvgdnxs mqmgpkjfw gnjbdnq zldfmqxpb dqbngfw\npwrt jcbx jmsqqs qjlpw", "junk"), ("grupul ciclic " * 40, "junk"), ("~1%60 ~*>>17[ 0=%9\\^8{7> >/0]85* 4<62@0}#*0 ^7]|%=", "junk"), ("uuuuuu aaaa kkkkkkkk " * 5, "junk"),
    ],
)
def test_kinds(text, expected):
    assert kind(text) == expected


def test_tail_shares_equal_brute_force(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.choice("st"), rng.choice([0.0, 0.25, 0.5, round(rng.random(), 3), 1.0])) for _ in range(3000)]
    counted = defaultdict(int)
    for r in rows:
        counted[r] += 1
    df = spark.createDataFrame([(*k, n) for k, n in counted.items()], "language string, statistic string, value double, n bigint")
    got = {(r["language"], r["statistic"], r["value"]): r["at_least"] for r in Q.tail_shares(df).collect()}
    expected = {k: sum(n for o, n in counted.items() if o[:2] == k[:2] and o[2] >= k[2]) for k in counted if k[2] > 0}
    assert got == expected


_RNG = random.Random(8)
LONG_PROSE = " ".join(" ".join(_RNG.choices(sorted(COMMON), k=12)).capitalize() + "." for _ in range(4000))


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string, kind string, statistic string")


def test_documents(spark):
    prose = [(n, PROSE + f" Nota {n}, grupul ciclic, divizorul comun, planul secant.", "ro", "x", "x", "x") for n in range(30)]
    odd = [(100, "- grupul ciclic\n- divizorul comun\n- planul secant", "ro"), (101, "1;2;3\n4;5;6", None), (102, "zvgdnxs mqmgpkjfw gnjbdnq zldfmqxpb", ""), (103, None, "ro"), (104, "", "ro"), (105, " \n ", "ro"), (106, LONG_PROSE, "xx"), (None, PROSE, "ro")]
    df = table(spark, prose + [(*r, "x", "x", "x") for r in odd])
    out = {r["doc_id"]: r["kind"] for r in Q.document_forms(df.union(df.where("doc_id = 100"))).collect()}
    assert {k: v for k, v in out.items() if v} == {100: "list", 101: "table", 102: "junk"}
    assert 103 not in out and 104 not in out and 105 not in out and out[106] is None
    assert Q.document_forms(df.limit(0)).count() == 0


def test_kind_needs_no_other_documents(spark):
    lists = [(n, "- grupul ciclic\n- divizorul comun\n- planul secant", "hu", "x", "x", "x") for n in range(3)]
    prose = [(n, PROSE + " Grupul ciclic, divizorul comun, planul secant.", "ro", "x", "x", "x") for n in range(3, 9)]
    assert {r["doc_id"] for r in Q.document_forms(table(spark, lists + prose)).where("kind = 'list'").collect()} == {0, 1, 2}


def test_scores_equal_brute_force(spark):
    rng = random.Random(9)
    words = sorted(COMMON)
    texts = [" ".join(rng.choices(words, k=rng.randrange(1, 40))) + rng.choice([".", "", "\n- a\n- b\n", " ~~ ## 12"]) for _ in range(120)]
    df = table(spark, [(n, t, rng.choice(["ro", "en", None]), "x", "x", "x") for n, t in enumerate(texts)])
    rows = Q.ranked_documents(df).collect()
    assert len(rows) == 120
    for r in rows:
        own = [x for x in rows if x["language"] == r["language"]]
        expected = sum(-math.log(sum(x[s] >= r[s] for x in own) / len(own)) for s in Q.STATISTICS if r[s] > 0)
        assert r["score"] == pytest.approx(expected, abs=1e-9)


GLOSSARY = "transformarea liniară: 200\npermutarea pară: 5\n– profesorul de la catedră\nelevul atent: 283\nintegrala definită: 117\n– divizorul comun.\ndreapta tangentă: 261"
NARROW = "Este evident că divizorul comun definește aria\nsuprafeței hașurate cu ajutorul unui desen ajutător.\nPrin urmare, dreapta tangentă descrie coeficienții\nnecunoscuți, întrucât lim a_n = 9536/71."
_TERMS = sorted({w.lower() for w in Q.LONG.findall(GLOSSARY + " " + NARROW)})


def _many(n, kind):
    """A text of that kind, of the words of both texts above."""
    rng = random.Random(f"{n} {kind}")
    entry = lambda: " ".join(rng.choices(_TERMS, k=2))
    if kind == "list":
        return "\n".join(rng.choice([f"- {entry()}", f"• {entry()};", f"- {entry()}.", f"{entry()}: {rng.randrange(300)}"]) for _ in range(rng.randrange(4, 12)))
    sentence = lambda: f"{' '.join(rng.choices(_TERMS, k=rng.randrange(8, 12)))}, {' '.join(rng.choices(_TERMS, k=4))}.".capitalize()
    if kind == "prose":
        return "\n".join(sentence() for _ in range(rng.randrange(3, 8)))
    words = " ".join(sentence() for _ in range(5)).split()
    return "\n".join(" ".join(words[k : k + 6]) for k in range(0, len(words), 6))


@pytest.mark.parametrize("lang", ["ro", "hu"])
def test_ranks_decide_how_lines_are_read(spark, lang):
    """Hungarian has no other document of its own, so all languages' documents are compared there."""
    others = [(n, _many(n, ("list", "list", "prose", "prose", "prose", "wrapped")[n % 6]), "ro") for n in range(900)]
    out = {r["doc_id"]: r["kind"] for r in Q.document_forms(table(spark, [(*r, "x", "x", "x") for r in [*others, (1000, GLOSSARY, lang), (1001, NARROW, lang)]])).collect()}
    assert (out[1000], out[1001]) == ("list", None)
    assert all(out[n] == ("list" if n % 6 < 2 else None) for n in range(900))
    few = {r["doc_id"]: r["kind"] for r in Q.document_forms(table(spark, [(*r, "x", "x", "x") for r in [*others[:90], (1000, GLOSSARY, lang), (1001, NARROW, lang)]])).collect()}
    assert (few[1000], few[1001]) == (None, "list")  # the first reading, as there are no ranks


def test_evidence_equals_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for n in range(1500):
        kind = rng.choice([None, None, "list", "list", "table"])
        values = [round(rng.choice([0.0, 0.5, 1.0, rng.random()]), 3) for _ in Q.RANKED] if rng.random() < 0.9 else [round(rng.random(), 3)] + [None] * 4
        rows.append((n, rng.choice(["ro", "ro", "ro", "en", "en", "fr"] if n < 1450 else ["it"]), kind, *values))
    forms = spark.createDataFrame(rows, "doc_id bigint, language string, kind string, " + ", ".join(f"{s} double" for s in Q.RANKED))
    got = {r["doc_id"]: r["evidence"] for r in Q.line_evidence(forms).collect()}
    ranked = [r for r in rows if r[4] is not None and r[2] != "table"]
    assert len(got) == len(rows)
    for n, language, kind, *values in rows:
        expected = 0.0
        if values[1] is not None and kind != "table":
            own = [r for r in ranked if r[1] == language]
            if min(sum(r[2] is None for r in own), sum(r[2] == "list" for r in own)) < Q.LEAST:
                own = ranked
            prose, lists = [r[3:] for r in own if r[2] is None], [r[3:] for r in own if r[2] == "list"]
            floor = 1 / (min(len(prose), len(lists)) + 1)
            for k, v in enumerate(values):
                expected += math.log(max(floor, sum(x[k] <= v for x in lists) / len(lists))) - math.log(max(floor, sum(x[k] >= v for x in prose) / len(prose)))
        assert got[n] == pytest.approx(expected, abs=1e-9)


def test_figures(spark):
    df = table(spark, [(1, "ab 1\x01�\n", "ro", "", "", ""), (2, None, None, "", "", "")])
    out = {r["doc_id"]: r for r in Q.text_figures(df).collect()}
    assert (out[1]["character_count"], out[1]["control_count"], out[1]["replacement_count"], out[1]["alphabetic_count"], out[1]["control_ratio"]) == (7, 1, 1, 2, 0.2)
    assert out[2]["character_count"] == 0 and out[2]["alphabetic_ratio"] == 0.0


@pytest.mark.parametrize("label, expected", [("RO", "ro"), ("ro-RO", "ro"), ("rom.", "ro"), ("română", "ro"), ("en_US", "en"), ("de-AT", "de"), ("unknown", None), (" ", None), (None, None), ("xx", None), ("spaniolă", "es")])
def test_labels(spark, label, expected):
    from pyspark.sql import functions as F

    assert spark.createDataFrame([(label,)], "l string").select(Q.label_language(F.col("l"))).first()[0] == expected
