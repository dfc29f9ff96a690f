from __future__ import annotations

import random
from collections import Counter

import pytest

from pagelode.llm import boilerplate as B

LINE = "manual_id string, page_id string, pdf_page_number int, line_id string, text string, form string, content string"


def manual(spark, lines, labels=None):
    rows = [(m, f"p{p:04d}", p, f"p{p:04d}-l{k}", t, "clash", "clash") for k, (m, p, t) in enumerate(lines)]
    pages = [(m, f"p{p:04d}", p, (labels or {}).get(p, str(p - 2)), 7) for m in {r[0] for r in rows} - {None} for p in range(1, 14)]
    return spark.createDataFrame(rows, LINE), spark.createDataFrame(pages, "manual_id string, page_id string, pdf_page_number int, page_label string, offset int")


def found(spark, lines, **more):
    df, pages = manual(spark, lines, **more)
    return sorted({int(r["line_id"].split("l")[1]) for r in B.repeated_lines(df, pages).collect()})


NOTICE = "Exemplar gratuit, nu este destinat comercializării"


def test_readers_sameness(spark):
    forms = [NOTICE, NOTICE.upper(), NOTICE.replace(" ", " "), NOTICE.replace("a", "а"), "Exemplar gratiut, nu este destinat comercializării".replace("iu", "ui"), "Exemplar gratuit, nu este destinat comercializăii", NOTICE]
    assert found(spark, [("m", p, t) for p, t in enumerate(forms, 1)]) == list(range(7))


def test_slips_of_one_line_need_no_common_bucket(spark):
    lines = ["Capitole alese", "Manual școlar", "Culegere de probleme", "Exerciții rezolvate", "Teste de evaluare"]
    slips = [("m", p, t if p < 4 else t[: 3 * p - 10] + "w" + t[3 * p - 9 :]) for t in lines for p in range(1, 7)]
    assert found(spark, slips) == list(range(30))
    assert found(spark, [x for x in slips if x[1] < 6]) == []


def slipped(rng, line, at):
    kind = rng.randrange(4)
    letter = rng.choice("bdfghjkmnpqrtwyz")
    if kind == 0:
        return line[:at] + letter + line[at + 1 :]
    if kind == 1:
        return line[:at] + line[at + 1 :]
    return line[:at] + letter + line[at:] if kind == 2 else line[:at] + line[at + 1 : at + 2] + line[at] + line[at + 2 :]


def test_recall_of_slips_at_every_length(spark):
    """40 manuals a cell, each with the right line on some pages and the line with one slip each on others."""
    rng = random.Random(12)
    cells = [(size, right, wrong) for size in (31, 17, 13, 5) for right, wrong in ((3, 3), (4, 2), (5, 1), (1, 5), (2, 6))]
    lines = []
    for cell in cells:
        for n in range(40):
            size, right, wrong = cell
            line = "".join(rng.choices("abdefghjkmnopqrstuwyz", k=size))
            pages = rng.sample(range(1, 14), right + wrong)
            texts = [line] * right + [slipped(rng, line, rng.randrange(size)) for _ in range(wrong)]
            lines += [(f"{cell} {n}", p, t) for p, t in zip(pages, texts)]
    df, pages = manual(spark, lines)
    got = Counter(r["manual_id"] for r in B.repeated_lines(df, pages).collect())
    for cell in cells:
        assert sum(got[f"{cell} {n}"] == cell[1] + cell[2] for n in range(40)) >= 38, cell


def test_slips_beside_a_more_frequent_line_of_the_same_frame(spark):
    frame = lambda w: f"Arătați că {w} este bine definită pe mulțimea dată"
    line = frame("derivata")
    lines = [("m", p, frame("integrala")) for p in range(1, 13)] + [("m", 1, line)] + [("m", p, line[:k] + line[k + 1 :]) for p, k in zip(range(2, 8), (1, 9, 14, 22, 30, 41))]
    assert found(spark, lines) == list(range(19))


def test_components_equal_union_find(spark):
    rng = random.Random(5)
    edges = [(c, *sorted(rng.sample(range(-40, 40), 2))) for c in (1, 2) for _ in range(45)] + [(3, n, n + 1) for n in range(40)]
    root = {(c, n): n for c, *ends in edges for n in ends}

    def find(c, n):
        while root[c, n] != n:
            n = root[c, n]
        return n

    for c, a, b in edges:
        a, b = sorted((find(c, a), find(c, b)))
        root[c, b] = a
    df = spark.createDataFrame(edges, "content bigint, fid bigint, lead bigint")
    assert {(r["content"], r["fid"]): r["root"] for r in B.components(df).collect()} == {(c, n): find(c, n) for c, n in root}
    assert B.components(df.limit(0)).count() == 0


@pytest.mark.parametrize("text, form, numbers", [("Un oraș mic civil, vid", "unorasmiccivilvid", ""), ("Capitolul XIV, anul 2021", "capitolul0anul0", "xiv 2021"), ("pagina 7", "pagina#", ""), ("IIII", "iiii", "")])
def test_only_numerals_are_numbers(text, form, numbers):
    assert B.masked(text, 9, 2) == (form, numbers)


def test_hashes_without_one_letter():
    forms = ["gratuit", "gratit", "x", "", "abcde#0", "abcd"]
    owner, hashes = B._without_one(forms)
    by = [{int(h) for o, h in zip(owner, hashes) if o == k} for k in range(len(forms))]
    assert len(by[0]) == 8 and len(by[4]) == 6 and len(by[5]) == 1 and int(hashes[1]) in by[0]
    assert by[0] & {int(h) for h in B._without_one(["gratiut"])[1]} and not by[0] & by[2]


def test_five_pages_or_one_page_are_not_enough(spark):
    assert found(spark, [("m", p, NOTICE) for p in range(1, 6)] + [("n", 1, NOTICE)]) == []
    assert found(spark, [("m", 1, NOTICE)] * 9) == []
    assert len(found(spark, [("m", p, NOTICE) for p in (1, 2, 3, 4, 5, 6, 6)])) == 7


def test_own_page_number_is_masked_and_other_numbers_count(spark):
    own = [("m", p, f"Capitole alese — {p - 2}") for p in range(3, 11)]
    other = [("m", p, f"Verificați exercițiul {p * 7} din culegere") for p in range(3, 11)]
    out = found(spark, own + other)
    assert out == list(range(8))


def test_front_pages_have_roman_numbers(spark):
    pages = [("m", p, f"Capitole alese, pagina {n}") for p, n in enumerate(["i", "ii", "1", "2", "3", "4"], 1)]
    assert found(spark, pages, labels={1: "i", 2: "ii", 7: None, 8: ""}) == list(range(6))


def test_alike_lines_stay(spark):
    lines = [("m", p, f"Arătați că {w} este bine definită pe mulțimea dată") for p, w in enumerate(["derivata", "integrala", "funcția inversă", "limita superioară", "compunerea", "proiecția", "suma directă"], 1)]
    assert found(spark, lines) == []


def test_nulls_empties_and_long_lines(spark):
    lines = [("m", p, t) for p in range(1, 9) for t in (None, "", "  ", NOTICE, "lung " * 5000)] + [(None, p, NOTICE) for p in range(1, 9)]
    df, pages = manual(spark, lines)
    out = B.repeated_lines(df.union(df), pages)
    assert out.groupBy("cluster").count().count() == 2 and out.where("manual_id IS NULL").count() == 0
    assert B.without_repeated(df, out).where("manual_id = 'm' AND text IS NOT NULL AND trim(text) <> ''").count() == 0
    assert B.repeated_lines(df.limit(0), pages).count() == 0 and B.repeated_lines(df, pages.limit(0)).count() == 16


def test_min_hashes_depend_on_the_form_alone():
    a = B._min_hashes(["abcdef", "x", "abcdef"])
    b = B._min_hashes(["abcdef"])
    assert (a[:, 0] == a[:, 2]).all() and (a[:, 0] == b[:, 0]).all() and (a[:, 0] != a[:, 1]).any()
