from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pagelode.operators import contents, lines, locate, reports
from tests.manuals import CIRCUITS, OPTICS, QUERY, SCRAP, WIRES, lines_of, pages_of

MANUALS = {"a": CIRCUITS, "b": OPTICS, "c": WIRES, "d": SCRAP}
TITLES = {"a": QUERY, "b": "Curentul alternativ", "c": QUERY, "d": QUERY}


@pytest.fixture(scope="module")
def located(spark):
    own = locate.prepared_lines(lines.with_geometry(lines.current_lines(lines_of(spark, **MANUALS)))).cache()
    scored = contents.toc_pages(own, pages_of(spark, **MANUALS)).cache()
    queries = spark.createDataFrame([(m, 1, t) for m, t in TITLES.items()], "manual_id string, query_id int, title string")
    counts = spark.createDataFrame([(m, len(p)) for m, p in MANUALS.items()], "manual_id string, page_count int")
    q = locate.prepared_queries(queries)
    found = locate.candidates(own, q, scored)
    results = locate.locate(own, queries, scored, contents.toc_entries(own, scored), counts).cache()
    return {r["manual_id"]: r for r in results.collect()}, {(r["manual_id"], r["text"]): r for r in found.collect()}, results, {(r["manual_id"], r["page_id"]): r for r in scored.collect()}


@pytest.mark.parametrize(
    "manual, text, title, heading, final",
    [
        ("a", "2.2. Rezistența conductorului", 1.0, 0.90, 1.0), ("a", "2.2. Rezistența conductorului ..... 3", 1.0, 0.72, 0.3472),
        ("c", "6 Rezistența conductorului și firele lungi", 0.9, 0.90, 0.9), ("c", "Aflăm despre rezistența conductorului.", 0.9122, 0.16, 0.7166),
    ],
)
def test_scores(located, manual, text, title, heading, final):
    row = located[1][manual, text]
    assert (row["title_score"], row["heading_score"], row["final_score"]) == pytest.approx((title, heading, final), abs=1e-4)


def test_title_scores_follow_token_overlap_and_matching_blocks(located):
    from difflib import SequenceMatcher

    row = located[1]["d", "rezistența conductor"]
    ratio = SequenceMatcher(None, "rezistenta conductorului", "rezistenta conductor").ratio()
    assert row["title_score"] == pytest.approx(0.55 / 3 + 0.45 * ratio)


def test_contents_and_body(located):
    r = located[0]["a"]
    assert (r["status"], r["deterministic_status"], r["score_margin"]) == ("FOUND_HIGH_CONFIDENCE", "FOUND_HIGH_CONFIDENCE", pytest.approx(0.6528, abs=1e-4))
    assert (r["anchor"]["page_id"], r["region"]["start_page"], r["region"]["end_page"]) == ("p0003", 3, 4)
    assert (r["region"]["source"], r["region"]["expected_printed_page"], r["region"]["end_line_id"]) == ("TOC_CONFIRMED", 4, "p0004-b0001-l001")
    assert (r["region"]["context_before"], r["region"]["context_after"]) == (["p0002"], ["p0004"])
    assert located[3]["a", "p0001"]["score"] == 1.0 and r["toc_page_scores"] == {"p0001": 1.0}
    assert r["toc_matches"][0]["line_id"] == "p0001-b0001-l003"


def test_title_that_no_line_has(located):
    r = located[0]["b"]
    assert (r["status"], r["deterministic_status"], r["anchor"], r["region"], r["candidate_list"]) == ("NEEDS_SEMANTIC_LOCALIZATION", "NOT_FOUND", None, None, None)


def test_stray_number_is_no_heading(located):
    r = located[0]["c"]
    assert (r["anchor"]["page_id"], r["region"]["source"], r["region"]["end_line_id"], r["score_margin"]) == ("p0001", "BODY_HEADING_INFERENCE", "p0003-b0001-l001", pytest.approx(0.1834, abs=1e-4))
    assert (r["region"]["start_page"], r["region"]["end_page"], r["region"]["context_before"], r["region"]["context_after"]) == (1, 3, [], ["p0003"])


def test_doubtful_title_has_no_region(located):
    r = located[0]["d"]
    assert (r["status"], r["deterministic_status"], r["region"]) == ("NEEDS_SEMANTIC_LOCALIZATION", "FOUND_LOW_CONFIDENCE", None)


def test_report(located):
    text = {r["manual_id"]: r["report"] for r in reports.location_report(located[2]).collect()}
    assert "Region: pages 3-4" in text["a"] and "Region: none" in text["b"]


def test_status_table(spark):
    cases = [(None, 0.0, 0, "NOT_FOUND"), (0.49, 0.4, 2, "NOT_FOUND"), (0.82, 0.10, 2, "FOUND_HIGH_CONFIDENCE"), (0.82, 0.09, 2, "FOUND_LOW_CONFIDENCE"), (0.82, 0.07, 2, "MULTIPLE_CANDIDATES"), (0.7, 0.07, 1, "FOUND_LOW_CONFIDENCE"), (0.5, 0.0, 3, "FOUND_LOW_CONFIDENCE")]
    df = spark.createDataFrame(cases, "top double, margin double, n int, expected string")
    assert df.where(locate.deterministic_status(F.col("top"), F.col("margin"), F.col("n")) != F.col("expected")).count() == 0


def test_next_entry_respects_position(spark):
    rows = [([3], 8), ([3, 1], 8), ([3, 1, 1], 9), ([3, 2], 12), ([4], 20), ([2], 31), ([2, 5], 33)]
    e = spark.createDataFrame([("m", n, s, p) for n, (s, p) in enumerate(rows)], "manual_id string, pos int, section array<bigint>, printed_page int")
    expected = {n: next((k for k in range(n + 1, len(rows)) if len(rows[k][0]) <= len(s)), None) for n, (s, _) in enumerate(rows)}
    assert {r["pos"]: r["next_pos"] for r in contents.next_entries(e).collect()} == expected


def test_matching_entry(spark):
    e = spark.createDataFrame([("m", 1, [5], "unde", 1), ("m", 2, [5], "sunetul", 9), ("m", 3, [6], "ecoul", 12)], "manual_id string, pos int, section array<bigint>, normalized_title string, printed_page int")
    a = spark.createDataFrame([("m", 1, "sunetul si auzul", [5]), ("m", 2, "nimic", [5]), ("m", 3, "nimic", [6]), ("m", 4, "unde", None)], "manual_id string, query_id int, query string, section array<bigint>")
    assert {r["query_id"]: r["pos"] for r in contents.matching_entry(a, e).collect()} == {1: 2, 3: 3}


def test_section_predicates(spark):
    df = spark.createDataFrame([([1, 2], [1, 1]), ([1, 4], [1, 1]), ([2], [1]), ([1, 1, 1], [1, 1]), ([2, 2], [1, 1]), ([1], [1])], "a array<bigint>, b array<bigint>")
    out = df.select(contents.immediate_peer(F.col("a"), F.col("b")), contents.later_peer(F.col("a"), F.col("b")), contents.descendant(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in out] == [(True, True, False), (False, True, False), (True, True, False), (False, False, True), (False, False, False), (False, False, False)]


def test_context_without_pages_and_fallback_window(spark):
    own = locate.prepared_lines(lines.with_geometry(lines_of(spark, e=[[("3.4. Rezistența conductorului", 66, 21)]] + [[("Paragraf.", 104, 11)]] * 6)))
    q = spark.createDataFrame([("e", 1, QUERY)], "manual_id string, query_id int, title string")
    scored = contents.toc_pages(own, own.select("manual_id", "page_id").distinct())
    counts = spark.createDataFrame([("e", 7)], "manual_id string, page_count int")
    r = locate.locate(own, q, scored, contents.toc_entries(own, scored), counts, context_pages=0).first()["region"]
    assert (r["start_page"], r["end_page"], r["boundary_policy"], r["context_before"], r["context_after"]) == (1, 5, "fallback_fixed_page_window", [], [])
