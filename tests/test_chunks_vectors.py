from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagelode.operators import lines, quality, vectors
from pagelode.sources import index
from tests.manuals import LINE


def chunk_rows(spark, pages, toc=(), **window):
    rows = []
    for p, page in enumerate(pages, 1):
        for k, text in enumerate(page, 1):
            rows.append(("m", f"p{p:04d}", p, p - 1, "b", f"l{p}{k}", 0, k - 1, text, None, 595.0, 842.0, "GOOD", "N", None))
    t = spark.createDataFrame([("m", f"p{p:04d}", True) for p in toc] or [("x", "x", True)], "manual_id string, page_id string, is_toc boolean")
    return lines.window_chunks(spark.createDataFrame(rows, LINE), t, **window).orderBy("chunk_id").collect()


def test_windows_stay_on_their_page(spark):
    words = lambda sign, n: " ".join(f"{sign}{i}" for i in range(n))
    out = chunk_rows(spark, [[words("u", 45), words("v", 70)], [words("x", 30)]], toc=[2], words=60, overlap=15, least=12)
    assert {r["pdf_page_number"]: {w[0] for r2 in out if r2["pdf_page_number"] == r["pdf_page_number"] for w in r2["text"].split()} for r in out} == {1: {"u", "v"}, 2: {"x"}}
    assert [(r["chunk_id"], r["start_line_id"], r["end_line_id"], r["is_toc_page"]) for r in out] == [("m-p0001-c001", "l11", "l12", False), ("m-p0001-c002", "l12", "l12", False), ("m-p0001-c003", "l12", "l12", False), ("m-p0002-c001", "l21", "l21", True)]


def test_repaired_copy_keeps_the_source(spark):
    (r,) = chunk_rows(spark, [["rezistenþa Æara"]], least=1)
    assert r["text"] == "rezistenþa Æara" and r["embedding_text"] == "rezistenţa Ţara"


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(1, 160), min_size=5, max_size=5), st.integers(3, 40), st.integers(0, 39), st.integers(1, 30))
def test_windows_cover_pages_and_share_their_words(spark, sizes, words, overlap, least):
    overlap = min(overlap, words - 1)
    out = chunk_rows(spark, [[" ".join(map(str, range(n)))] for n in sizes], words=words, overlap=overlap, least=least)
    for p, n in enumerate(sizes, 1):
        spans = [(int(r["text"].split()[0]), int(r["text"].split()[-1]) + 1) for r in out if r["pdf_page_number"] == p]
        assert spans[0][0] == 0 and spans[-1][1] == n and all(e - s <= words for s, e in spans)
        assert all(s < s2 <= e <= e2 for (s, e), (s2, e2) in zip(spans, spans[1:])) or overlap == 0
        assert all(s2 - s == words - overlap for (s, _), (s2, _) in zip(spans, spans[1:-1]))  # but for the last, which may move back
        assert all(e - s == words for s, e in spans[:-1])
        assert len(spans) == 1 or spans[-1][1] - spans[-1][0] >= min(least, words)


@pytest.mark.parametrize("n, starts", [(8, [0]), (9, [0, 1]), (14, [0, 6]), (15, [0, 6, 7]), (19, [0, 6, 12])])
def test_stated_starts(spark, n, starts):
    """Windows of 8 words, 2 shared, at least 4."""
    out = chunk_rows(spark, [[" ".join(map(str, range(n)))]], words=8, overlap=2, least=4)
    assert [int(r["text"].split()[0]) for r in out] == starts


@pytest.mark.parametrize("window", [(0, 0, 1), (10, 10, 1), (10, -1, 1), (10, 2, 0)])
def test_window_parameters(window):
    with pytest.raises(ValueError):
        lines.check_window(*window)


def test_top_k_breaks_ties_by_id(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0])], "vec_id int, embedding array<float>")
    q = spark.createDataFrame([(7, [1.0, 0.0])], "query_id int, query array<float>")
    assert [(r["rank"], r["vec_id"]) for r in vectors.top_k(v, q, 2).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert vectors.top_k(v, q, 10).count() == 3
    with pytest.raises(ValueError):
        vectors.top_k(v, q, 0)


def test_queries_are_answered_in_blocks(spark):
    """5,000 queries, more than a block holds, against brute force."""
    import numpy as np

    rng = np.random.default_rng(3)
    v, q = rng.integers(-9, 10, (40, 4)).astype(float), rng.integers(-9, 10, (5000, 4)).astype(float)
    vs = spark.createDataFrame([(n, x.tolist()) for n, x in enumerate(v)], "vec_id int, embedding array<double>")
    qs = spark.createDataFrame([(n, x.tolist()) for n, x in enumerate(q)], "query_id int, query array<double>")
    out = vectors.top_k(vs, qs, 3).groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id"))).alias("r")).collect()
    best = np.argsort(-(q @ v.T), axis=1, kind="stable")[:, :3]
    assert len(out) == 5000 and all([x["vec_id"] for x in r["r"]] == best[r["query_id"]].tolist() for r in out)


def index_rows(spark, texts):
    rows = [(f"{m}-c{n}", f"p{n}", n, "l1", "l2", t, t, 2, n == 1, m) for m, n, t in texts]
    return spark.createDataFrame(rows, index.CHUNK)


def test_index_is_kept_rebuilt_and_searched(spark, tmp_path):
    path = str(tmp_path / "index")
    manuals = spark.createDataFrame([("m", "s1"), ("007", "s2"), ("empty", None)], "manual_id string, sha256 string")
    chunks = index_rows(spark, [("m", 1, "legea lui ohm"), ("m", 2, "lentile subțiri"), ("007", 1, "lentile groase"), ("other", 1, "x")])
    built = []

    def ensure(keys, source=chunks, **more):
        counted = source.where(F.col("chunk_id") != "") if source is not None else None
        built.append(1)
        return index.ensure_index(spark, path, keys, counted, vectors.hashing_encoder, **more)

    assert index.read_index(spark, path) is None
    held = ensure(index.index_keys(manuals, "h"))
    assert {r["manual_id"]: (r["chunk_count"], r["toc_page_count"], r["embedding_dimension"]) for r in held.meta.collect()} == {"m": (2, 1, 64), "007": (1, 1, 64), "empty": (0, 0, 0)}
    assert {round(sum(x * x for x in r["embedding"]), 4) for r in held.vectors.collect()} == {1.0}
    q = spark.createDataFrame([("m", 1, "legea lui ohm"), ("007", 1, "legea lui ohm"), ("empty", 1, "x")], "manual_id string, query_id int, query string")
    found = index.search(held, q, vectors.hashing_encoder, k=1).collect()
    assert {(r["manual_id"], r["chunk_id"]) for r in found} == {("m", "m-c1"), ("007", "007-c1")}
    rows = {r["manual_id"]: r for r in index.results(index.search(held, q, vectors.hashing_encoder), q, held).collect()}
    assert [x["chunk_id"] for x in rows["m"]["matches"]][0] == "m-c1" and rows["empty"]["matches"] is None and rows["m"]["index"]["model_name"] == "h"
    again = index_rows(spark, [("m", 1, "alt text"), ("007", 1, "alt text"), ("007", 2, "nou")])
    assert ensure(index.index_keys(manuals, "h"), again).chunks.where("manual_id = '007'").count() == 1  # current: kept as it is
    changed = manuals.withColumn("sha256", F.when(F.col("manual_id") == "007", "s3").otherwise(F.col("sha256")))
    held = ensure(index.index_keys(changed, "h"), again)
    assert {r["manual_id"]: r["n"] for r in held.chunks.groupBy("manual_id").agg(F.count("*").alias("n")).collect()} == {"m": 2, "007": 2}
    assert ensure(index.index_keys(changed, "h"), again, rebuild=True).chunks.where("text = 'alt text'").count() == 2
    gone = manuals.where("manual_id = '007'").withColumn("sha256", F.lit("s4"))
    assert ensure(index.index_keys(gone, "h"), again.where("manual_id = 'm'")).chunks.where("manual_id = '007'").count() == 0
    ensure(index.index_keys(changed, "h"), again)
    rest = index.read_index(spark, path).vectors.where("chunk_id <> '007-c2'")
    index._replace(spark.createDataFrame(rest.collect(), rest.schema), f"{path}/vectors")
    with pytest.raises(ValueError):
        index.checked(index.read_index(spark, path))


@pytest.mark.parametrize("changed", ["source_sha256", "model_name", "chunk_words", "overlap_words", "index_version"])
def test_every_key_field_counts(spark, changed):
    keys = index.index_keys(spark.createDataFrame([("m", "s"), ("n", None)], "manual_id string, sha256 string"), "h")
    other = keys.withColumn(changed, F.lit("2").cast(dict(keys.dtypes)[changed]))
    assert vectors.stale(keys, keys).count() == 0 and vectors.stale(other, keys).count() == 2 and vectors.stale(keys.limit(0), keys).count() == 2


def layer(spark, rows):
    return spark.createDataFrame(rows, "manual_id string, page_id string, status string, control_ratio double, replacement_ratio double")


def test_choice_of_layer(spark):
    native = layer(spark, [("m", "1", "SUSPECT", 0.1, 0.0), ("m", "2", "EMPTY", 0.0, 0.0), ("m", "3", "GOOD", 0.0, 0.0), ("n", "1", "EMPTY", 0.0, 0.0), ("m", "4", "UNUSABLE", 0.3, 0.0), ("m", "5", "SUSPECT", 0.01, 0.0)])
    other = layer(spark, [("m", "1", "SUSPECT", 0.05, 0.0), ("m", "2", "GOOD", 0.0, 0.0), ("m", "3", "GOOD", 0.0, 0.0), ("n", "1", "GOOD", 0.0, 0.0), ("m", "4", "EMPTY", 0.0, 0.0), ("m", "5", "SUSPECT", 0.01, 0.0)])
    out = {(r["manual_id"], r["page_id"]): (r["backend"][:3], r["warnings"]) for r in quality.choose_layer(native, other).collect()}
    assert out == {
        ("m", "1"): ("POP", ["text_requires_visual_validation"]), ("m", "2"): ("POP", []), ("m", "3"): ("PYM", []), ("n", "1"): ("PYM", ["no_machine_readable_text"]),
        ("m", "4"): ("POP", ["no_machine_readable_text"]), ("m", "5"): ("PYM", ["text_requires_visual_validation"]),
    }
    alone = {r["page_id"]: r["warnings"] for r in quality.choose_layer(native.where("manual_id = 'm'"), other.where("manual_id = 'm'"), "native", False).collect()}
    assert alone["4"] == ["do_not_create_semantic_units_from_this_page", "poppler_fallback_unavailable"]
    with pytest.raises(ValueError):
        quality.choose_layer(native, other, "poppler", False)
    with pytest.raises(Exception):
        quality.choose_layer(native, other.where("page_id <> '1'")).collect()
    with pytest.raises(Exception):
        quality.choose_layer(native.where("page_id <> '1'"), other).collect()


def test_page_texts_keep_empty_pages(spark):
    rows = [("m", "p1", 1, 0, "b", f"l{b}{k}", b, k, t, None, 1.0, 1.0, "GOOD", "N", None) for b, k, t in [(1, 0, "c"), (0, 1, "b"), (0, 0, "a"), (2, 0, " ")]]
    own = lines.current_lines(spark.createDataFrame(rows, LINE))
    pages = spark.createDataFrame([("m", "p1"), ("m", "p2")], "manual_id string, page_id string")
    assert {r["page_id"]: r["text"] for r in lines.page_texts(own, pages).collect()} == {"p1": "a\nb\n\nc", "p2": ""}


def test_latest_row_counts(spark):
    import datetime as dt

    d = lambda h: dt.datetime(2025, 1, 1, h)
    rows = [("m", "p", 1, 0, "b", "l", 0, 0, t, None, 1.0, 0.0, "GOOD", "N", at) for t, at in [("old", d(1)), ("new", d(2)), ("new", d(2)), (None, d(0))]]
    (r,) = lines.with_geometry(lines.current_lines(spark.createDataFrame(rows, LINE))).collect()
    assert (r["text"], r["height"], r["top_fraction"]) == ("new", 0.0, 1.0)


def test_overall_status(spark):
    p = spark.createDataFrame([("a", "GOOD"), ("a", "UNUSABLE"), ("b", "SUSPECT"), ("b", None), ("c", "EMPTY")], "manual_id string, page_quality string")
    assert {r["manual_id"]: (r["overall_status"], r["native_problem"]) for r in quality.overall_status(p).collect()} == {"a": ("FAILED", True), "b": ("USABLE_WITH_WARNINGS", True), "c": ("USABLE", False)}
    assert quality.status_counts(p.withColumn("backend", F.lit("N"))).where("dimension = 'backend'").first()["pages"] == 5
