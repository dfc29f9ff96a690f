"""Lesson titles located in manuals: candidates, decisions, boundaries and evidence regions.

Set-oriented: any number of (manual_id, query_id, title) over any number of manuals in one plan. Lines join queries by
manual; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelode.functions.similarity import sequence_ratio, title_scores
from pagelode.functions.text import line_title, match_form, section_label, section_path, stripped, without_section
from pagelode.operators.contents import immediate_peer, later_peer, matching_entry, next_entries
from pagelode.session import cut_lineage

VERSION = "1"
ORDER = ["page_index", "block_index", "line_index", "line_id"]


def prepared_lines(lines: DataFrame) -> DataFrame:
    """Lines (with geometry) with their title in match form and their section."""
    t = F.col("text")
    return lines.withColumns({"title": line_title(t), "section": section_path(t), "section_label": section_label(t)})


def prepared_queries(queries: DataFrame) -> DataFrame:
    """Queries (manual_id, query_id, title) with the title's match form as ``query``."""
    return queries.select("manual_id", "query_id", F.col("title").alias("query_title"), match_form(F.col("title")).alias("query"))


def page_medians(lines: DataFrame) -> DataFrame:
    """(manual_id, page_id, median_height): exact median of the heights above 0, else 0."""
    return lines.groupBy("manual_id", "page_id").agg(F.coalesce(F.median(F.when(F.col("height") > 0, F.col("height"))), F.lit(0.0)).alias("median_height"))


def heading_parts(median: Column) -> tuple[Column, Column]:
    """Score and reasons of a line as a heading, from section, text, top_fraction and height."""
    text = stripped(F.col("text"))
    size, top, height = F.length(text), F.col("top_fraction"), F.col("height")
    numbered = F.col("section").isNotNull()
    score = (
        F.when(numbered, 0.36).otherwise(0.0)
        + F.when(size <= 80, 0.16).when(size <= 140, 0.08).otherwise(0.0)
        + F.when(top <= 0.22, 0.14).when(top <= 0.38, 0.07).otherwise(0.0)
        + F.when((median > 0) & (height >= median * 1.15), 0.18).when((median > 0) & (height >= median * 1.05), 0.08).otherwise(0.0)
        + F.when(text.rlike("[.;,:]$"), 0.0).otherwise(0.06)
    )
    reasons = F.array_compact(
        F.array(
            F.when(numbered, "numbered_heading_candidate"),
            F.when(size <= 80, "short_line"),
            F.when(top <= 0.22, "near_page_top"),
            F.when((median > 0) & (height >= median * 1.15), "larger_than_page_body"),
        )
    )
    return F.least(F.lit(1.0), score), reasons


def heading_scores(lines: DataFrame) -> DataFrame:
    """(manual_id, line_id, heading_score) of prepared lines."""
    score, _ = heading_parts(F.coalesce(F.col("median_height"), F.lit(0.0)))
    return lines.join(page_medians(lines), ["manual_id", "page_id"], "left").select("manual_id", "line_id", F.round(score, 6).alias("heading_score"))


def candidates(lines: DataFrame, queries: DataFrame, scored: DataFrame) -> DataFrame:
    """Scored and ranked candidates of each query.

    ``lines`` are prepared, ``queries`` too, ``scored`` are the pages' contents scores. Rank: final score, title score,
    heading score, page, document order.
    """
    own = lines.join(queries, "manual_id")
    found = title_scores(own)
    found = found.join(page_medians(lines), ["manual_id", "page_id"], "left").join(scored.select("manual_id", "page_id", "is_toc"), ["manual_id", "page_id"], "left")
    found = found.withColumns({"is_toc": F.coalesce("is_toc", F.lit(False)), "median_height": F.coalesce("median_height", F.lit(0.0))})
    heading, reasons = heading_parts(F.col("median_height"))
    each = Window.partitionBy("manual_id", "query_id")
    found = found.withColumns({"heading_score": heading, "reasons": F.concat("title_reasons", reasons), "supported": F.bool_or(F.col("is_toc") & (F.col("title_score") >= 0.72)).over(each)})
    quality = F.when(F.col("page_quality") == "SUSPECT", 0.06).when(F.col("page_quality").isin("EMPTY", "UNUSABLE"), 0.40).otherwise(0.0)
    found = found.withColumns(
        {
            "toc_support": F.when(F.col("supported") & ~F.col("is_toc"), 0.07).otherwise(0.0),
            "toc_penalty": F.when(F.col("is_toc"), 0.58).otherwise(0.0),
            "quality_penalty": quality + F.when(F.contains("text", F.lit("�")), 0.10).otherwise(0.0),
        }
    )
    raw = 0.74 * F.col("title_score") + 0.26 * F.col("heading_score") + F.col("toc_support") - F.col("toc_penalty") - F.col("quality_penalty")
    found = found.withColumn("final_score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw)))
    order = each.orderBy(F.desc("final_score"), F.desc("title_score"), F.desc("heading_score"), "pdf_page_number", *ORDER)
    return found.withColumn("rank", F.row_number().over(order))


def toc_matches(found: DataFrame, most: int = 10) -> DataFrame:
    """Contents lines that match a query's title, the first ``most`` in document order."""
    order = Window.partitionBy("manual_id", "query_id").orderBy(*ORDER)
    own = found.where(F.col("is_toc") & (F.col("title_score") >= 0.72)).withColumn("n", F.row_number().over(order)).where(F.col("n") <= most)
    return own.select("manual_id", "query_id", "n", "page_id", "pdf_page_number", "line_id", "text", F.round("title_score", 4).alias("match_score"))


def deterministic_status(top: Column, margin: Column, count: Column) -> Column:
    return (
        F.when(top.isNull() | (top < 0.50), "NOT_FOUND")
        .when((top >= 0.82) & (margin >= 0.10), "FOUND_HIGH_CONFIDENCE")
        .when((top >= 0.68) & (margin < 0.08) & (count > 1), "MULTIPLE_CANDIDATES")
        .otherwise("FOUND_LOW_CONFIDENCE")
    )


def public_status(status: Column) -> Column:
    return F.when(status == "FOUND_HIGH_CONFIDENCE", status).otherwise("NEEDS_SEMANTIC_LOCALIZATION")


def decisions(found: DataFrame, queries: DataFrame) -> DataFrame:
    """One row for each query: best line, margin to the second, and status; a query without candidates has no line."""
    two = found.where("rank <= 2").groupBy("manual_id", "query_id").agg(
        F.max(F.when(F.col("rank") == 1, F.col("final_score"))).alias("top"), F.max(F.when(F.col("rank") == 2, F.col("final_score"))).alias("second"),
        F.max(F.when(F.col("rank") == 1, F.col("line_id"))).alias("line_id"),
    )
    counts = found.groupBy("manual_id", "query_id").agg(F.count("*").alias("candidates"))
    out = queries.select("manual_id", "query_id", "query").join(two, ["manual_id", "query_id"], "left").join(counts, ["manual_id", "query_id"], "left").fillna(0, ["candidates"])
    out = out.withColumn("margin", F.coalesce(F.col("top") - F.coalesce("second", F.lit(0.0)), F.lit(0.0)))
    status = deterministic_status(F.col("top"), F.col("margin"), F.col("candidates"))
    return out.withColumn("deterministic_status", status).withColumn("status", public_status(status)).drop("second")


def anchors(decided: DataFrame, lines: DataFrame) -> DataFrame:
    """The best lines of the queries found with high confidence: every further step starts from them."""
    high = decided.where("deterministic_status = 'FOUND_HIGH_CONFIDENCE'").select("manual_id", "query_id", "query", "line_id", "top")
    return high.join(lines.select("manual_id", "line_id", "page_id", "pdf_page_number", "text", "page_index", "block_index", "line_index", "height", "section", "section_label"), ["manual_id", "line_id"])


def _heading_like(anchor_height: Column) -> Column:
    letters = F.regexp_count(match_form(without_section(F.col("text"))), F.lit(r"\p{L}"))
    size = F.length(stripped(F.col("text")))
    near = (F.col("height") <= 0) | (anchor_height <= 0) | (F.col("height") >= 0.8 * anchor_height) | (F.col("top_fraction") <= 0.35)
    return (letters >= 3) & (size <= 180) & near


def _named(prefix: str, columns: list[str]) -> list[Column]:
    return [F.col(c).alias(f"{prefix}_{c}") for c in columns]


def next_peer_headings(anchored: DataFrame, lines: DataFrame) -> DataFrame:
    """(manual_id, query_id, line_id): the first later heading right after the anchor's section, else a later one of its level."""
    a = anchored.where("section IS NOT NULL").select("manual_id", "query_id", *_named("a", ["page_index", "block_index", "line_index", "height", "section"]))
    later = lines.where("section IS NOT NULL").join(a, "manual_id").where("struct(page_index, block_index, line_index) > struct(a_page_index, a_block_index, a_line_index)")
    peers = later.where(later_peer(F.col("section"), F.col("a_section"))).where(_heading_like(F.col("a_height")))
    step = F.when(immediate_peer(F.col("section"), F.col("a_section")), 1).otherwise(2)
    best = peers.groupBy("manual_id", "query_id").agg(F.min(F.struct(step.alias("step"), *ORDER)).alias("b"))
    return best.select("manual_id", "query_id", F.col("b.line_id").alias("line_id"))


def expected_boundaries(anchored: DataFrame, entries: DataFrame, lines: DataFrame, radius: int = 2) -> DataFrame:
    """(manual_id, query_id, line_id, score, expected_title, expected_printed_page): the next contents entry's heading near its page.

    ``line_id`` is null where no line near the page scores 0.68; a query without a next entry has no row.
    """
    nexts = next_entries(entries)
    e = entries.select("manual_id", "pos", "title", "normalized_title", "printed_page")
    current = matching_entry(anchored, entries).join(nexts, ["manual_id", "pos"]).where("next_pos IS NOT NULL").join(e.select("manual_id", "pos", F.col("printed_page").alias("current_page")), ["manual_id", "pos"])
    ahead = e.select("manual_id", F.col("pos").alias("next_pos"), F.col("title").alias("expected_title"), F.col("normalized_title").alias("expected"), F.col("printed_page").alias("expected_printed_page"))
    current = current.join(ahead, ["manual_id", "next_pos"]).join(anchored.select("manual_id", "query_id", F.col("pdf_page_number").alias("anchor_page")), ["manual_id", "query_id"])
    current = current.withColumn("page", F.col("expected_printed_page") + F.col("anchor_page") - F.col("current_page"))
    # The band is joined by page: each expected page stands for itself and its neighbours.
    band = current.withColumn("pdf_page_number", F.explode(F.sequence(F.col("page") - radius, F.col("page") + radius)))
    near = lines.select("manual_id", "pdf_page_number", "top_fraction", "text", *ORDER).join(band.select("manual_id", "query_id", "expected", "pdf_page_number"), ["manual_id", "pdf_page_number"])
    near = near.withColumn("own", match_form(F.col("text"))).where("own <> ''")
    bonus = F.when(F.col("top_fraction") <= 0.35, 0.08).otherwise(0.0) + F.when(F.length(stripped(F.col("text"))) <= 180, 0.04).otherwise(0.0)
    held = near.where(F.contains("own", "expected")).withColumn("score", 1.0 + bonus)
    la, lb = F.length("own"), F.length("expected")
    rest = near.where(~F.contains("own", "expected") & (2 * F.least(la, lb) / (la + lb) + bonus >= 0.68))
    rest = rest.withColumn("ratio", sequence_ratio(F.col("expected"), F.col("own"))).withColumn("score", F.col("ratio") + bonus).drop("ratio")
    # Best score first; among equals the first in document order.
    negative = [(-F.col(c)).alias(c) for c in ORDER[:3]]
    best = held.unionByName(rest).where("score >= 0.68").groupBy("manual_id", "query_id").agg(F.max_by("line_id", F.struct("score", *negative)).alias("line_id"), F.max("score").alias("score"))
    return current.select("manual_id", "query_id", "expected_title", "expected_printed_page").join(best, ["manual_id", "query_id"], "left")


def boundaries(anchored: DataFrame, entries: DataFrame, lines: DataFrame) -> DataFrame:
    """One row for each anchor: the end heading, its source, and the contents entry expected there; null columns without one."""
    expected = expected_boundaries(anchored, entries, lines).withColumnRenamed("line_id", "toc_line").drop("score")
    peers = next_peer_headings(anchored, lines).withColumnRenamed("line_id", "peer_line")
    both = anchored.select("manual_id", "query_id").join(expected, ["manual_id", "query_id"], "left").join(peers, ["manual_id", "query_id"], "left")
    source = F.when(F.col("toc_line").isNotNull(), "TOC_CONFIRMED").when(F.col("peer_line").isNotNull(), "BODY_HEADING_INFERENCE")
    return both.select("manual_id", "query_id", F.coalesce("toc_line", "peer_line").alias("line_id"), source.alias("source"), "expected_title", "expected_printed_page")


def _pages(lo: Column, hi: Column) -> Column:
    return F.when(lo <= hi, F.transform(F.sequence(lo, F.greatest(lo, hi)), lambda p: F.format_string("p%04d", p))).otherwise(F.array().cast("array<string>"))


def regions(anchored: DataFrame, bounds: DataFrame, lines: DataFrame, page_counts: DataFrame, context_pages: int = 1) -> DataFrame:
    """Evidence region of each anchor: page range, context pages and policy. ``page_counts`` has (manual_id, page_count).

    A boundary before its anchor is kept as it is and told by ``reversed``.
    """
    ends = lines.select("manual_id", F.col("line_id").alias("end_line_id"), F.col("pdf_page_number").alias("end_page_found"))
    b = bounds.withColumnRenamed("line_id", "end_line_id").join(ends, ["manual_id", "end_line_id"], "left")
    out = anchored.select("manual_id", "query_id", F.col("line_id").alias("start_line_id"), F.col("pdf_page_number").alias("start_page"))
    out = out.join(b, ["manual_id", "query_id"], "left").join(page_counts, "manual_id", "left")
    start, found, n = F.col("start_page"), F.col("end_page_found"), F.col("page_count")
    out = out.withColumn("end_page", F.coalesce(found, F.least(n, start + 4)))
    return out.select(
        "manual_id", "query_id", "start_line_id", "end_line_id", "source", "expected_title", "expected_printed_page", "start_page", "end_page",
        _pages(F.greatest(F.lit(1), start - context_pages), start - 1).alias("context_before"),
        _pages(F.greatest(F.lit(1), F.col("end_page")), F.least(n, F.col("end_page") + context_pages - 1)).alias("context_after"),
        F.when(found.isNotNull(), "exclusive_next_peer_heading").otherwise("fallback_fixed_page_window").alias("boundary_policy"),
        (F.col("end_page") < start).alias("reversed"),
    )


def locate(lines: DataFrame, queries: DataFrame, scored: DataFrame, entries: DataFrame, page_counts: DataFrame, context_pages: int = 1, max_candidates: int = 10) -> DataFrame:
    """One nested result row for each query."""
    q = prepared_queries(queries)
    found = cut_lineage(candidates(lines, q, scored))  # read five times from here
    decided = decisions(found, q)
    anchored = cut_lineage(anchors(decided, lines))
    region = regions(anchored, boundaries(anchored, entries, lines), lines, page_counts, context_pages)
    keys = ["manual_id", "query_id"]
    listed = found.where(F.col("rank") <= max_candidates).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("rank", "line_id", "pdf_page_number", "text", F.round("title_score", 4).alias("title_score"), F.round("heading_score", 4).alias("heading_score"), F.round("final_score", 4).alias("final_score"), "section_label", "reasons"))).alias("candidate_list")
    )
    matches = toc_matches(found).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("n", "page_id", "pdf_page_number", "line_id", "text", "match_score"))).alias("toc_matches"))
    pages = scored.where("score >= 0.30").groupBy("manual_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("page_id", F.round("score", 4).alias("score"))))).alias("toc_page_scores"))
    ref = anchored.select(*keys, F.struct("line_id", "page_id", "pdf_page_number", "text", F.round("top", 4).alias("score"), "section_label").alias("anchor"))
    regional = region.select(*keys, F.struct(*[c for c in region.columns if c not in keys]).alias("region"))
    titles = q.select(*keys, "query_title")
    out = decided.select(*keys, "query", "status", "deterministic_status", F.round("margin", 4).alias("score_margin"))
    out = out.join(titles, keys)
    for part in (ref, regional, matches, listed):
        out = out.join(part, keys, "left")
    return out.join(pages, "manual_id", "left")
