"""Readable reports as text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelode.functions.text import snippet


def _lines(*parts: Column | str) -> Column:
    return F.concat_ws("\n", *[F.lit(p) if isinstance(p, str) else p for p in parts])


def extraction_report(manuals: DataFrame, counts: DataFrame) -> DataFrame:
    """(manual_id, report): ``counts`` has (manual_id, dimension, value, pages)."""
    shown = counts.groupBy("manual_id", "dimension").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("value", "pages"))), lambda x: F.format_string("  %s: %d page(s)", F.coalesce(x["value"], F.lit("?")), x["pages"])), "\n").alias("t"))
    wide = shown.groupBy("manual_id").agg(F.max(F.when(F.col("dimension") == "backend", F.col("t"))).alias("backends"), F.max(F.when(F.col("dimension") == "status", F.col("t"))).alias("statuses"))
    text = _lines(
        F.format_string("Extraction of %s", "filename"), F.format_string("Manual: %s", "manual_id"), F.format_string("Pages: %s", F.coalesce(F.col("page_count").cast("string"), F.lit("?"))),
        F.format_string("SHA-256: %s", "sha256"), F.format_string("Status: %s", F.coalesce("overall_status", F.lit("?"))), "Text layers:", F.coalesce("backends", F.lit("  none")), "Page quality:", F.coalesce("statuses", F.lit("  none")),
    )
    return manuals.join(wide, "manual_id", "left").select("manual_id", text.alias("report"))


def location_report(results: DataFrame) -> DataFrame:
    """(manual_id, query_id, report) of location results; at most five contents matches and candidates are shown."""
    score = lambda c: F.format_string("%.4f", c)
    matches = F.array_join(F.transform(F.slice("toc_matches", 1, 5), lambda m: F.format_string("  p.%d %s (%s)", m["pdf_page_number"], m["text"], score(m["match_score"]))), "\n")
    found = F.array_join(F.transform(F.slice("candidate_list", 1, 5), lambda c: F.format_string("  %d. p.%d %s [%s]", c["rank"], c["pdf_page_number"], c["text"], score(c["final_score"]))), "\n")
    region = F.when(
        F.col("region").isNotNull(),
        _lines(
            F.format_string("Region: pages %d-%d", "region.start_page", "region.end_page"), F.format_string("Starts at: %s", "region.start_line_id"),
            F.concat(F.lit("Ends: "), F.coalesce(F.concat(F.lit("before "), F.col("region.end_line_id")), F.lit("after a fixed number of pages"))),
            F.concat(F.lit("Context: "), F.coalesce(F.nullif(F.concat_ws(", ", "region.context_before", "region.context_after"), F.lit("")), F.lit("none"))),
        ),
    ).otherwise("Region: none, the evidence is not decisive")
    text = _lines(
        F.format_string("Location in %s", "manual_id"), F.format_string("Title: %s", "query_title"), F.format_string("Status: %s (%s)", "status", "deterministic_status"),
        F.when(F.col("anchor").isNotNull(), F.format_string("Anchor: p.%d %s (%s)", "anchor.pdf_page_number", "anchor.text", score(F.col("anchor.score")))), region,
        F.when(F.size("toc_matches") > 0, F.concat(F.lit("Contents:\n"), matches)), "Candidates:", found,
    )
    return results.select("manual_id", "query_id", text.alias("report"))


def search_report(matches: DataFrame) -> DataFrame:
    """(manual_id, query_id, report) of search matches (manual_id, query_id, rank, score, chunk columns)."""
    row = F.format_string("  %d. %.6f p.%d%s %s [%s - %s] %s", "rank", "score", "pdf_page_number", F.when(F.col("is_toc_page"), " [TOC]").otherwise(""), "chunk_id", "start_line_id", "end_line_id", snippet(F.col("text")))
    return matches.withColumn("row", row).groupBy("manual_id", "query_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "row"))), lambda x: x["row"]), "\n").alias("report"))
