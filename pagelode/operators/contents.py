"""Tables of contents: pages that hold one, their entries, and steps from entry to entry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelode.functions.text import contents_page, contents_title, has_leader, is_numbered, match_form, section_path, stripped

MEMBER = 0.55
SHOWN = 0.30


def toc_pages(lines: DataFrame, pages: DataFrame) -> DataFrame:
    """Features and score of every page: (manual_id, page_id, dots, numbered, lines, score, is_toc); pages without lines score 0."""
    text = F.col("text")
    # Only a line whose first letter folds to c can say that the contents follow: the others never reach the normal form.
    titled = match_form(F.when(text.rlike(r"^[^\p{L}\p{N}_]*[cCçÇĆ-čḈḉ]"), text))
    size = F.length(stripped(text))
    flat = lines.select("manual_id", "page_id", has_leader(text).alias("dot"), is_numbered(text).alias("num"), size.between(3, 120).alias("short"), titled.alias("title"))
    found = flat.groupBy("manual_id", "page_id").agg(
        F.bool_or((F.col("title") == "cuprins") | F.col("title").startswith("cuprins ")).alias("named"),
        F.count_if("dot").alias("dots"),
        F.count_if("num").alias("numbered"),
        F.count_if("short").alias("short"),
        F.count("*").alias("lines"),
    )
    score = (
        F.when(F.col("named"), 0.65).otherwise(0.0)
        + F.least(F.lit(0.25), F.col("dots") * 0.04)
        + F.least(F.lit(0.25), F.col("numbered") * 0.025)
        + F.when((F.col("short") / F.col("lines") > 0.75) & (F.col("lines") >= 8), 0.10).otherwise(0.0)
    )
    scored = pages.select("manual_id", "page_id").distinct().join(found, ["manual_id", "page_id"], "left")
    known = F.when(F.col("lines").isNotNull(), F.round(F.least(F.lit(1.0), score), 6)).otherwise(0.0)  # least() would pass over nulls
    filled = scored.withColumn("score", known).fillna(0, ["dots", "numbered", "lines"])
    return filled.select("manual_id", "page_id", "dots", "numbered", "lines", "score", (F.col("score") >= MEMBER).alias("is_toc"))


def toc_entries(lines: DataFrame, scored: DataFrame) -> DataFrame:
    """Entries of the contents pages in document order: (manual_id, pos, page_id, line_id, section, title, normalized_title, printed_page)."""
    own = lines.join(scored.where("is_toc").select("manual_id", "page_id"), ["manual_id", "page_id"], "leftsemi")
    text = F.col("text")
    parsed = own.select(
        "manual_id", "page_id", "pdf_page_number", "line_id", "page_index", "block_index", "line_index", F.coalesce(F.get("bbox", 1), F.lit(0.0)).alias("y0"),
        stripped(text).alias("raw_text"), section_path(stripped(text)).alias("section"), contents_title(text).alias("title"), contents_page(text).alias("printed_page"),
    )
    kept = parsed.where(F.col("section").isNotNull() & F.col("printed_page").isNotNull() & (F.col("title") != ""))
    order = Window.partitionBy("manual_id").orderBy("page_index", "y0", "block_index", "line_index", "line_id")
    return kept.withColumn("pos", F.row_number().over(order)).withColumn("normalized_title", match_form(F.col("title"))).select(
        "manual_id", "pos", "page_id", "pdf_page_number", "line_id", "raw_text", "section", "title", "normalized_title", "printed_page"
    )


def next_entries(entries: DataFrame) -> DataFrame:
    """(manual_id, pos, next_pos): the first later entry that is no deeper than the entry; null without one.

    Depths are small, so the entry is the nearest over the depths up to its own, each a forward window.
    """
    depth = F.size("section")
    after = Window.partitionBy("manual_id").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, -1)  # from the end: one running pass
    nearest = [F.min(F.when(depth <= d, F.col("pos"))).over(after) for d in range(1, 6)]
    return entries.select("manual_id", "pos", F.element_at(F.array(*nearest), F.least(depth, F.lit(5))).alias("next_pos"))


def matching_entry(anchors: DataFrame, entries: DataFrame) -> DataFrame:
    """Of anchors (manual_id, query_id, query, section): the entry with the anchor's section whose title fits.

    Among entries with an equal section, the first whose title holds the query's or is held by it; else the only one.
    """
    e = entries.select("manual_id", "section", "pos", "normalized_title", "printed_page")
    both = anchors.select("manual_id", "query_id", "query", "section").where(F.col("section").isNotNull()).join(e, ["manual_id", "section"])
    fits = F.contains("normalized_title", "query") | F.contains("query", "normalized_title")
    grouped = both.groupBy("manual_id", "query_id").agg(F.min(F.when(fits, F.col("pos"))).alias("fit"), F.min("pos").alias("only"), F.count("*").alias("n"))
    return grouped.select("manual_id", "query_id", F.coalesce("fit", F.when(F.col("n") == 1, F.col("only"))).alias("pos")).where("pos IS NOT NULL")


def immediate_peer(a: Column, b: Column) -> Column:
    """Whether section ``a`` is the one right after ``b``: equal but for a last part that is one more."""
    return same_level(a, b) & (F.element_at(a, -1) == F.element_at(b, -1) + 1)


def same_level(a: Column, b: Column) -> Column:
    return (F.size(a) == F.size(b)) & (F.slice(a, F.lit(1), F.size(a) - 1) == F.slice(b, F.lit(1), F.size(b) - 1))


def later_peer(a: Column, b: Column) -> Column:
    """Whether section ``a`` is of the same level as ``b`` and later."""
    return same_level(a, b) & (F.element_at(a, -1) > F.element_at(b, -1))


def descendant(a: Column, b: Column) -> Column:
    return (F.size(a) > F.size(b)) & (F.slice(a, F.lit(1), F.size(b)) == b)
