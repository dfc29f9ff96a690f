"""The central table of lines: current rows, geometry, page texts, and chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelode.functions.text import SPACE, search_repair


def current_lines(records: DataFrame) -> DataFrame:
    """The latest row of each (manual_id, line_id); lines without visible text are left out."""
    latest = Window.partitionBy("manual_id", "line_id").orderBy(F.desc("ingested_at"), F.col("text").asc_nulls_last())
    kept = records.withColumn("_n", F.row_number().over(latest)).where("_n = 1").drop("_n")
    return kept.where(F.regexp_replace("text", SPACE, "") != "")


def with_geometry(lines: DataFrame) -> DataFrame:
    """Adds y0, y1, height and top_fraction; a missing box has height 0, a page without height top_fraction 1."""
    y0, y1 = F.coalesce(F.get("bbox", 1), F.lit(0.0)), F.coalesce(F.get("bbox", 3), F.lit(0.0))
    out = lines.withColumns({"y0": y0, "y1": y1})
    return out.withColumns({"height": F.greatest(F.lit(0.0), F.col("y1") - F.col("y0")), "top_fraction": F.when(F.col("page_height") <= 0, 1.0).otherwise(F.col("y0") / F.col("page_height"))})


def source_ref(lines: DataFrame, *more: str) -> DataFrame:
    """What a line is cited by, and further columns."""
    return lines.select("manual_id", "page_id", "pdf_page_number", "block_id", "line_id", "text", *more)


def page_texts(lines: DataFrame, pages: DataFrame) -> DataFrame:
    """(manual_id, page_id, text): lines of a block joined by newlines, blocks by blank lines; pages without lines have an empty text.

    What is gathered for a page is bounded by the page.
    """
    blocks = lines.groupBy("manual_id", "page_id", "block_index").agg(F.sort_array(F.collect_list(F.struct("line_index", "text"))).alias("l"))
    blocks = blocks.select("manual_id", "page_id", "block_index", F.array_join("l.text", "\n").alias("text"))
    joined = blocks.groupBy("manual_id", "page_id").agg(F.sort_array(F.collect_list(F.struct("block_index", "text"))).alias("b"))
    joined = joined.select("manual_id", "page_id", F.array_join("b.text", "\n\n").alias("text"))
    return pages.select("manual_id", "page_id").distinct().join(joined, ["manual_id", "page_id"], "left").withColumn("text", F.coalesce("text", F.lit("")))


def check_window(words: int, overlap: int, least: int) -> None:
    """Parameters of the windows, or ValueError."""
    if words <= 0 or least <= 0:
        raise ValueError("words and least must be positive")
    if not 0 <= overlap < words:
        raise ValueError("overlap must be at least 0 and below words")


def window_chunks(lines: DataFrame, toc_pages: DataFrame, words: int = 220, overlap: int = 60, least: int = 30) -> DataFrame:
    """Windows of ``words`` words over each page's lines, with their first and last line and a repaired copy.

    All windows follow from a page's number of words N: there are K + 1 = max(0, ceil((N - W) / (W - O))) + 1, and
    a last one shorter than ``least`` moves back to hold W words. ``toc_pages`` has (manual_id, page_id, is_toc).
    """
    check_window(words, overlap, least)
    step = words - overlap
    tokens = F.filter(F.split("text", f"{SPACE}+"), lambda w: w != "")
    page = lines.select("manual_id", "page_id", "pdf_page_number", "block_index", "line_index", F.transform(tokens, lambda w: F.struct(w.alias("w"), F.col("line_id").alias("l"))).alias("t"))
    page = page.groupBy("manual_id", "page_id").agg(F.min("pdf_page_number").alias("pdf_page_number"), F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("block_index", "line_index", "t"))), lambda x: x["t"])).alias("t"))
    page = page.withColumn("n", F.size("t")).where("n > 0")
    last = F.greatest(F.lit(0), F.ceil((F.col("n") - words) / step)).cast("int")
    cut = page.select("*", last.alias("last"), F.explode(F.sequence(F.lit(0), last)).alias("k"))
    start = F.when((F.col("k") == F.col("last")) & (F.col("k") > 0) & (F.col("n") - F.col("k") * step < least), F.greatest(F.lit(0), F.col("n") - words)).otherwise(F.col("k") * step)
    cut = cut.withColumn("s", F.slice("t", start + 1, F.lit(words)))
    out = cut.join(toc_pages.select("manual_id", "page_id", "is_toc"), ["manual_id", "page_id"], "left")
    text = F.array_join("s.w", " ")
    return out.select(
        F.format_string("%s-%s-c%03d", "manual_id", "page_id", F.col("k") + 1).alias("chunk_id"), "manual_id", "page_id", "pdf_page_number",
        F.element_at("s.l", 1).alias("start_line_id"), F.element_at("s.l", -1).alias("end_line_id"), text.alias("text"),
        search_repair(text).alias("embedding_text"), F.size("s").alias("word_count"), F.coalesce("is_toc", F.lit(False)).alias("is_toc_page"),
    )
