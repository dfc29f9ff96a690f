"""Word-box XHTML of a text layer: pages, blocks, lines and words with their boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelode.functions.text import count_controls, escape_controls, restore_word, unresolved_codes

_BOX = "_xMin double, _yMin double, _xMax double, _yMax double"
_WORD = f"struct<_VALUE:string, {_BOX.replace(' double', ':double')}>"
_LINE = f"struct<word:array<{_WORD}>, {_BOX.replace(' double', ':double')}>"
_BLOCK = f"struct<line:array<{_LINE}>, {_BOX.replace(' double', ':double')}>"
PAGE = f"struct<flow:array<struct<block:array<{_BLOCK}>>>, _width:double, _height:double>"


def parse(documents: DataFrame, column: str = "xhtml") -> DataFrame:
    """Words of documents (manual_id, xhtml): one row for each word, with block, line and word positions and codes of lost glyphs.

    Control characters that XML forbids are escaped before parsing and come out as U+FFFD with their code; other columns
    are ignored. Pages are counted from 1 in document order.
    """
    pages = documents.select("manual_id", F.posexplode(F.regexp_extract_all(escape_controls(F.col(column)), F.lit(r"(?s)<page\b.*?</page>"), 0)).alias("page_index", "x"))
    parsed = pages.select("manual_id", "page_index", F.from_xml("x", PAGE.removeprefix("struct<").removesuffix(">").replace("flow:", "flow ").replace("_width:", "_width ").replace("_height:", "_height ")).alias("p"))
    blocks = parsed.select("manual_id", "page_index", F.posexplode(F.flatten("p.flow.block")).alias("block_index", "b"))
    lines = blocks.select("manual_id", "page_index", "block_index", F.posexplode("b.line").alias("line_index", "l"))
    words = lines.select("manual_id", "page_index", "block_index", "line_index", F.posexplode("l.word").alias("word_index", "w"))
    box = F.array(*[F.round(F.col(f"w.{k}"), 3) for k in ("_xMin", "_yMin", "_xMax", "_yMax")])
    text = F.coalesce("w._VALUE", F.lit(""))
    lost = unresolved_codes(text)
    return words.select(
        "manual_id", "page_index", "block_index", "line_index", "word_index", restore_word(text).alias("text"), box.alias("bbox"), lost.alias("unresolved_source_codes"),
        F.when(F.size(lost) > 0, "REQUIRES_VISUAL_CHECK").otherwise("HIGH").alias("extraction_confidence"),
    )


def diagnostics(documents: DataFrame, column: str = "xhtml") -> DataFrame:
    """(manual_id, illegal_controls): control characters that the source holds."""
    return documents.groupBy("manual_id").agg(F.sum(count_controls(F.col(column))).alias("illegal_controls"))


def page_texts(words: DataFrame) -> DataFrame:
    """(manual_id, page_index, text): words joined by blanks, lines by newlines, blocks by blank lines."""
    by = ["manual_id", "page_index", "block_index"]
    lines = words.groupBy(*by, "line_index").agg(F.sort_array(F.collect_list(F.struct("word_index", "text"))).alias("w")).withColumn("t", F.array_join("w.text", " "))
    blocks = lines.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("line_index", "t"))).alias("l")).withColumn("t", F.array_join("l.t", "\n"))
    return blocks.groupBy("manual_id", "page_index").agg(F.sort_array(F.collect_list(F.struct("block_index", "t"))).alias("b")).select("manual_id", "page_index", F.array_join("b.t", "\n\n").alias("text"))
