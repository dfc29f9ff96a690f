"""Queries pN_... of this package, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.llm import boilerplate, confusables, contamination, langid, mojibake, packing, quality, splitting
from pagelode.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def p7_matches(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold passages of evaluation items, exact or retouched."""
    return contamination.contaminated(read_table(spark, folder, "documents"), read_table(spark, folder, "eval_items"))


@query
def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return p7_matches(spark, folder).where(F.col("run_words") >= contamination.WINDOW).select("doc_id", "item_id")


@query
def p1_text_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Figures of every document, from its text."""
    return quality.text_figures(read_table(spark, folder, "documents"))


@query
def p1_outliers(spark: SparkSession, folder: str) -> DataFrame:
    """Outlier scores of every document with text."""
    out = quality.ranked_documents(read_table(spark, folder, "documents"))
    return out.select("doc_id", "language", *quality.STATISTICS, F.round("score", 6).alias("score"), "kind")


@query
def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return quality.document_forms(read_table(spark, folder, "documents")).where(F.col("kind").isNotNull()).select("doc_id", "kind")


@query
def p8_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Language segments of every document, with confidence."""
    return langid.document_languages(read_table(spark, folder, "documents")).withColumn("confidence", F.round("confidence", 6))


@query
def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return langid.mislabelled(langid.document_languages(read_table(spark, folder, "documents"), doubtful_only=True))


def _records(spark: SparkSession, folder: str, *parts: tuple[str, str, str]) -> tuple[DataFrame, dict[str, int]]:
    """Texts of the named (table, id, text) columns, and their lexicon."""
    read = [read_table(spark, folder, t).select(F.lit(t).alias("source_table"), "manual_id", F.col(i).alias("record_id"), F.col(c).alias("text")) for t, i, c in parts]
    return reduce(DataFrame.unionAll, read), mojibake.lexicon([r.select("text") for r in read])


FOUND = ["source_table", "manual_id", "record_id"]


@query
def p4_consistent(spark: SparkSession, folder: str) -> DataFrame:
    """Lines and titles that aren't in their consistent form, with that form."""
    records, words = _records(spark, folder, ("line_records", "line_id", "text"), ("toc_entries", "line_id", "normalized_title"))
    return confusables.consistent(records, FOUND, "text", words).distinct()


@query
def p4_classes(spark: SparkSession, folder: str) -> DataFrame:
    """Line texts that look the same but have several forms."""
    return confusables.classes(read_table(spark, folder, "line_records"), "text")


@query
def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return p4_consistent(spark, folder).where(~F.col("misread")).select(*FOUND).distinct()


@query
def p5_decoded(spark: SparkSession, folder: str) -> DataFrame:
    """Lines and chunks that were read in a wrong encoding, restored."""
    records, words = _records(spark, folder, ("line_records", "line_id", "text"), ("retrieval_chunks", "chunk_id", "embedding_text"))
    return mojibake.decoded(records, words, FOUND, "text").distinct()


@query
def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return p5_decoded(spark, folder).select(*FOUND).distinct()


@query
def p3_repeated(spark: SparkSession, folder: str) -> DataFrame:
    """Lines that come back on many pages of their manual."""
    return boilerplate.repeated_lines(read_table(spark, folder, "line_records"), read_table(spark, folder, "manual_pages"))


@query
def p3_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Lines left on each page without the repeated ones."""
    lines = read_table(spark, folder, "line_records").select("manual_id", "page_id", "line_id", "text").distinct()
    return boilerplate.without_repeated(lines, p3_repeated(spark, folder))


@query
def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return p3_repeated(spark, folder).select("manual_id", "line_id").distinct()


@query
def p2_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of every oversized chunk, with their lines."""
    return splitting.split_chunks(read_table(spark, folder, "retrieval_chunks"), read_table(spark, folder, "line_records"))


@query
def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.split_chunks(read_table(spark, folder, "retrieval_chunks")).where(F.col("piece") == 1).select("chunk_id").distinct()


@query
def p2_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """Of every oversized chunk: its words as its pieces hold them, and whether all pieces keep the limits and share 60 words."""
    return splitting.coverage(splitting.split_chunks(read_table(spark, folder, "retrieval_chunks")))


@query
def p6_packed(spark: SparkSession, folder: str) -> DataFrame:
    """The container of every document, or of each of its pieces."""
    return packing.packed(read_table(spark, folder, "documents"))


_SPACES = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_WORDS = f"list_filter(regexp_split_to_array(text, '{_SPACES}'), lambda w: w <> '')"
_OVERSIZED = f"length(text) > 2400 OR len({_WORDS}) > 220"
ORACLES["p2_found"] = f"SELECT DISTINCT chunk_id FROM retrieval_chunks WHERE {_OVERSIZED}"
ORACLES["p2_coverage"] = f"""
    SELECT DISTINCT chunk_id, md5(array_to_string({_WORDS}, ' ')) AS words_md5, true AS within_limits, 60 AS least_shared
    FROM retrieval_chunks WHERE ({_OVERSIZED}) AND len(list_filter({_WORDS}, lambda w: length(w) > 30)) = 0
"""
