"""Command lines: ``python -m pagelode.cli extract | locate | search``; every one takes whole folders of manuals."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.operators import contents, lines, locate, reports, vectors
from pagelode.session import build_session, cut_lineage
from pagelode.sources import canonical, extraction, index, sinks


def _lines(spark: SparkSession, pages: str) -> tuple[DataFrame, DataFrame]:
    """Flat lines and the pages of a folder of canonical pages."""
    read = canonical.read_pages(spark, pages)
    listed = read.select("manual_id", F.col("id").alias("page_id"), "pdf_page_number", "source_sha256")
    return lines.with_geometry(canonical.flatten(read)), listed


def _asked(manuals: DataFrame, title: str) -> DataFrame:
    return manuals.select("manual_id", F.lit(1).alias("query_id"), F.lit(title).alias("title"))


def locate_titles(spark: SparkSession, pages: str, title: str, out: str, max_candidates: int = 10, context_pages: int = 1) -> DataFrame:
    """A title located in every manual of a folder of pages; results as JSON and text files in ``out``."""
    own, listed = _lines(spark, pages)
    prepared = cut_lineage(locate.prepared_lines(own))
    scored = cut_lineage(contents.toc_pages(prepared, listed))
    counts = listed.groupBy("manual_id").agg(F.max("pdf_page_number").alias("page_count"))
    found = cut_lineage(locate.locate(prepared, _asked(counts, title), scored, contents.toc_entries(prepared, scored), counts, context_pages, max_candidates).withColumn("locator_version", F.lit(locate.VERSION)))
    sinks.write_documents(found.select("manual_id", F.to_json(F.struct(*found.columns)).alias("document")), f"{out}/results")
    sinks.write_documents(reports.location_report(found).select("manual_id", F.col("report").alias("document")), f"{out}/reports", "txt")
    return found


def search_manuals(spark: SparkSession, pages: str, text: str, out: str, top: int = 15, chunk_words: int = 220, overlap_words: int = 60, batch: int = 32, rebuild: bool = False, factory: index.Factory = vectors.hashing_encoder, model: str = "hashing") -> DataFrame:
    """Every manual of a folder of pages indexed in ``out`` (where its key has changed) and searched; results as JSON and text files."""
    if top <= 0 or batch <= 0:
        raise ValueError("top and batch must be positive")
    own, listed = _lines(spark, pages)
    manuals = listed.groupBy("manual_id").agg(F.max("source_sha256").alias("sha256"))
    chunks = lines.window_chunks(own, contents.toc_pages(own, listed), chunk_words, overlap_words)
    held = index.ensure_index(spark, f"{out}/index", index.index_keys(manuals, model, chunk_words, overlap_words), chunks, factory, batch, rebuild)
    asked = _asked(manuals, text).withColumnRenamed("title", "query")
    found = cut_lineage(index.search(held, asked, factory, top, batch))
    made = index.results(found, asked, held)
    sinks.write_documents(made.select("manual_id", F.to_json(F.struct(*made.columns)).alias("document")), f"{out}/results")
    sinks.write_documents(reports.search_report(found).select("manual_id", F.col("report").alias("document")), f"{out}/reports", "txt")
    return made


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="pagelode")
    top.add_argument("--master", default="local[*]")
    commands = top.add_subparsers(dest="command", required=True)
    one = commands.add_parser("extract", help="PDF files to canonical pages, assets, manifests and reports")
    one.add_argument("path")
    one.add_argument("out")
    one.add_argument("--policy", choices=("auto", "native", "poppler"), default="auto")
    one.add_argument("--tool", help="path of pdftotext")
    one = commands.add_parser("locate", help="a lesson title in every manual")
    one.add_argument("pages")
    one.add_argument("title")
    one.add_argument("out")
    one.add_argument("--max-candidates", type=int, default=10)
    one.add_argument("--context-pages", type=int, default=1)
    one = commands.add_parser("search", help="the chunks of every manual that are nearest to a text")
    one.add_argument("pages")
    one.add_argument("text")
    one.add_argument("out")
    one.add_argument("--top", type=int, default=15)
    one.add_argument("--chunk-words", type=int, default=220)
    one.add_argument("--overlap-words", type=int, default=60)
    one.add_argument("--batch", type=int, default=32)
    one.add_argument("--rebuild", action="store_true")
    return top


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(arguments)
    spark = spark or build_session(a.master)
    if a.command == "extract":
        shown = extraction.report(extraction.extract(spark, a.path, a.out, a.policy, a.tool))
    elif a.command == "locate":
        shown = reports.location_report(locate_titles(spark, a.pages, a.title, a.out, a.max_candidates, a.context_pages))
    else:
        search_manuals(spark, a.pages, a.text, a.out, a.top, a.chunk_words, a.overlap_words, a.batch, a.rebuild)
        shown = spark.read.text(f"{a.out}/reports", wholetext=True).withColumnRenamed("value", "report")
    for row in shown.select("report").toLocalIterator():
        print(row[0])


if __name__ == "__main__":
    main()
