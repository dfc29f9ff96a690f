"""Vector indexes of manuals: built, kept, checked, read back and searched.

One index holds any number of manuals: chunks, vectors and a description, each in one folder for each manual. A manual is built
again where its stored key (source hash, model, window, version) differs from the wanted one; the description is written last,
so that a build that was cut off is repeated.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.functions.text import search_repair
from pagelode.operators import vectors as V
from pagelode.session import cut_lineage

VERSION = "1"
CHUNK = "chunk_id string, page_id string, pdf_page_number int, start_line_id string, end_line_id string, text string, embedding_text string, word_count int, is_toc_page boolean, manual_id string"
DESCRIPTION = "source_sha256 string, model_name string, chunk_words int, overlap_words int, index_version string, chunk_count bigint, embedding_dimension int, toc_page_count bigint, manual_id string"

Factory = Callable[[], Callable[[list[str]], np.ndarray]]


class Index(NamedTuple):
    chunks: DataFrame
    vectors: DataFrame
    meta: DataFrame


def index_keys(manuals: DataFrame, model_name: str, chunk_words: int = 220, overlap_words: int = 60) -> DataFrame:
    """The wanted key of each manual (manual_id, sha256)."""
    fixed = {"model_name": model_name, "chunk_words": chunk_words, "overlap_words": overlap_words, "index_version": VERSION}
    return manuals.select("manual_id", F.col("sha256").alias("source_sha256"), *[F.lit(v).alias(k) for k, v in fixed.items()])


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_index(spark: SparkSession, path: str, element: str = "float") -> Index | None:
    """The index in a folder, None where there is none."""
    if not all(_exists(spark, f"{path}/{part}") for part in ("chunks", "vectors", "meta")):
        return None
    read = lambda part, schema: spark.read.schema(schema).parquet(f"{path}/{part}")
    meta = read("meta", DESCRIPTION)
    held = meta.where("chunk_count > 0").select("manual_id")  # what was built before a manual lost its text doesn't count
    vectors = read("vectors", f"chunk_id string, embedding array<{element}>, manual_id string")
    return Index(read("chunks", CHUNK).join(held, "manual_id", "leftsemi"), vectors.join(held, "manual_id", "leftsemi"), meta)


def ensure_index(spark: SparkSession, path: str, keys: DataFrame, chunks: DataFrame, factory: Factory, batch: int = 32, rebuild: bool = False, element: str = "float") -> Index:
    """The index with all manuals of ``keys``; those whose stored key is another one (or all, to ``rebuild``) are built from ``chunks``.

    Manuals without a chunk have a description with zero counts. Manuals that aren't asked for stay as they are.
    """
    held = read_index(spark, path, element)
    todo = cut_lineage(keys.select(*V.META) if held is None or rebuild else V.stale(held.meta, keys))
    if not todo.isEmpty():
        own = chunks.join(todo.select("manual_id"), "manual_id", "leftsemi")
        own = cut_lineage(own)  # written, encoded and counted
        made = V.encoded(own, "embedding_text", factory, batch=batch, element=element).select("manual_id", "chunk_id", "embedding")
        _replace(own.select(*[x.split()[0] for x in CHUNK.split(", ")]), f"{path}/chunks")
        _replace(made, f"{path}/vectors")
        stored = spark.read.schema(f"chunk_id string, embedding array<{element}>, manual_id string").parquet(f"{path}/vectors")
        stored = stored.join(own.select("manual_id").distinct(), "manual_id", "leftsemi")
        _replace(V.index_meta(own, stored, todo).select(*[x.split()[0] for x in DESCRIPTION.split(", ")]), f"{path}/meta")
    return checked(read_index(spark, path, element))


def _replace(df: DataFrame, path: str) -> None:
    # Few files a manual: rows of one meet in a task, and adaptive execution splits those of a large one.
    df.hint("rebalance", "manual_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("manual_id").parquet(path)


def checked(index: Index) -> Index:
    """The index, or ValueError where chunks and vectors don't pair."""
    if not V.misaligned(index.chunks, index.vectors).isEmpty():
        raise ValueError("the index is inconsistent: chunks and vectors differ")
    return index


def search(index: Index, queries: DataFrame, factory: Factory, k: int = 15, batch: int = 32, element: str = "float") -> DataFrame:
    """The ``k`` best chunks of its manual for each query (manual_id, query_id, query): (manual_id, query_id, rank, score, chunk columns)."""
    q = queries.withColumn("repaired", search_repair(F.col("query")))
    q = V.encoded(q, "repaired", factory, "query: ", batch, element).select("manual_id", "query_id", F.col("embedding").alias("query"))
    best = V.top_k_within(index.vectors, q, k).withColumn("score", F.round("score", 6))
    return best.join(index.chunks, ["manual_id", "chunk_id"])


def results(found: DataFrame, queries: DataFrame, index: Index) -> DataFrame:
    """One nested row for each query: its text, the index's description, and its matches in order; a query without one has none."""
    listed = found.groupBy("manual_id", "query_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", "score", "chunk_id", "page_id", "pdf_page_number", "start_line_id", "end_line_id", "is_toc_page", "word_count", "text"))).alias("matches")
    )
    meta = index.meta.select("manual_id", F.struct(*[c for c in index.meta.columns if c != "manual_id"]).alias("index"))
    out = queries.select("manual_id", "query_id", "query").join(meta, "manual_id", "left").join(listed, ["manual_id", "query_id"], "left")
    return out.withColumn("retrieval_version", F.lit(VERSION))
