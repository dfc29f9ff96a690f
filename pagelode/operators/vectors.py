"""Vectors of chunks: encoding, index, its validation, and exact search."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

META = ["manual_id", "source_sha256", "model_name", "chunk_words", "overlap_words", "index_version"]


def hashing_encoder(dimension: int = 64) -> Callable[[list[str]], np.ndarray]:
    """A stand-in encoder that needs no model: signed hashes (the first eight digits of MD5) of words between blanks."""

    @lru_cache(maxsize=200_000)
    def place(word: str) -> tuple[int, int]:
        h = int(hashlib.md5(word.encode("utf-8", "replace")).hexdigest()[:8], 16)
        return h % dimension, 1 if h & 0x10000 else -1

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dimension))
        for row, t in zip(out, texts):
            for w in t.split(" "):
                if w:
                    at, sign = place(w)
                    row[at] += sign
        return out

    return encode


def encoded(df: DataFrame, text: str, factory: Callable[[], Callable[[list[str]], np.ndarray]], prefix: str = "passage: ", batch: int = 32, element: str = "float") -> DataFrame:
    """Adds ``embedding``: unit vectors (arrays of ``element``) of prefixed texts. ``factory`` makes the encoder, once in each task."""
    if batch <= 0:
        raise ValueError("batch must be positive")

    @pandas_udf(f"array<{element}>")
    def encode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = factory()
        for s in parts:
            texts = [prefix + (t or "") for t in s]
            rows = [encoder(texts[i : i + batch]) for i in range(0, len(texts), batch)]
            m = np.concatenate(rows) if rows else np.zeros((0, 1), np.float32)
            n = np.linalg.norm(m, axis=1, keepdims=True)
            yield pd.Series(list(m / np.where(n == 0, 1, n)))

    return df.withColumn("embedding", encode(F.col(text)))


def dot(a: Column, b: Column) -> Column:
    """Dot product in double precision."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def index_meta(chunks: DataFrame, vectors: DataFrame, keys: DataFrame) -> DataFrame:
    """A row for each manual of ``keys`` (META columns): its key fields, counts and dimension."""
    counts = chunks.groupBy("manual_id").agg(F.count("*").alias("chunk_count"), F.count_distinct(F.when(F.col("is_toc_page"), F.col("page_id"))).alias("toc_page_count"))
    width = vectors.groupBy("manual_id").agg(F.max(F.size("embedding")).alias("embedding_dimension"))
    out = keys.select(*META).join(counts, "manual_id", "left").join(width, "manual_id", "left").fillna(0, ["chunk_count", "toc_page_count", "embedding_dimension"])
    return out.select(*META, "chunk_count", "embedding_dimension", "toc_page_count")


def stale(stored: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``keys`` (META columns) without an equal stored row; null equals null."""
    same = F.lit(True)
    for c in META:
        same = same & F.col(f"k.{c}").eqNullSafe(F.col(f"s.{c}"))
    return keys.select(*META).alias("k").join(stored.select(*META).alias("s"), same, "left_anti")


def misaligned(chunks: DataFrame, vectors: DataFrame) -> DataFrame:
    """Chunks without a vector and vectors without a chunk: empty for a sound index."""
    a, b = chunks.select("manual_id", "chunk_id"), vectors.select("manual_id", "chunk_id")
    return a.join(b, ["manual_id", "chunk_id"], "left_anti").withColumn("missing", F.lit("vector")).unionByName(b.join(a, ["manual_id", "chunk_id"], "left_anti").withColumn("missing", F.lit("chunk")))


MAX_QUERIES = 4096  #: query vectors that are broadcast at once, about; more are answered in blocks


def top_k(vectors: DataFrame, queries: DataFrame, k: int, id_column: str = "vec_id", query_column: str = "query_id", block: int = MAX_QUERIES) -> DataFrame:
    """The ``k`` best of ``vectors`` for each of ``queries`` (query_column, query): dot product, ties by id.

    The queries are a stated set, each is met with all vectors: in blocks of about ``block`` queries by a hash of their ids, each
    a broadcast and a scan. Each task keeps its own best k before the shuffle, so what moves is (tasks x queries x k) rows.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    blocks = -(-max(queries.count(), 1) // block)
    order = Window.partitionBy(query_column).orderBy(F.desc("score"), id_column)
    best = None
    for n in range(blocks):
        own = queries.where(F.pmod(F.xxhash64(query_column), F.lit(blocks)) == n) if blocks > 1 else queries
        scored = vectors.crossJoin(F.broadcast(own)).select(query_column, id_column, dot(F.col("embedding"), F.col("query")).alias("score"))
        ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        best = ranked if best is None else best.unionByName(ranked)
    return best


def top_k_within(vectors: DataFrame, queries: DataFrame, k: int, group: str = "manual_id", id_column: str = "chunk_id", query_column: str = "query_id") -> DataFrame:
    """Like :func:`top_k`, but each query (group, query_column, query) is met with the vectors of its own group only: an equi-join.

    Scores are rounded to nine decimals, so that equal ones are ties whatever the order of summing.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    scored = vectors.join(queries, group).select(group, query_column, id_column, F.round(dot(F.col("embedding"), F.col("query")), 9).alias("score"))
    order = Window.partitionBy(group, query_column).orderBy(F.desc("score"), id_column)
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
