"""Texts packed into containers of fixed capacity (problem 6).

Texts are measured in tokens of a public tokenizer, spread over groups of bounded size by a hash, and packed within each
group: best fit, then a swap-based local search that moves a document, exchanges one for one or one for two between
underfull containers whenever that raises the sum of squared fills, until containers become empty. The documents of the
containers that stay underfull are packed once more across groups. A text longer than a container fills containers of
its own; its rest is an item like any other.
"""

from __future__ import annotations

import base64
from bisect import bisect_right, insort
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelode.session import cut_lineage

CAPACITY = 2048
GROUP_ITEMS = 4000  #: items of a group, about
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
_ENCODERS: dict[str, object] = {}


def encoder(path: str):
    """The tokenizer of a ranks file, loaded once in each process."""
    if path not in _ENCODERS:
        import tiktoken

        pattern = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[path] = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


def token_counts(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = TOKENIZER) -> DataFrame:
    """Rows (doc_id, tokens); a null text has null tokens."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode_ordinary
        for b in batches:
            sizes = [None if t is None else len(encode(t)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64())], names=["doc_id", "tokens"])

    return documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(scan, "doc_id bigint, tokens bigint")


def _best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Containers of item numbers, largest items first, each where it leaves least room."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []  # (free, container), ascending
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        k = bisect_right(room, (sizes[i], -1))
        if k < len(room):
            free, b = room.pop(k)
        else:
            free, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        insort(room, (free - sizes[i], b))
    return bins


def _improve(bins: list[list[int]], sizes: list[int], capacity: int) -> list[list[int]]:
    """Local search between underfull containers: each step fills a fuller one from an emptier one."""
    fill = [sum(sizes[i] for i in b) for b in bins]
    least = -(-sum(fill) // capacity)
    open_ = [k for k in range(len(bins)) if fill[k] < capacity]
    while len(bins) - sum(not b for b in bins) > least and len(open_) > 1:
        open_.sort(key=lambda k: fill[k])
        giver = open_[0]
        moved = False
        for taker in reversed(open_[1:]):
            gap = capacity - fill[taker]
            mine = sorted((sizes[i], i) for i in bins[giver])
            if gap <= 0 or not mine:
                continue
            best: tuple[int, list[int], list[int]] | None = None
            k = bisect_right(mine, (gap, len(sizes))) - 1
            if k >= 0 and mine[k][0] > 0:
                best = (mine[k][0], [], [mine[k][1]])  # move
            for x in bins[taker]:
                k = bisect_right(mine, (sizes[x] + gap, len(sizes))) - 1
                if k >= 0 and mine[k][0] - sizes[x] > (best[0] if best else 0):
                    best = (mine[k][0] - sizes[x], [x], [mine[k][1]])  # one for one
                for p, (size, y) in enumerate(mine):  # one for two
                    q = bisect_right(mine, (sizes[x] + gap - size, len(sizes))) - 1
                    if q > p and size + mine[q][0] - sizes[x] > (best[0] if best else 0):
                        best = (size + mine[q][0] - sizes[x], [x], [y, mine[q][1]])
            if best:
                gain, back, over = best
                bins[taker] = [i for i in bins[taker] if i not in back] + over
                bins[giver] = [i for i in bins[giver] if i not in over] + back
                fill[taker] += gain
                fill[giver] -= gain
                moved = True
                if not fill[giver]:
                    break
        if not moved or not fill[giver]:
            if not fill[giver] and bins[giver]:  # only empty texts are left
                bins[open_[1]] += bins[giver]
                bins[giver] = []
            open_.pop(0)
        open_ = [k for k in open_ if fill[k] < capacity]
    return [b for b in bins if b]


def pack(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Containers of item numbers; no item may exceed the capacity."""
    return _improve(_best_fit(sizes, capacity), sizes, capacity)


def _packed(items: DataFrame, groups: int, capacity: int) -> DataFrame:
    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece"], ignore_index=True)
        sizes = pdf["tokens"].astype(int).tolist()
        container, filled = [0] * len(sizes), [0] * len(sizes)
        for n, b in enumerate(pack(sizes, capacity)):
            total = sum(sizes[i] for i in b)
            for i in b:
                container[i], filled[i] = n, total
        return pdf.assign(container=[int(key[0]) * 10_000_000 + n for n in container], filled=filled)[["doc_id", "piece", "first_token", "tokens", "container", "filled"]]

    grouped = items.withColumn("g", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)))
    return grouped.groupBy("g").applyInPandas(one, "doc_id bigint, piece int, first_token bigint, tokens bigint, container bigint, filled bigint")


def packed(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = TOKENIZER, capacity: int = CAPACITY, group_items: int = GROUP_ITEMS) -> DataFrame:
    """Rows (doc_id, piece, first_token, tokens, container): every document's place.

    A document within the capacity is one piece, 1. A longer one is cut into pieces of the capacity and a rest. An empty
    text has 0 tokens and lies in any container; a null text has one row with null tokens and container. doc_ids must be
    unique: repeated rows are packed once, at their largest size, and rows without an id are left out.
    """
    counts = cut_lineage(token_counts(documents.where(F.col(doc_id).isNotNull()), doc_id, text, path).groupBy("doc_id").agg(F.max("tokens").alias("n")))
    pieces = F.greatest(F.lit(1), F.ceil(F.col("n") / capacity)).cast("int")
    items = counts.where(F.col("n").isNotNull()).select("doc_id", "n", F.explode(F.sequence(F.lit(1), pieces)).alias("piece"))
    first = (F.col("piece") - 1).cast("bigint") * capacity
    items = items.select("doc_id", "piece", first.alias("first_token"), F.least(F.lit(capacity).cast("bigint"), F.col("n") - first).alias("tokens"))
    groups = max(1, items.count() // group_items)
    once = cut_lineage(_packed(items, groups, capacity))
    if groups > 1:
        loose = F.col("filled") < capacity * 0.98
        again = once.where(loose)
        few = max(1, again.count() // group_items)
        again = _packed(again.select("doc_id", "piece", "first_token", "tokens"), few, capacity).withColumn("container", -1 - F.col("container"))
        once = once.where(~loose).unionAll(again)
    nulls = counts.where(F.col("n").isNull()).select("doc_id", F.lit(1).alias("piece"), F.lit(0).cast("bigint").alias("first_token"), F.col("n").alias("tokens"), F.lit(None).cast("bigint").alias("container"))
    return once.drop("filled").unionAll(nulls)
