"""Evaluation passages inside a training corpus (problem 7).

SimHash fingerprints of 12-word windows on both sides; a multi-index over disjoint bit blocks finds every pair of
fingerprints within the radius (a pair that differs in at most R bits agrees on one of R + 1 blocks); each candidate is
then checked exactly, by its run of equal words.

Retouched passages, in which words were replaced all over, are found at the size of the item: fingerprints of as many words
as the item, or one of its parts (halves and quarters, each overlapping the next by half), has are compared within a radius
that fits a quarter of replaced words. At such a radius blocks of bits rule nothing out; instead, only documents and items
are compared that share shingles of enough weight for any of the item's parts (a bound that no counting window misses).
Candidates are checked by weighted shingles.

The evaluation side is a stated query set (the held-out items): it is read to the driver behind a size check and
sent to the executors; the corpus is scanned once, in Arrow batches, and is never shuffled before the few matches.
Larger item sets are answered in blocks of ``MAX_ITEM_WORDS`` words, one scan a block.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelode.llm.text import fold

WORD = re.compile(r"[^\W_]+")
WINDOW = 12  #: words of a passage
RADIUS = 2  #: bits in which two fingerprints may differ
BLOCK_BITS = (21, 21, 22)  #: RADIUS + 1 disjoint blocks of the 64 bits
SHINGLE = 3  #: words of a shingle in the check of retouched passages
SIMILARITY = 0.3  #: share of a part's weighted shingles from which a retouched passage counts: one word of six replaced keeps half
SIMILARITY_SHORT = 0.45  #: the same for parts of fewer than SHORT_PART words
SHORT_PART = 20
RARE = 16  #: items that hold a shingle at most for its weight to be counted item by item
STRIDE = 4  #: words between the starts of item-sized windows
PART_RADIUS = 23  #: bits in which the fingerprints of item-sized windows may differ
PART_WORDS = (12, 127)  #: words of an item's part; longer items are cut into more parts, and shorter ones aren't taken
OTHER = 4096  #: bit patterns shared by words that no item holds
MAX_ITEM_WORDS = 2_000_000  #: words of items sent to the executors at once


def words_of(text: str | None) -> list[str]:
    """Words in comparison form: letter case, accents, punctuation, spacing and look-alike characters don't matter."""
    return WORD.findall(fold(text)) if text else []


class Numbers(dict):
    """Bit pattern number of each word: its own for a word of the items, a hashed one for another, the same on every executor."""

    def __missing__(self, word: str) -> int:
        self[word] = at = zlib.crc32(word.encode()) % OTHER
        return at


class PassageIndex:
    """Fingerprints of all item windows, by bit block."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = [(i, words_of(t)) for i, t in items]
        self.vocab: dict[str, int] = {}
        for _, ws in self.items:
            for w in ws:
                self.vocab.setdefault(w, OTHER + len(self.vocab))
        self.numbers = Numbers(self.vocab)
        rng = np.random.default_rng(20240607)
        self.signs = (rng.integers(0, 2, size=(OTHER + len(self.vocab), 64), dtype=np.int8) * 2 - 1).astype(np.int8)
        codes, self.owner, self.start = [], [], []
        for n, (_, ws) in enumerate(self.items):
            ids = np.fromiter((self.vocab[w] for w in ws), dtype=np.int32, count=len(ws))
            if len(ids) >= WINDOW:
                codes.append(self.fingerprints(ids))
                self.owner += [n] * len(codes[-1])
                self.start += range(len(codes[-1]))
        self.codes = np.concatenate(codes) if codes else np.zeros(0, np.uint64)
        self.blocks = []
        shift = 0
        for bits in BLOCK_BITS:
            part = (self.codes >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
            order = np.argsort(part, kind="stable")
            seen = np.zeros(1 << bits, dtype=bool)
            seen[part.astype(np.int64)] = True
            self.blocks.append((shift, bits, seen, part[order], order))
            shift += bits
        # A shingle weighs more the fewer items hold it.
        held: dict[tuple[str, ...], list[int]] = {}
        for n, (_, ws) in enumerate(self.items):
            for s in self._shingles(n, 0, len(ws)):
                held.setdefault(s, []).append(n)
        self.weight = {s: 1.0 / len(of) for s, of in held.items()}
        keyed = sorted((self._key(*(self.vocab[w] for w in s)), of) for s, of in held.items())
        self.keys = np.array([k for k, _ in keyed], dtype=np.int64)
        self.held = np.array([len(of) for _, of in keyed], dtype=np.int64)
        self.holders = np.fromiter(chain.from_iterable(of for _, of in keyed), dtype=np.int64)
        # Of each item its parts: first word, words, fingerprint, sorted shingle numbers with their weights, weight needed.
        least, most = PART_WORDS
        self.parts: list[list[tuple[int, int, np.uint64, np.ndarray, np.ndarray, float]]] = []
        for n, (_, ws) in enumerate(self.items):
            own = []
            pieces = -(-len(ws) // most)
            for cut in (pieces, 2 * pieces, 4 * pieces) if len(ws) >= WINDOW else ():
                size = len(ws) // cut
                if size < least and cut > pieces:
                    continue
                for at in sorted({*range(0, len(ws) - size + 1, max(1, -(-size // 2))), len(ws) - size}):
                    ids = np.fromiter((self.vocab[w] for w in ws[at : at + size]), dtype=np.int32, count=size)
                    shingles = sorted((int(self._key(*(self.vocab[w] for w in x))), self.weight[x]) for x in self._shingles(n, at, size))
                    weights = np.array([w for _, w in shingles])
                    needed = (SIMILARITY if size >= SHORT_PART else SIMILARITY_SHORT) * weights.sum()
                    own.append((at, size, self.fingerprints(ids, size)[0], np.array([k for k, _ in shingles], np.int64), weights, needed))
            self.parts.append(own)
        self.needed = np.array([min((x[-1] for x in own), default=np.inf) for own in self.parts])

    def sums(self, ids: np.ndarray) -> np.ndarray:
        """Running sums of the words' bit patterns; they may wrap, but differences over fewer than 128 words don't."""
        run = np.zeros((len(ids) + 1, 64), dtype=np.int8)
        np.cumsum(self.signs[ids], axis=0, dtype=np.int8, out=run[1:])
        return run

    def fingerprints(self, ids: np.ndarray, size: int = WINDOW) -> np.ndarray:
        """SimHash of each window of ``size`` consecutive words."""
        if len(ids) < size:
            return np.zeros(0, np.uint64)
        run = self.sums(ids)
        return np.packbits(run[size:] - run[:-size] > 0, axis=1).view(np.uint64).ravel()

    def _key(self, a, b, c):
        """A number for a shingle of three words' bit pattern numbers (under 2 ** 63, as MAX_ITEM_WORDS bounds them)."""
        size = len(self.signs)
        return (a * size + b) * size + c

    def _shingles(self, n: int, k: int, size: int) -> set[tuple[str, ...]]:
        ws = self.items[n][1]
        return {tuple(ws[p : p + SHINGLE]) for p in range(k, k + size - SHINGLE + 1)}

    def near_pairs(self, keys: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
        """(document, item number) of all that share shingles of enough weight for one of the item's parts.

        ``keys`` has the shingle that starts at each word, -1 for none. Shingles that few items hold are counted by document and
        item; of the others the most that stands in any window of a document is added to each of its items.
        """
        if not len(self.keys) or not len(keys):
            return []
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = np.flatnonzero(self.keys[at] == keys)
        at = at[hit]
        n = self.held[at]
        rare = n <= RARE
        common = np.zeros(len(keys) + 1)
        common[hit[~rare] + 1] = 1.0 / n[~rare]
        run = np.cumsum(common)
        width = np.minimum(np.arange(len(keys)) + PART_WORDS[1] + 2 * STRIDE, len(keys))
        most = np.zeros(len(ends))
        full = np.flatnonzero(ends > begins)
        if len(full):
            most[full] = np.maximum.reduceat(run[width] - run[:-1], begins[full])
        hit, at, n = hit[rare], at[rare], n[rare]
        first = (np.cumsum(self.held) - self.held)[at]
        of = self.holders[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        pairs, which = np.unique(np.repeat(np.searchsorted(ends, hit, "right"), n) * len(self.items) + of, return_inverse=True)
        sums = np.bincount(which, weights=np.repeat(1.0 / n, n), minlength=len(pairs))
        d, i = pairs // len(self.items), pairs % len(self.items)
        counts = sums + most[d] + 1e-6 >= self.needed[i]
        out = {*zip(d[counts].tolist(), i[counts].tolist())}
        for d in np.flatnonzero(most + 1e-6 >= self.needed.min()).tolist():
            out |= {(d, i) for i in np.flatnonzero(most[d] + 1e-6 >= self.needed).tolist()}
        return sorted(out)

    def retouched(self, run: np.ndarray, own: np.ndarray, n: int) -> tuple[float, int]:
        """The best similarity of a document's windows to an item's parts and its first word; 0 if none counts.

        Only windows within PART_RADIUS bits count; those over an end of the document are cut there. ``run`` has the running sums
        of bit patterns, ``own`` the shingle that starts at each word.
        """
        best, first, words = 0.0, 0, len(own)
        for _, size, code, shingles, weights, needed in self.parts[n]:
            at = np.minimum(np.searchsorted(shingles, own), len(shingles) - 1)
            held = np.where(shingles[at] == own, weights[at], 0.0)
            run_held = np.concatenate((np.zeros(1), np.cumsum(held)))
            starts = np.arange(-(size // 2) // STRIDE * STRIDE, words - size // 2 + 1, STRIDE)
            lo, hi = np.clip(starts - STRIDE, 0, words), np.clip(starts + size + STRIDE - SHINGLE + 1, 0, words)
            most = run_held[np.maximum(lo, hi)] - run_held[lo]  # a shingle that comes twice counts twice: a bound
            open_ = np.flatnonzero(most + 1e-6 >= max(needed, best * weights.sum()))
            if not len(open_):
                continue
            starts, most, lo, hi = starts[open_], most[open_], lo[open_], hi[open_]
            a, b = np.clip(starts, 0, words), np.clip(starts + size, 0, words)
            near = np.bitwise_count(np.packbits(run[b] - run[a] > 0, axis=1).view(np.uint64).ravel() ^ code) <= PART_RADIUS
            for k in np.flatnonzero(near)[np.argsort(-most[near], kind="stable")].tolist():
                if most[k] + 1e-6 < max(needed, best * weights.sum()):
                    break
                inside = at[lo[k] : hi[k]][held[lo[k] : hi[k]] > 0]
                weight = weights[np.unique(inside)].sum()
                if weight + 1e-9 >= needed and weight > best * weights.sum() + 1e-9:
                    best, first = float(weight / weights.sum()), int(max(starts[k], 0))
        return best, first

    def candidates(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (corpus window, item window) within RADIUS bits; none is missed."""
        windows, items = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for shift, bits, seen, keys, order in self.blocks:
            part = (codes >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
            hit = np.flatnonzero(seen[part.astype(np.int64)])
            if not len(hit):
                continue
            lo, hi = np.searchsorted(keys, part[hit], "left"), np.searchsorted(keys, part[hit], "right")
            n = hi - lo
            at = np.repeat(hit, n)
            item = order[np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())]
            near = np.bitwise_count(codes[at] ^ self.codes[item]) <= RADIUS
            windows.append(at[near])
            items.append(item[near])
        return np.concatenate(windows), np.concatenate(items)

    def verify(self, ws: list[str], at: int, item: int) -> tuple[int, int, int]:
        """Item number, first word and length of the longest equal run through the aligned windows."""
        n, k = self.owner[item], self.start[item]
        other = self.items[n][1]
        lo = at - min(at, k)
        hi = at + min(len(ws) - at, len(other) - k)
        best = run = first = 0
        for p in range(lo, hi):
            if ws[p] == other[p - at + k]:
                run += 1
                if run > best:
                    best, first = run, p - run + 1
            else:
                run = 0
        return n, first, best

    def matches(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, int, float]]:
        """(document number, item number, first word, run of equal words, similarity), the best of each document and item.

        The run is 0 for a passage that only its shingles show, the similarity that of the best item-sized window, 0 if none counts.
        """
        docs = [words_of(t) for t in texts]
        if len(self.numbers) > 500_000:
            self.numbers = Numbers(self.vocab)
        flat = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(docs)), dtype=np.int32)
        ends = np.cumsum([len(ws) for ws in docs])
        found: dict[tuple[int, int], tuple[int, int]] = {}
        like: dict[tuple[int, int], tuple[float, int]] = {}
        exact: set[tuple[int, int, int]] = set()  # alignments whose run of equal words is long enough and known
        begins = ends - np.array([len(ws) for ws in docs], dtype=np.int64)
        step = 100_000
        for base in range(0, len(flat), step):
            codes = self.fingerprints(flat[base : base + step + WINDOW - 1])
            windows, items = self.candidates(codes)
            windows = windows + base
            docs_of = np.searchsorted(ends, windows, "right")
            inside = windows + WINDOW <= ends[np.minimum(docs_of, len(ends) - 1)]
            for at, item, d in zip(windows[inside].tolist(), items[inside].tolist(), docs_of[inside].tolist()):
                begin = int(begins[d])
                aligned = (d, self.owner[item], at - begin - self.start[item])
                if aligned in exact:
                    continue
                n, first, run = self.verify(docs[d], at - begin, item)
                if run < WINDOW:
                    continue
                exact.add(aligned)
                old = found.get((d, n))
                if old is None or run > old[1]:
                    found[d, n] = (first, run)
        wide = flat.astype(np.int64)
        keys = np.full(len(flat), -1, np.int64)
        if len(flat) >= SHINGLE:
            keys[:-2] = self._key(wide[:-2], wide[1:-1], wide[2:])
            for back in range(1, SHINGLE):  # none crosses the end of a document
                last = ends - back
                keys[last[last >= begins]] = -1
        at, sums = -1, np.zeros((0, 64), np.int8)
        for d, n in self.near_pairs(keys, begins, ends):
            begin, end = int(begins[d]), int(ends[d])
            if d != at:
                at, sums = d, self.sums(flat[begin:end])
            similarity, first = self.retouched(sums, keys[begin:end], n)
            if similarity:
                like[d, n] = (similarity, first)
        for d, n in found.keys() | like.keys():
            similarity, near = like.get((d, n), (0.0, 0))
            first, run = found.get((d, n), (near, 0))
            yield d, self.items[n][0], first, run, similarity


def _blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int, str]]]:
    block, size = [], 0
    for row in items.where(F.col(text).isNotNull()).select(item_id, text).toLocalIterator():
        block.append((row[0], row[1]))
        size += len(row[1].split())
        if size >= MAX_ITEM_WORDS:
            yield block
            block, size = [], 0
    if block:
        yield block


def contaminated(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, item_id, first_word, run_words, similarity): passages of items that documents hold.

    One row for each document and item with a run of at least WINDOW equal consecutive words, or a window of the size
    of the item or a part of it that holds SIMILARITY of the part's weighted shingles; run_words is 0 for the latter alone. Null and empty texts match nothing; items shorter than
    WINDOW words have no passage; repeated rows give repeated matches once; other columns are ignored.
    """
    spark = documents.sparkSession
    schema = "doc_id bigint, item_id bigint, first_word int, run_words int, similarity double"
    narrow = documents.where(F.col(text).isNotNull()).select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    out = None
    for block in _blocks(items, item_id, text):
        shared = spark.sparkContext.broadcast(PassageIndex(block))

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index: PassageIndex = shared.value
            for batch in batches:
                ids = batch.column(0).to_pylist()
                rows = [(ids[d], *rest) for d, *rest in index.matches(batch.column(1).to_pylist())]
                columns = list(zip(*rows)) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64()))],
                    names=["doc_id", "item_id", "first_word", "run_words", "similarity"],
                )

        part = narrow.mapInArrow(scan, schema)
        out = part if out is None else out.union(part)
    if out is None:
        out = spark.createDataFrame([], schema)
    best = F.max(F.struct("run_words", "similarity", (-F.col("first_word")).alias("f"))).alias("b")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", (-F.col("b.f")).alias("first_word"), "b.run_words", "b.similarity")
