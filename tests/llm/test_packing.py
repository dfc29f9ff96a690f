from __future__ import annotations

import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagelode.llm import packing as P


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 100), max_size=120))
def test_every_item_has_one_place(sizes):
    bins = P.pack(sizes, 100)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= 100 for b in bins)


def test_search_empties_containers():
    worse = 0
    for seed in range(30):
        rng = random.Random(seed)
        sizes = [rng.randrange(10, 60) for _ in range(300)]
        fit, packed = P._best_fit(sizes, 100), P.pack(sizes, 100)
        least = -(-sum(sizes) // 100)
        assert len(packed) <= len(fit) and len(packed) <= least + 3
        worse += len(packed) < len(fit)
    squares = lambda bins, sizes: sum(sum(sizes[i] for i in b) ** 2 for b in bins)
    sizes = [60, 50, 50, 40, 30, 30, 20, 20]
    start = [[0, 5], [1, 4], [2, 6], [3, 7]]
    assert squares(P._improve([list(b) for b in start], sizes, 100), sizes) > squares(start, sizes)


@pytest.mark.skipif(not os.path.exists(P.TOKENIZER), reason="no tokenizer files")
def test_documents(spark):
    rng = random.Random(4)
    rows = [(n, "cuvânt " * rng.randrange(1, 300), "x", 1) for n in range(200)] + [(900, "lung " * 9000, "x", 1), (901, None, "x", 1), (902, "", "x", 1), (None, "fără număr", "x", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, container string, tokens int")
    out = P.packed(df.union(df.where("doc_id = 5")), group_items=50).collect()
    encode = P.encoder(P.TOKENIZER).encode_ordinary
    fill = {}
    for r in out:
        if r["container"] is not None:
            fill[r["container"]] = fill.get(r["container"], 0) + r["tokens"]
    assert max(fill.values()) <= P.CAPACITY
    assert len({(r["doc_id"], r["piece"]) for r in out}) == len(out) and {r["doc_id"] for r in out} == set(range(200)) | {900, 901, 902}
    assert sum(r["tokens"] for r in out if r["doc_id"] == 900) == len(encode("lung " * 9000))
    assert [r["first_token"] for r in sorted((r for r in out if r["doc_id"] == 900), key=lambda r: r["piece"])][:2] == [0, P.CAPACITY]
    assert [r["container"] for r in out if r["doc_id"] == 901] == [None]
    assert len(fill) <= sum(fill.values()) / P.CAPACITY * 1.03 + 2
    assert P.packed(df.limit(0)).count() == 0
