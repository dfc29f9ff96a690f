from __future__ import annotations

import random

from pagelode.llm import contamination as C

SCHEMA = "doc_id bigint, text string, item_id string, similarity string"


def docs(spark, texts):
    return spark.createDataFrame([(n, t, "clash", "clash") for n, t in enumerate(texts)], SCHEMA)


def items(spark, texts):
    return spark.createDataFrame([(100 + n, t) for n, t in enumerate(texts)], "item_id bigint, text string")


def brute(texts, questions):
    out = set()
    for q, question in enumerate(questions):
        b = C.words_of(question)
        grams = {tuple(b[k : k + 12]) for k in range(len(b) - 11)}
        for d, text in enumerate(texts):
            a = C.words_of(text)
            if any(tuple(a[k : k + 12]) in grams for k in range(len(a) - 11)):
                out.add((d, 100 + q))
    return out


def test_equals_brute_force(spark):
    rng = random.Random(1)
    words = [f"cuvânt{i}" for i in range(60)]
    questions = [" ".join(rng.choices(words, k=40)) for _ in range(12)]
    texts = []
    for n in range(60):
        body = rng.choices(words, k=rng.randrange(0, 80))
        q = rng.choice(questions).split()
        k, size = rng.randrange(0, 28), rng.randrange(9, 16)
        at = rng.randrange(0, len(body) + 1)
        texts.append(" ".join(body[:at] + q[k : k + size] + body[at:]))
    out = C.contaminated(docs(spark, texts), items(spark, questions)).where("run_words >= 12").collect()
    assert {(r["doc_id"], r["item_id"]) for r in out} == brute(texts, questions)


def test_looks_do_not_matter(spark):
    q = "Un tren parcurge 714 kilometri în 936 minute, oprind în 487 stații până seara târziu la Iași."
    texts = [
        "> UN TREN parcurge 714\n* kilometri in 936 minute oprind\n  în 487 statii pana seara",
        "Un tren parcurge 714 kilometri înainte. în 936 minute, oprind în 487 stații",
        "Un tren рarcurge 714 kilometri în​ 936 minute, oprind în ４８７ stații până",
        None, "", "   ", "scurt",
    ]
    out = C.contaminated(docs(spark, texts), items(spark, [q, None, "prea scurt"])).where("run_words >= 12").collect()
    assert sorted(r["doc_id"] for r in out) == [0, 2] and {r["item_id"] for r in out} == {100}


def test_long_and_repeated_documents_and_empty_tables(spark):
    q = " ".join(f"w{i}" for i in range(14))
    long = "alt text lung " * 40_000 + q
    df = docs(spark, [long, q]).union(docs(spark, [long, q]))
    out = C.contaminated(df, items(spark, [q])).collect()
    assert sorted((r["doc_id"], r["run_words"]) for r in out) == [(0, 14), (1, 14)]
    assert C.contaminated(df.limit(0), items(spark, [q])).count() == 0
    assert C.contaminated(df, items(spark, [q]).limit(0)).count() == 0


def test_blocks_find_every_near_fingerprint():
    import numpy as np

    index = C.PassageIndex([(1, " ".join(f"w{i}" for i in range(40)))])
    rng = random.Random(2)
    for _ in range(200):
        k = rng.randrange(len(index.codes))
        code = int(index.codes[k])
        for bit in rng.sample(range(64), rng.randrange(0, 3)):
            code ^= 1 << bit
        assert k in index.candidates(np.array([code], np.uint64))[1]


def test_recall_of_retouched_passages():
    """Passages of 24 words and more with every sixth word or one to three words of each twelve changed; none has 12 equal words."""
    rng = random.Random(4)
    questions = [" ".join(rng.choices([f"cuvânt{i}" for i in range(900)], k=rng.randrange(45, 93))) for _ in range(40)]
    other = lambda k: [f"alt{rng.randrange(500)}" for _ in range(k)]
    index = C.PassageIndex([(100 + n, q) for n, q in enumerate(questions)])
    for size, changes in ((60, 1), (60, 2), (60, 3), (36, 1), (36, 2), (24, 1), (24, 2)):
        texts = []
        for q in questions:
            ws = q.split()
            k = rng.randrange(0, max(1, len(ws) - size + 1))
            part = ws[k : k + size]
            for p in range(0, len(part), 12):
                for x in rng.sample(range(p, min(p + 12, len(part))), min(changes, len(part) - p)):
                    part[x] = f"schimbat{rng.randrange(9999)}"
            texts.append(" ".join(other(rng.randrange(0, 90)) + part + other(rng.randrange(0, 90))))
        got = {(d, i) for d, i, *_ in index.matches(texts)}
        assert got <= {(n, 100 + n) for n in range(40)} and len(got) >= 36, (size, changes, len(got))
    shuffled = [" ".join(rng.sample(q.split(), len(q.split()))) for q in questions]  # the same words in another order are no passage
    assert list(index.matches(shuffled)) == []


def test_matches_do_not_depend_on_other_documents():
    rng = random.Random(6)
    questions = [" ".join(rng.choices([f"w{i}" for i in range(80)], k=60)) for _ in range(8)]
    texts = [" ".join(rng.choices([f"w{i}" for i in range(80)], k=20) + [w if rng.random() < 0.85 else "x" for w in rng.choice(questions).split()[10:50]]) for _ in range(30)]
    index = C.PassageIndex(list(enumerate(questions)))
    together = sorted(index.matches(texts))
    assert together == sorted((n, *rest) for n, t in enumerate(texts) for _, *rest in index.matches([t])) and together


def test_pair_bound_misses_nothing():
    """Against all documents and items, also where most shingles are common."""
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(6)]
    questions = [" ".join(rng.choices(vocabulary, k=45)) for _ in range(30)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(0, 70))) for _ in range(20)]
    index = C.PassageIndex(list(enumerate(questions)))
    bounded = {(d, i, s) for d, i, _, run, s in index.matches(texts) if s}
    index.needed[:] = 0.0
    assert bounded == {(d, i, s) for d, i, _, run, s in index.matches(texts) if s} and bounded
