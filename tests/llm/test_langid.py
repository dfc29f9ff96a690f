from __future__ import annotations

import random

import numpy as np
import pytest

from pagelode.llm import langid as L

# Everyday words of each language, for a small model.
WORDS = {
    "ro": "și că este pentru din cu la elevul profesorul învățătoarea mulțimea ecuația soluția găsește între câteva înlocuiri frumoasă carte școală dimineață",
    "en": "the and that with for this student teacher equation solution finds between several which school morning beautiful book under through",
    "fr": "les des une que dans pour avec élève professeur équation solution trouve entre plusieurs école matin beau livre sous leurs",
    "de": "und der die das nicht mit eine schüler lehrer gleichung lösung findet zwischen mehrere schule morgen schönes buch unter durch",
    "hu": "és hogy egy nem az tanuló tanár egyenlet megoldás talál között néhány iskola reggel szép könyv alatt minden mindig",
    "es": "los las una que para con alumno profesor ecuación solución encuentra entre varios escuela mañana hermoso libro bajo también",
    "it": "gli che una per con della alunno professore equazione soluzione trova tra diversi scuola mattina bello libro sotto anche",
}


def sentence(rng, lang, n=12):
    return " ".join(rng.choices(WORDS[lang].split(), k=n)).capitalize() + "."


@pytest.fixture(scope="module")
def network():
    rng = random.Random(5)
    sample = [(L.text_bytes(" ".join(sentence(rng, k) for _ in range(12))), n) for n, k in enumerate(L.LANGUAGES) for _ in range(40)]
    wrong = [(t, (n + 1) % 7) for t, n in sample[::15]]
    return L.trained(sample + wrong)


def test_gradients_are_those_of_the_loss():
    net = L.Network(seed=1)
    rng = np.random.default_rng(2)
    grams, labels = rng.integers(0, L.HASHES, (3, 5, L.PATCH)).astype(np.int32), rng.integers(0, 7, (3, 5))
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    _, g, _ = net.gradients(grams, labels)
    for name in ("Uf", "Vb", "W", "bb"):
        index = tuple(0 for _ in net.p[name].shape)
        old, step = net.p[name][index], 1e-3
        net.p[name][index] = old + step
        up = net.gradients(grams, labels)[0]
        net.p[name][index] = old - step
        down = net.gradients(grams, labels)[0]
        net.p[name][index] = old
        assert g[name][index] == pytest.approx((up - down) / (2 * step), rel=0.05, abs=1e-5)


def test_held_out_accuracy(network):
    rng = random.Random(77)
    texts = [(k, " ".join(sentence(rng, k) for _ in range(3))) for k in L.LANGUAGES for _ in range(20)]
    found = list(L.segments(network, [t for _, t in texts]))
    assert sum(max(f, key=lambda s: s[2])[0] == k for f, (k, _) in zip(found, texts)) >= 0.95 * len(texts)


def test_mixed_segments(network):
    rng = random.Random(9)
    a, b = (" ".join(sentence(rng, k) for _ in range(4)) for k in ("ro", "de"))
    (found,) = L.segments(network, [f"{a} {b}"])
    long = [s for s in found if s[2] >= 20]
    assert [s[0] for s in long] == ["ro", "de"] and abs(long[0][2] - 48) <= 3
    assert list(L.segments(network, ["", "123 ...", "ß"]))[:2] == [[], []]


def test_viterbi_equals_brute_force():
    from itertools import product

    rng = np.random.default_rng(3)
    docs = [rng.normal(size=(n, 3)) * 3 for n in (1, 2, 5, 7)]
    for words, path in zip(docs, L.segment_all(docs, [np.full(len(d), 2.0) for d in docs])):
        score = lambda p, w=words: sum(w[t, k] for t, k in enumerate(p)) - 2.0 * sum(x != y for x, y in zip(p, p[1:]))
        assert score(tuple(path)) == pytest.approx(max(score(p) for p in product(range(3), repeat=len(words))), abs=1e-4)


def test_documents(spark):
    rng = random.Random(6)
    rows = [(n * 100 + i, " ".join(sentence(rng, k) for _ in range(5)), k, "x", 1) for n, k in enumerate(L.LANGUAGES) for i in range(30)]
    mixed = " ".join(sentence(rng, "ro") for _ in range(4)) + " " + " ".join(sentence(rng, "hu") for _ in range(4))
    rows += [(9001, rows[0][1], "germană", "x", 1), (9002, rows[1][1], None, "x", 1), (9003, mixed, "ro", "x", 1), (9004, None, None, "x", 1), (9005, "", "en", "x", 1), (9006, "12 34", "en", "x", 1), (9007, "zvgdnxs mqmgpkjfw gnjbdnq zldfmqxpb wrtplk " * 4, None, "x", 1), (9008, " ".join(sentence(rng, "ro") for _ in range(3000)), "RO", "x", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, words string, junk int")
    out = sorted(map(tuple, L.mislabelled(L.document_languages(df, doubtful_only=True)).collect()))
    assert out == [(9001, "ro"), (9002, "ro"), (9003, "hu"), (9003, "ro")]
    assert L.document_languages(df.limit(0)).count() == 0


def test_both_forward_passes_agree(network):
    grams = np.random.default_rng(4).integers(0, L.HASHES, (5, 9, L.PATCH)).astype(np.int32)
    plain = np.concatenate([network.run(grams, "f"), network.run(grams, "b")], axis=2)
    assert np.allclose(plain, network.states(grams), atol=1e-5)
