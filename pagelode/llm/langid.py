"""Languages of documents and of their segments (problem 8).

A bidirectional gated recurrent network reads the bytes of a text and labels every position with language
probabilities. It is trained here, in numpy, by backpropagation through time, on a bounded sample of labelled
documents (``SAMPLE`` a language, the bound is a parameter). One step reads ``PATCH`` bytes, each seen with its two
neighbours as a hashed trigram, so a position is a patch of four bytes.

Documents are labelled in one scan of Arrow batches, without a shuffle. Probabilities are pooled by word; where a
document's words disagree, a Viterbi pass with a cost for each change of language finds the segments.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelode.llm import quality
from pagelode.llm.quality import LANGUAGE_NAMES, label_language

LANGUAGES = tuple(LANGUAGE_NAMES)
SAMPLE = 200  #: labelled documents of each language used for training, at most
SAMPLE_BYTES = 1536  #: characters of each, and then bytes, used for training at most
PATCH = 4  #: bytes a step
STEPS = 64  #: steps of a window
HIDDEN = 12
HASHES = 8192
ITERATIONS = 360
LEAST_WORDS = 20  #: consecutive words that make a language part of a document
LEAST_LOG = -6.0  #: log probability below which a position says no more
WORD_WEIGHT = 0.5  #: weight of a position's evidence, as neighbouring positions share theirs
LEAST_CONFIDENCE = 0.65  #: of a segment that makes a document mixed
CHANGE_COST = 10.0  #: -ln probability of a change of language between two words
MARK_COST = 5.0  #: the same at the end of a sentence or line


def _trigrams(data: np.ndarray) -> np.ndarray:
    """Hash of each byte with its neighbours, in rows of PATCH."""
    padded = np.zeros(-(-len(data) // PATCH) * PATCH + 2, np.uint32)
    padded[1 : len(data) + 1] = data
    h = padded[:-2] * np.uint32(2654435761) ^ padded[1:-1] * np.uint32(40503) ^ padded[2:] * np.uint32(2246822519)
    return ((h ^ (h >> np.uint32(15))) % HASHES).astype(np.int32).reshape(-1, PATCH)


MARK = 1  #: the byte that stands for the end of a sentence or line
_BARE = bytes(c if c >= 128 or 97 <= c <= 122 or c == MARK else 32 for c in range(256))


def text_bytes(text: str) -> bytes:
    """What the network reads: lower case, ends of sentences and lines as a word of their own, all else but letters as one space."""
    text = text.lower()
    for end in ".!?;\n":
        text = text.replace(end, " \x01 ")
    if not text.isascii():
        for sign in "¦–—„”“«»•▪’…":
            text = text.replace(sign, " ")
    return b" " + b" ".join(text.encode("utf-8", "replace").translate(_BARE).split()) + b" "


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Gated recurrent units in both directions over patches of bytes, softmax over languages at each step."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        h, n = HIDDEN, len(LANGUAGES)
        scale = lambda *s: (rng.standard_normal(s) * 0.15).astype(np.float32)
        self.p = {}
        for d in "fb":
            self.p |= {f"E{d}": scale(HASHES, 3 * h), f"b{d}": np.zeros(3 * h, np.float32), f"U{d}": scale(h, 2 * h) * 2, f"V{d}": scale(h, h) * 2}
        self.p |= {"W": scale(2 * h, n), "c": np.zeros(n, np.float32)}

    def run(self, grams: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """Hidden states (steps, rows, HIDDEN) of one direction; grams is (rows, steps, PATCH)."""
        p, h = self.p, HIDDEN
        rows, steps, _ = grams.shape
        E, U, V = p[f"E{d}"], p[f"U{d}"], p[f"V{d}"]
        state = np.zeros((rows, h), np.float32)
        out = np.empty((steps, rows, h), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            x = E[grams[:, t, 0]]
            for k in range(1, PATCH):
                x += E[grams[:, t, k]]
            x += p[f"b{d}"]
            gates = _sigmoid(x[:, : 2 * h] + state @ U)
            z, r = gates[:, :h], gates[:, h:]
            rs = r * state
            candidate = np.tanh(x[:, 2 * h :] + rs @ V)
            if keep is not None:
                keep.append((t, state, z, r, rs, candidate))
            state = state + z * (candidate - state)
            out[t] = state
        return out

    def states(self, grams: np.ndarray) -> np.ndarray:
        """Hidden states of both directions, as of :meth:`run`, in place and with the halving of the gates' sums in the weights."""
        h = HIDDEN
        rows, steps, _ = grams.shape
        g = np.ascontiguousarray(grams.transpose(1, 2, 0))
        out = np.empty((steps, rows, 2 * h), np.float32)
        half = np.concatenate([np.full(2 * h, 0.5, np.float32), np.ones(h, np.float32)])
        sums, change, reset = np.empty((rows, 2 * h), np.float32), np.empty((rows, h), np.float32), np.empty((rows, h), np.float32)
        for n, d in enumerate("fb"):
            E, U, V = (self.p[f"E{d}"] + self.p[f"b{d}"] / PATCH) * half, self.p[f"U{d}"] * np.float32(0.5), self.p[f"V{d}"]
            state = np.zeros((rows, h), np.float32)
            for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
                x = E.take(g[t, 0], axis=0)
                for k in range(1, PATCH):
                    x += E.take(g[t, k], axis=0)
                np.matmul(state, U, out=sums)
                sums += x[:, : 2 * h]
                np.tanh(sums, out=sums)
                sums += 1
                sums *= 0.5
                np.multiply(sums[:, h:], state, out=reset)
                np.matmul(reset, V, out=change)
                change += x[:, 2 * h :]
                np.tanh(change, out=change)
                change -= state
                change *= sums[:, :h]
                state += change
                out[t, :, n * h : (n + 1) * h] = state
        return out

    def log_probabilities(self, grams: np.ndarray) -> np.ndarray:
        """(rows, steps, languages)."""
        states = self.states(grams)
        y = states @ self.p["W"] + self.p["c"]
        y -= y.max(axis=2, keepdims=True)
        y -= np.log(np.exp(y).sum(axis=2, keepdims=True))
        return y.transpose(1, 0, 2)

    def gradients(self, grams: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray], np.ndarray]:
        """Mean loss, and its gradients by backpropagation through time; labels are (rows, steps)."""
        p, h = self.p, HIDDEN
        kept = {"f": [], "b": []}
        states = np.concatenate([self.run(grams, d, kept[d]) for d in "fb"], axis=2)
        steps, rows, _ = states.shape
        y = states @ p["W"] + p["c"]
        y = np.exp(y - y.max(axis=2, keepdims=True))
        y /= y.sum(axis=2, keepdims=True)
        at = np.arange(steps)[:, None], np.arange(rows)[None, :], labels.T
        loss = float(-np.log(y[at] + 1e-9).mean())
        y[at] -= 1
        y /= steps * rows
        g = {"W": states.reshape(-1, 2 * h).T @ y.reshape(-1, y.shape[2]), "c": y.sum(axis=(0, 1))}
        back = y @ p["W"].T
        for d, part in (("f", back[:, :, :h]), ("b", back[:, :, h:])):
            gx = np.zeros((steps, rows, 3 * h), np.float32)
            gU, gV = np.zeros_like(p[f"U{d}"]), np.zeros_like(p[f"V{d}"])
            carry = np.zeros((rows, h), np.float32)
            for t, state, z, r, rs, candidate in reversed(kept[d]):
                carry = carry + part[t]
                g_candidate = carry * z * (1 - candidate * candidate)
                g_z = carry * (candidate - state) * z * (1 - z)
                g_rs = g_candidate @ p[f"V{d}"].T
                g_r = g_rs * state * r * (1 - r)
                g_gates = np.concatenate([g_z, g_r], axis=1)
                gV += rs.T @ g_candidate
                gU += state.T @ g_gates
                gx[t, :, : 2 * h], gx[t, :, 2 * h :] = g_gates, g_candidate
                carry = carry * (1 - z) + g_rs * r + g_gates @ p[f"U{d}"].T
            flat = gx.transpose(1, 0, 2).reshape(-1, 3 * h)
            gE = np.zeros_like(p[f"E{d}"])
            index = grams.reshape(-1)
            order = np.argsort(index, kind="stable")
            used, first = np.unique(index[order], return_index=True)
            gE[used] = np.add.reduceat(flat[order // PATCH], first, axis=0)
            g |= {f"E{d}": gE, f"b{d}": flat.sum(axis=0), f"U{d}": gU, f"V{d}": gV}
        return loss, g, y

    def train(self, texts: list[bytes], labels: list[int], iterations: int = ITERATIONS, batch: int = 96, steps: int = 24, seed: int = 11) -> float:
        """Adam over windows drawn alike from each language, half of which change to another text midway; returns the last losses' mean."""
        rng = np.random.default_rng(seed)
        grams = [_trigrams(np.frombuffer(t, np.uint8)) for t in texts]
        by = [[i for i, (g, l) in enumerate(zip(grams, labels)) if l == k and len(g) >= steps] for k in range(len(LANGUAGES))]
        kinds = [k for k, own in enumerate(by) if own]
        if not kinds:
            return 0.0
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        losses = []
        for n in range(1, iterations + 1):
            chosen = [by[k][rng.integers(len(by[k]))] for k in rng.choice(kinds, batch)]
            shift = [rng.integers(len(grams[i]) - steps + 1) for i in chosen]
            x = np.stack([grams[i][s : s + steps] for i, s in zip(chosen, shift)])
            own = np.repeat(np.array([labels[i] for i in chosen])[:, None], steps, axis=1)
            for r, cut in enumerate(rng.integers(1, steps, batch // 2).tolist()):
                x[r, cut:], own[r, cut:] = x[batch - 1 - r, cut:], own[batch - 1 - r, cut:]
            loss, g, _ = self.gradients(x, own)
            losses.append(loss)
            rate = 0.02 * min(1.0, n / 20) * (1 - n / (iterations + 1)) + 1e-4
            for k in self.p:
                m[k] += 0.1 * (g[k] - m[k])
                v2[k] += 0.01 * (g[k] * g[k] - v2[k])
                self.p[k] -= (rate * (m[k] / (1 - 0.9**n)) / (np.sqrt(v2[k] / (1 - 0.99**n)) + 1e-8)).astype(np.float32)
        return float(np.mean(losses[-20:]))


def labelled_sample(documents: DataFrame, doc_id: str, text: str, lang: str) -> list[tuple[bytes, int]]:
    """SAMPLE texts of each label at most: those with the least hashes, equal texts once; SAMPLE_BYTES from a place that the hash tells."""
    language = label_language(F.col(lang))
    known = documents.where(language.isNotNull() & (F.length(text) > 200)).select(language.alias("l"), F.col(text).alias("t"))
    sizes = {r[0]: r[1] for r in known.groupBy("l").count().collect()}
    if not sizes:
        return []
    hashed = known.withColumn("h", F.xxhash64("t"))
    # Below this share of the hashes' range lie about twice as many different texts as wanted, whatever the number of texts.
    counts = hashed.groupBy("l").agg(F.approx_count_distinct("h").alias("n"))
    share = F.create_map(*[F.lit(x) for r in counts.collect() for x in (r["l"], min(1.0, 2.0 * SAMPLE / r["n"]))])
    drawn = hashed.where(F.pmod("h", F.lit(1_000_003)) <= share[F.col("l")] * 1_000_003)
    start = F.lit(1) + F.pmod(F.shiftright("h", 20), F.greatest(F.lit(1), F.length("t") - SAMPLE_BYTES)).cast("int")
    part = drawn.groupBy("l", "h").agg(F.first(F.substring("t", start, F.lit(SAMPLE_BYTES))).alias("t"))
    taken = part.withColumn("n", F.row_number().over(Window.partitionBy("l").orderBy(F.pmod("h", F.lit(1_000_003)), "h"))).where(F.col("n") <= SAMPLE)
    rows = sorted((r["t"], r["l"]) for r in taken.collect())
    return [(text_bytes(t)[:SAMPLE_BYTES], LANGUAGES.index(l)) for t, l in rows]


_TRAINED: dict[str, Network] = {}


def trained(sample: list[tuple[bytes, int]]) -> Network:
    """A network trained twice: the second time without the documents whose label the first one contradicts in any part.

    The same sample, as of a second query over the same table, is trained once in a driver's process.
    """
    known = hashlib.sha256(b"\0".join(t + bytes([l]) for t, l in sample)).hexdigest()
    if known not in _TRAINED:
        first = Network()
        first.train([t for t, _ in sample], [l for _, l in sample], ITERATIONS // 2)
        kept = [(t, l) for t, l in sample if all(int(q.argmax()) == l for q in part_languages(first, t))]
        network = Network()
        network.train([t for t, _ in kept], [l for _, l in kept])
        _TRAINED.clear()
        _TRAINED[known] = network
    return _TRAINED[known]


def part_languages(network: Network, data: bytes, parts: int = 6) -> list[np.ndarray]:
    """Mean probabilities of the parts of a text, so that one in two languages doesn't pass for one."""
    p = np.exp(network.log_probabilities(_trigrams(np.frombuffer(data, np.uint8))[None])[0])
    return [q.mean(axis=0) for q in np.array_split(p, parts) if len(q)]


def label_positions(network: Network, datas: list[bytes]) -> np.ndarray:
    """Log probabilities (positions, languages) of the joined texts, each a whole number of patches."""
    joined = np.frombuffer(b"".join(d + b" " * (-len(d) % PATCH) for d in datas), np.uint8)
    grams = _trigrams(joined)
    n = len(grams)
    out = np.empty((n, len(LANGUAGES)), np.float32)
    rows = 1024
    for base in range(0, n, rows * STEPS):
        part = grams[base : base + rows * STEPS]
        size = len(part)
        part = np.concatenate([part, np.zeros((-size % STEPS, PATCH), np.int32)]).reshape(-1, STEPS, PATCH)
        out[base : base + size] = network.log_probabilities(part).reshape(-1, len(LANGUAGES))[:size]
    return out


def segment_all(documents: list[np.ndarray], costs: list[np.ndarray]) -> list[np.ndarray]:
    """Language of each word of each document: Viterbi over log probabilities with a cost for a change before each word."""
    out: list[np.ndarray] = [np.empty(0, np.int8)] * len(documents)
    order = sorted(range(len(documents)), key=lambda i: len(documents[i]))
    for base in range(0, len(order), 64):
        group = order[base : base + 64]
        sizes = np.array([len(documents[i]) for i in group])
        steps, kinds = int(sizes.max()), documents[group[0]].shape[1]
        words = np.zeros((steps, len(group), kinds), np.float32)  # nothing is added beyond a document's end
        cost = np.full((steps, len(group)), CHANGE_COST)
        for r, i in enumerate(group):
            words[: sizes[r], r] = documents[i]
            cost[: sizes[r], r] = costs[i]
        back = np.empty(words.shape, np.int8)
        same, rows = np.arange(kinds, dtype=np.int8), np.arange(len(group))
        score = words[0].astype(np.float64)
        for t in range(1, steps):
            best = score.argmax(axis=1)
            change = score[rows, best] - cost[t]
            stay = score >= change[:, None]
            back[t] = np.where(stay, same, best[:, None])
            score = np.maximum(score, change[:, None]) + words[t]
        path = np.empty((steps, len(group)), np.int8)
        path[-1] = score.argmax(axis=1)
        for t in range(steps - 1, 0, -1):
            path[t - 1] = back[t, rows, path[t]]
        for r, i in enumerate(group):
            out[i] = path[: sizes[r], r].copy()
    return out


def segments(network: Network, texts: list[str]) -> Iterator[list[tuple[str, int, int, float]]]:
    """For each text its segments (language, first word, words, confidence)."""
    group: list[str] = []
    size = 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size > 1_500_000:
            yield from _segments(network, group)
            group, size = [], 0
    if group:
        yield from _segments(network, group)


def _segments(network: Network, texts: list[str]) -> Iterator[list[tuple[str, int, int, float]]]:
    datas = [text_bytes(t) for t in texts]
    labels = label_positions(network, datas)
    np.maximum(labels, LEAST_LOG, out=labels)
    sizes = np.array([-(-len(d) // PATCH) for d in datas])
    begins = np.cumsum(sizes) - sizes
    sums = np.add.reduceat(labels, begins, axis=0, dtype=np.float64)
    mains = sums.argmax(axis=1)
    # No stretch can gain more by another language than all positions together; a word's edges count twice at most.
    gaps = labels.max(axis=1) - labels[np.arange(len(labels)), np.repeat(mains, sizes)]
    most = 2 * WORD_WEIGHT * np.add.reduceat(gaps, begins)
    shares = np.exp((sums - sums.max(axis=1, keepdims=True)) / sizes[:, None])
    sure = shares[np.arange(len(datas)), mains] / shares.sum(axis=1)
    found: list[list[tuple[str, int, int, float]]] = []
    mixed: list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
    for data, patches, base, main, gain, confidence in zip(datas, sizes.tolist(), begins.tolist(), mains.tolist(), most.tolist(), sure.tolist()):
        if gain <= MARK_COST:
            n = data.count(b" ") - 1 - data.count(b"\x01") if len(data) > 2 else 0
            found.append([(LANGUAGES[main], 0, n, confidence)] if n > 0 else [])
            continue
        own = labels[base : base + patches]
        b = np.frombuffer(data, np.uint8)
        starts = np.flatnonzero((b[1:] != 32) & (b[:-1] == 32)) + 1
        marks = b[starts] == MARK
        n = len(starts) - int(marks.sum())
        if not n:
            found.append([])
            continue
        ends = np.append(starts[1:], len(data)) - 1
        total = np.zeros((patches + 1, own.shape[1]), np.float64)
        np.cumsum(own, axis=0, out=total[1:])
        lo, hi = starts // PATCH, np.maximum(-(-ends // PATCH), starts // PATCH + 1)
        words = (total[hi] - total[lo]) * WORD_WEIGHT
        words[marks] = 0.0
        # A stretch of another language gains more than the cost of changing to it; without one the text has one language.
        gain = np.cumsum(words - words[:, main : main + 1], axis=0)
        rise = gain - np.minimum(np.minimum.accumulate(gain, axis=0), 0)
        if rise.max() <= MARK_COST:
            found.append([(LANGUAGES[main], 0, n, confidence)])
        else:
            mixed.append((len(found), words, total, lo, hi, marks))
            found.append([])
    costs = [np.where(np.concatenate(([False], marks[:-1])) | marks, MARK_COST, CHANGE_COST) for *_, marks in mixed]
    for (i, _, total, lo, hi, marks), path in zip(mixed, segment_all([m[1] for m in mixed], costs)):
        counted = np.concatenate(([0], np.cumsum(~marks)))
        cuts = (np.flatnonzero(np.diff(path)) + 1).tolist()
        for s, e in zip([0, *cuts], [*cuts, len(path)]):
            own = (total[hi[e - 1]] - total[lo[s]]) / max(hi[e - 1] - lo[s], 1)
            p = np.exp(own - own.max())
            k, size = int(path[s]), int(counted[e] - counted[s])
            if size:
                found[i].append((LANGUAGES[k], int(counted[s]), size, float(p[k] / p.sum())))
    yield from found


SEGMENTS = "doc_id bigint, label string, junk boolean, lang string, first_word int, words int, confidence double"


def document_languages(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", doubtful_only: bool = False) -> DataFrame:
    """Rows (doc_id, label, junk, lang, first_word, words, confidence): the segments of every document with letters.

    ``label`` is the language the label names, null when it names none. Null, blank and letterless texts have no row.
    Repeated rows come out repeated. ``junk`` tells texts without readable words, whose language means nothing.
    ``doubtful_only`` leaves out documents in one language that their label names.
    """
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(trained(labelled_sample(documents, doc_id, text, lang)))
    common = spark.sparkContext.broadcast(quality.common_words(documents, text))
    kinds = [pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.int32(), pa.int32(), pa.float64()]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, labels, texts = (b.column(k).to_pylist() for k in range(3))
            rows = []
            for i, label, t, found in zip(ids, labels, texts, segments(shared.value, texts)):
                if doubtful_only and len(found) == 1 and found[0][0] == label:
                    continue
                junk = bool(found) and quality.is_junk(t, common.value)
                rows += [(i, label, junk, *s) for s in found]
            columns = list(zip(*rows)) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[x.split()[0] for x in SEGMENTS.split(", ")])

    narrow = documents.where(F.col(text).rlike(r"\p{L}"))
    return narrow.select(F.col(doc_id).cast("bigint").alias("doc_id"), label_language(F.col(lang)).alias("label"), F.col(text).alias("text")).mapInArrow(scan, SEGMENTS)


def mislabelled(found: DataFrame) -> DataFrame:
    """Of segments: (doc_id, lang) of documents whose label is missing or wrong or that mix languages.

    A language counts in a mixed document from LEAST_WORDS consecutive words; a document without one that long has the
    language of most of its words, which contradicts a label only from LEAST_CONFIDENCE.
    """
    best = F.max(F.struct("words", "confidence", "lang"))
    per = found.where(~F.col("junk")).groupBy("doc_id", "label").agg(
        F.collect_set(F.when((F.col("words") >= LEAST_WORDS) & (F.col("confidence") >= LEAST_CONFIDENCE), F.col("lang"))).alias("long"), best.alias("best")
    )
    langs = F.when(F.size("long") > 0, F.col("long")).otherwise(F.array("best.lang"))
    sure = (F.size("long") > 0) | (F.col("best.confidence") >= LEAST_CONFIDENCE)
    wrong = F.col("label").isNull() | (F.size(langs) > 1) | ((langs[0] != F.col("label")) & sure)
    return per.where(wrong).select("doc_id", F.explode(langs).alias("lang")).distinct()
