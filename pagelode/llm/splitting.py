"""Oversized chunks cut at natural boundaries (problem 2).

Agglomerative merging: a text is first cut into atomic segments (clauses, or single words and runs of characters where
there are no clauses); adjacent pairs wait in a heap by the strength of the boundary between them; the weakest boundary
is merged first, as long as the merged piece with the words it repeats from before stays within the limits. What remains
are the strongest boundaries that the limits allow.

Only oversized rows leave the JVM, and each is cut on its own: the operator has no shuffle but the join that brings the
lines of a chunk's pages to it.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_WORDS = 220
MOST_CHARS = 2400
OVERLAP = 60
ATOM_WORDS = 20  #: words of an atomic segment at most
ATOM_CHARS = 300  #: characters from which an atomic segment ends at the next word
#: The white space that separates words, as Python has it.
SPACE = r"[\t-\r\x1c-\x20\x85\xa0  -     　]"

_WORD = re.compile(r"\S+")
_STOPS = re.compile(r"[.!?…][\"'”»)]*$")
_CLAUSE = re.compile(r"[,;:–—][\"'”»)]*$")
_JOINT = re.compile(r"[^\w](?=[\w])|_(?=[^\W_])")


def _atoms(text: str) -> list[tuple[int, int, int, float]]:
    """(start, end, first word, strength of the boundary before) of the atomic segments; they cover all but white space at cuts."""
    out: list[tuple[int, int, int, float]] = []
    words = list(_WORD.finditer(text))
    start = None
    first = held = 0
    strength = 0.0
    for n, m in enumerate(words):
        if start is None:
            start, first, held = m.start(), n, 0
        held += 1
        after = words[n + 1].start() if n + 1 < len(words) else len(text)
        gap = text[m.end() : after]
        cut = 6.0 if gap.count("\n") > 1 else 5.0 if _STOPS.search(m[0]) and "\n" in gap else 4.0 if _STOPS.search(m[0]) else 3.0 if "\n" in gap else 2.0 if _CLAUSE.search(m[0]) else 1.0
        if m.end() - m.start() > MOST_CHARS // 4:  # words that can't be told apart: cut at signs, then anywhere
            for s, e, joint in _pieces_of_word(m[0]):
                out.append((m.start() + s if s else start, m.start() + e, first if not s else n, strength if not s else joint))
            start, strength = None, cut
            continue
        if cut > 1.0 or held >= ATOM_WORDS or m.end() - start >= ATOM_CHARS or n + 1 == len(words) or words[n + 1].end() - words[n + 1].start() > MOST_CHARS // 4:
            out.append((start, m.end(), first, strength))
            start, strength = None, cut
    return out


def _pieces_of_word(word: str) -> Iterator[tuple[int, int, float]]:
    joints = [m.end() for m in _JOINT.finditer(word)]
    at, most = 0, MOST_CHARS // 12
    strength = 0.0
    while at < len(word):
        k = bisect_right(joints, at + most) - 1
        end = joints[k] if k >= 0 and joints[k] > at else min(at + most, len(word))
        end = len(word) if len(word) - at <= most else end
        yield at, end, strength
        strength = 0.9 if word[end - 2 : end - 1] in ".!?" or word[end - 1 : end] in ".!?" else 0.5 if k >= 0 and end == joints[k] else 0.1
        at = end


def pieces(text: str, most_words: int = MOST_WORDS, most_chars: int = MOST_CHARS, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """(start, end) of the pieces of a text, each within both limits and sharing ``overlap`` words with the one before.

    A text within the limits is one piece; of an oversized text without words the one piece is empty. Fewer words are shared
    only where the words before and the next segment together exceed the characters; where words can't be told apart,
    pieces share nothing.
    """
    words = [m.span() for m in _WORD.finditer(text)]
    if not words:
        return [(0, 0)] if len(text) > most_chars else []
    if len(words) <= most_words and len(text) <= most_chars:
        return [(0, len(text))]
    starts = [s for s, _ in words]
    atoms = _atoms(text)

    def begin(a: int) -> int:
        """Where the piece that begins with atom ``a`` begins, with the words repeated from before."""
        s, e, first, _ = atoms[a]
        if a == 0 or s != starts[first]:
            return s
        back = max(0, first - overlap)
        while back < first and e - starts[back] > most_chars:
            back += 1
        apart = [k for k in range(back, first) if words[k][1] - words[k][0] > most_chars // 4]  # such a word stands for many
        return starts[apart[-1] + 1 if apart else back]

    begins = [begin(a) for a in range(len(atoms))]

    def fits(a: int, b: int) -> bool:
        s, e = begins[a], atoms[b][1]
        return e - s <= most_chars and bisect_left(starts, e) - bisect_right(starts, s) + 1 <= most_words

    # Each piece is known by its first atom; last[a] is its last one, before[a] the first atom of the piece before it.
    n = len(atoms)
    last = list(range(n))
    before = [a - 1 for a in range(n)]
    alive = [True] * n
    heap = [(atoms[b][3], atoms[b][1] - atoms[b - 1][0], b - 1, b, b) for b in range(1, n)]
    heapq.heapify(heap)
    while heap:
        _, _, a, b, end = heapq.heappop(heap)
        if not alive[a] or not alive[b] or last[a] != b - 1 or last[b] != end or not fits(a, end):
            continue
        alive[b] = False
        last[a] = end
        if end + 1 < n:
            before[end + 1] = a
            heapq.heappush(heap, (atoms[end + 1][3], atoms[last[end + 1]][1] - atoms[a][0], a, end + 1, last[end + 1]))
        if a > 0:
            p = before[a]
            heapq.heappush(heap, (atoms[a][3], atoms[end][1] - atoms[p][0], p, a, end))
    return [(begins[a], atoms[last[a]][1]) for a in range(n) if alive[a]]


_LINE_ID = re.compile(r"\d+")


def _order(line_id: str) -> tuple[int, ...]:
    return tuple(map(int, _LINE_ID.findall(line_id)))


def line_spans(text: str, lines: list[tuple[str, str | None]], spans: list[tuple[int, int]]) -> list[tuple[str, str]]:
    """First and last line of each span of a text that was put together from ``lines`` (line_id, text), in order."""
    solid = [k for k, c in enumerate(text) if c.isalnum()]
    ends, stream = [], []
    total = 0
    for _, t in lines:
        bare = "".join(c for c in t or "" if c.isalnum())
        stream.append(bare)
        total += len(bare)
        ends.append(total)
    joined, own = "".join(stream), "".join(text[k] for k in solid)
    shift = joined.find(own)
    scale = 1.0
    if shift < 0:  # not the very lines: in proportion
        shift, scale = 0, total / max(len(own), 1)
    out = []
    for s, e in spans:
        a, b = bisect_left(solid, s), bisect_left(solid, e) - 1
        first = min(bisect_right(ends, int(a * scale) + shift), len(lines) - 1)
        final = min(bisect_right(ends, int(max(a, b) * scale) + shift), len(lines) - 1)
        out.append((lines[first][0], lines[max(first, final)][0]))
    return out


PIECES = "chunk_id string, manual_id string, piece int, text string, word_count int, start_line_id string, end_line_id string"


def oversized(chunks: DataFrame) -> DataFrame:
    """The distinct chunks whose text exceeds a limit; the recorded word count doesn't matter."""
    words = F.size(F.filter(F.split("text", SPACE + "+"), lambda w: w != ""))
    return chunks.select("chunk_id", "manual_id", "start_line_id", "end_line_id", "text").where((F.length("text") > MOST_CHARS) | (words > MOST_WORDS)).distinct()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.string(), pa.int32(), pa.string(), pa.int32(), pa.string(), pa.string()]
    for b in batches:
        rows = []
        for chunk_id, manual_id, start_id, end_id, text, own in zip(*(c.to_pylist() for c in b.columns)):
            spans = pieces(text)
            lines = {x["line_id"]: x["text"] for x in sorted(own or [], key=lambda x: (x["line_id"], x["ingested_at"] is not None, x["ingested_at"]))}
            if start_id and end_id and lines:
                lo, hi = _order(start_id), _order(end_id)
                ordered = sorted(((_order(k), k, t) for k, t in lines.items() if lo <= _order(k) <= hi), key=lambda x: x[:2])
            else:
                ordered = []
            ids = line_spans(text, [(k, t) for _, k, t in ordered], spans) if ordered else [(start_id, end_id)] * len(spans)
            for n, ((s, e), (first, final)) in enumerate(zip(spans, ids), 1):
                rows.append((chunk_id, manual_id, n, text[s:e], len(text[s:e].split()), first, final))
        columns = list(zip(*rows)) if rows else [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[x.split()[0] for x in PIECES.split(", ")])


def split_chunks(chunks: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Rows (chunk_id, manual_id, piece, text, word_count, start_line_id, end_line_id): the pieces of every oversized chunk.

    A blank oversized text has one empty piece. With ``lines``, each piece's first and last line come from the lines between the chunk's own first and last line, of
    which the latest ingested counts; without, or where none are found, they are the chunk's own. Null and empty texts and
    texts within the limits have no row; repeated chunks come out once; other columns are ignored.
    """
    big = oversized(chunks)
    if lines is None:
        return big.withColumn("own", F.lit(None).cast("array<struct<line_id:string,text:string,ingested_at:timestamp>>")).mapInArrow(_cut, PIECES)
    page = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^p(\\\\d+)', 1) AS int)")
    keys = big.select("chunk_id", "manual_id", F.xxhash64("text").alias("version"), page("start_line_id").alias("a"), page("end_line_id").alias("b")).where("a <= b")
    wanted = keys.select("chunk_id", "version", "manual_id", F.explode(F.sequence("a", "b")).alias("page")).withColumn("page_id", F.format_string("p%04d", "page"))
    held = lines.select("manual_id", "page_id", "line_id", "text", "ingested_at").join(wanted, ["manual_id", "page_id"])
    own = held.groupBy("chunk_id", "version").agg(F.collect_list(F.struct("line_id", "text", "ingested_at")).alias("own"))
    both = big.withColumn("version", F.xxhash64("text")).join(own, ["chunk_id", "version"], "left")
    return both.select("chunk_id", "manual_id", "start_line_id", "end_line_id", "text", "own").mapInArrow(_cut, PIECES)


def coverage(found: DataFrame) -> DataFrame:
    """Rows (chunk_id, words_md5, within_limits, least_shared) of chunks whose words can be told apart, by their pieces.

    The words are those of the pieces in order, without the ones that each shares with the piece before.
    """
    words = F.filter(F.split("text", SPACE + "+"), lambda w: w != "")
    own = found.select("chunk_id", F.struct("piece", words.alias("w"), ((F.length("text") <= MOST_CHARS) & (F.size(words) <= MOST_WORDS)).alias("ok")).alias("p"))
    each = own.groupBy("chunk_id").agg(F.sort_array(F.collect_list("p")).alias("p"))  # the pieces of one chunk
    joint = lambda x, y: F.slice(x["w"], -OVERLAP, OVERLAP) == F.slice(y["w"], 1, OVERLAP)
    shared = F.zip_with(F.slice("p", 1, F.size("p") - 1), F.slice("p", 2, F.size("p")), lambda x, y: F.when((F.size(x["w"]) >= OVERLAP) & joint(x, y), OVERLAP).otherwise(0))
    rest = F.flatten(F.transform("p", lambda x, n: F.when(n == 0, x["w"]).otherwise(F.slice(x["w"], OVERLAP + 1, F.greatest(F.size(x["w"]) - OVERLAP, F.lit(0))))))
    out = each.select("chunk_id", rest.alias("w"), F.forall("p", lambda x: x["ok"]).alias("within_limits"), F.coalesce(F.array_min(shared), F.lit(OVERLAP)).alias("least_shared"))
    return out.where(~F.exists("w", lambda w: F.length(w) > 30)).select("chunk_id", F.md5(F.array_join("w", " ")).alias("words_md5"), "within_limits", "least_shared")
