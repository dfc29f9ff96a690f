"""Lines that come back on many pages of one manual (problem 3).

Each line is brought to a masked form: look-alike characters, case, spacing and punctuation don't count, the page's own
printed number becomes a mark and every other number a placeholder, while the numbers themselves stay aside as content.
Names aren't masked: lines that differ in a name are different lines to a reader.

Within a manual, lines with the same numbers are clustered by locality-sensitive hashing of their forms:

* forms of ``LONG`` letters and more by MinHash over letter trigrams, in bands; those that share a bucket with another form
  go on to the next step, and each is compared with the most frequent form of its buckets by edit distance (one slip for
  every ``SLIP`` letters);
* these and all forms up to that length by the hashes of the form without any one of its letters. Two forms that are one slip apart
  (a letter changed, missing, added, or swapped with its neighbour) always share such a bucket.

Clusters are the connected components of these links; one that stands on at least ``LEAST_PAGES`` pages is boilerplate.

No group of lines is ever gathered: pages are counted by partial aggregation, each bucket links its forms to one of them, and
components come from rounds of joins until nothing changes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelode.llm.mojibake import strict_decode
from pagelode.llm.text import fold
from pagelode.session import cut_lineage, written

LEAST_PAGES = 6
BANDS, ROWS = 16, 3
LONG = 24  #: letters from which forms are hashed by trigrams
SLIP = 12  #: letters of a long form for each of which one slip is forgiven
SHORT = 5  #: letters of the shortest form that may lose one in a slip

_TOKEN = re.compile(r"[\divxlc](?:(?<=\d)\d*(?:[.,:/]\d+)*|(?<![^\W_][ivxlc])[ivxlc]*(?![^\W_]))")
_DROPPED = bytes(c for c in range(128) if not (97 <= c <= 122 or c in b"0#"))
_SIGNS = re.compile("[\u0080-\u00bf\u2010-\u2bff\u3000-\u303f\ufffd]+")
_ROMAN = ((100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i"))


def roman(n: int) -> str:
    out = ""
    for value, sign in _ROMAN:
        out += sign * (n // value)
        n %= value
    return out


#: Only a well-formed numeral is a number; a single c or l is rather a letter, or what a slip left of a word.
ROMAN = frozenset(map(roman, range(1, 400))) - {"c", "l"}


@lru_cache(maxsize=100_000)
def own_numbers(page: int | None, offset: int | None) -> frozenset[str]:
    """How a page's own number may be printed."""
    if page is None:
        return frozenset()
    if offset is None:
        return frozenset((str(page), roman(page)))
    return frozenset((str(page - offset) if page > offset else roman(page),))


def masked(text: str, page: int | None, offset: int | None) -> tuple[str, str]:
    """The form of a line and its numbers, of which the page's own printed one is only a mark in the form."""
    numbers: list[str] = []
    own = own_numbers(page, offset)

    def mask(m: re.Match) -> str:
        token = m[0]
        if token in own:
            return "#"
        if token[0] in "ivxlc" and token not in ROMAN:
            return token
        numbers.append(token)
        return "0"

    form = _TOKEN.sub(mask, fold(strict_decode(text))).encode("utf-8", "replace").translate(None, _DROPPED).decode()
    if not form.isascii():
        form = _SIGNS.sub("", form)
    return form or re.sub(r"\s+", "", text), " ".join(numbers)


def _content(manual_id: str | None, numbers: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{manual_id}\n{numbers}") - 2**63


def page_offsets(pages: DataFrame) -> DataFrame:
    """(manual_id, offset): the distance between pdf_page_number and the printed number, as on most of a manual's pages."""
    printed = F.expr("try_cast(page_label AS int)")
    distance = (F.col("pdf_page_number") - printed).alias("offset")
    counted = pages.where(printed.isNotNull()).groupBy("manual_id", distance).agg(F.count("*").alias("n"))
    return counted.groupBy("manual_id").agg(F.max_by("offset", F.struct("n", -F.col("offset"))).alias("offset"))


FORMS = "manual_id string, page_id string, line_id string, form string, content bigint"


def masked_lines(lines: DataFrame, pages: DataFrame) -> DataFrame:
    """Rows (manual_id, page_id, line_id, form, content, fid) of all lines with text.

    ``content`` is a hash of the manual and the numbers, ``fid`` one of the form: within a manual, 64 bits each.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both = [masked(t, p, o) for t, p, o in zip(*(b.column(k).to_pylist() for k in (3, 4, 5)))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array([x for x, _ in both], pa.string()), pa.array(list(map(_content, b.column(0).to_pylist(), (x for _, x in both))), pa.int64())],
                names=["manual_id", "page_id", "line_id", "form", "content"],
            )

    text = lines.where(F.col("text").rlike(r"[^\s\x{a0}]")).select("manual_id", "page_id", "line_id", "text", "pdf_page_number")
    scanned = text.join(page_offsets(pages), "manual_id", "left").select("manual_id", "page_id", "line_id", "text", "pdf_page_number", "offset").mapInArrow(scan, FORMS)
    return scanned.withColumn("fid", F.xxhash64("form"))


def _min_hashes(forms: list[str]) -> np.ndarray:
    """(BANDS, forms): a hash of ROWS MinHashes of each form's trigrams."""
    datas = [f"^{f}$".encode() + (b"  " if len(f) < 2 else b"") for f in forms]
    joined = np.frombuffer(b"".join(datas), np.uint8).astype(np.uint64)
    grams = joined[:-2] << np.uint64(16) | joined[1:-1] << np.uint64(8) | joined[2:]
    sizes = np.array([len(d) for d in datas])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    inside = np.ones(len(grams), bool)
    for back in (1, 2):
        cut = ends[:-1] - back
        inside[cut[(cut >= 0) & (cut < len(grams))]] = False
    seeds = np.random.default_rng(5).integers(1, 2**62, size=(BANDS * ROWS, 2), dtype=np.uint64) | np.uint64(1)
    out = np.zeros((BANDS, len(forms)), np.uint64)
    for k, (a, c) in enumerate(seeds):
        h = grams * a
        h = (h ^ (h >> np.uint64(29))) * c
        h[~inside] = np.uint64(2**64 - 1)
        out[k // ROWS] = out[k // ROWS] * np.uint64(1000003) + np.minimum.reduceat(h, starts)
    return out


_POWER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_POWER), -1, 2**64))


def _without_one(forms: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the form, hash) of each form and of each form without one letter; marks and placeholders of numbers stay.

    Forms of fewer than SHORT letters have only the first. A form's hash is the sum of its letters' hashes times the powers of an odd number, so that a letter's removal shifts the
    rest by one power.
    """
    sizes = np.array([len(f) for f in forms])
    flat = np.frombuffer("".join(forms).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    letters = (flat + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    letters ^= letters >> np.uint64(31)
    letters *= np.uint64(0x94D049BB133111EB)
    letters ^= letters >> np.uint64(29)
    powers = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(int(sizes.max(initial=0)), _POWER))), dtype=np.uint64)
    owner = np.repeat(np.arange(len(forms)), sizes)
    first = np.cumsum(sizes) - sizes
    terms = letters * powers[np.arange(len(flat)) - first[owner]]
    run = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))
    start, whole = run[first], run[first + sizes] - run[first]
    before = run[:-1] - start[owner]
    left = before + (whole[owner] - before - terms) * _INVERSE
    kept = (flat != ord("#")) & (flat != ord("0"))
    kept &= np.bincount(owner[kept], minlength=len(forms))[owner] >= SHORT
    hashes = np.concatenate((whole, left[kept]))
    return np.concatenate((np.arange(len(forms)), owner[kept])), hashes ^ (hashes >> np.uint64(32))


def _keyed(forms: DataFrame, long: bool) -> DataFrame:
    """Rows (content, fid, n_pages, key): the buckets of forms, MinHash bands of long ones or hashes without one letter."""
    schema = "content bigint, fid bigint, n_pages bigint, key bigint"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            texts = b.column(3).to_pylist()
            if long:
                hashes = _min_hashes(texts) * np.uint64(64) + np.arange(BANDS, dtype=np.uint64)[:, None]
                owner, keys = np.tile(np.arange(len(texts)), BANDS), hashes.ravel()
            else:
                owner, keys = _without_one(texts)
            taken = pa.array(owner)
            yield pa.RecordBatch.from_arrays([*(b.column(k).take(taken) for k in range(3)), pa.array(keys.view(np.int64))], names=["content", "fid", "n_pages", "key"])

    return forms.select("content", "fid", "n_pages", "form").mapInArrow(scan, schema)


def _leads(keyed: DataFrame) -> DataFrame:
    """Distinct (content, fid, lead): each form of a bucket with the bucket's most frequent one."""
    leaders = keyed.groupBy("content", "key").agg(F.max(F.struct("n_pages", "fid")).alias("l"), F.min("fid").alias("a"), F.max("fid").alias("b")).where("a <> b").select("content", "key", F.col("l.fid").alias("lead"))
    return keyed.join(leaders, ["content", "key"]).where("fid <> lead").select("content", "fid", "lead").distinct()


def links(forms: DataFrame) -> DataFrame:
    """Distinct (content, fid, lead): forms that are the same line but for slips. ``forms`` has (content, fid, form, n_pages)."""
    letters = F.length(F.translate("form", "#0", ""))
    long = F.length("form") >= LONG
    near = cut_lineage(_leads(_keyed(forms.where(long), True)))
    ends = near.select("content", "fid").union(near.select("content", F.col("lead").alias("fid"))).distinct()
    one = _leads(cut_lineage(_keyed(forms.where((F.length("form") <= LONG) & (letters >= SHORT - 1)).unionByName(forms.join(ends, ["content", "fid"], "leftsemi")), False)))
    texts = forms.select("content", "fid", "form")
    both = near.join(texts, ["content", "fid"]).join(texts.select("content", F.col("fid").alias("lead"), F.col("form").alias("other")), ["content", "lead"])
    both = both.withColumn("slips", F.floor(F.length("form") / SLIP).cast("int")).where(F.abs(F.length("form") - F.length("other")) <= F.col("slips"))
    mark = lambda c: F.concat(F.substring(c, 1, 1) == "#", F.substring(c, -1, 1) == "#")  # noqa: E731  a number before isn't one behind
    slipped = both.where((mark("form") == mark("other")) & F.expr("levenshtein(form, other, slips) >= 0"))
    return one.union(slipped.select("content", "fid", "lead")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(content, fid, root): of each form with a link the least form that links lead to.

    Rounds of large and small stars (each form's neighbours above it, then below it, are linked to the least of them) until
    nothing changes.
    """
    pairs = cut_lineage(edges.select("content", F.greatest("fid", "lead").alias("u"), F.least("fid", "lead").alias("v")).distinct())
    seen = None
    while seen != (seen := pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("content", "u", "v"))).first()) and seen[0]:
        around = pairs.union(pairs.select("content", F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("content", "u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = around.join(least, ["content", "u"]).where("v > u").select("content", F.col("v").alias("u"), F.col("m").alias("v"))
        below = large.groupBy("content", "u").agg(F.min("v").alias("m"))
        small = large.join(below, ["content", "u"]).select("content", F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v")
        pairs = cut_lineage(small.distinct())
    return pairs.select("content", F.col("u").alias("fid"), F.col("v").alias("root")).union(pairs.select("content", F.col("v").alias("fid"), F.col("v").alias("root"))).distinct()


def repeated_lines(lines: DataFrame, pages: DataFrame, least: int = LEAST_PAGES) -> DataFrame:
    """Rows (manual_id, page_id, line_id, cluster): the lines that stand on at least ``least`` pages of their manual.

    ``cluster`` is the most frequent form. Null and blank lines never count; rows sent twice and several copies on one page
    count as one page; lines without a manual are left out; a manual without pages rows has the page's number or its Roman
    form as its own. Two forms of fewer than ``SHORT`` letters forgive no slip. Other columns are ignored.
    """
    folded = written(masked_lines(lines.where(F.col("manual_id").isNotNull()), pages))
    spread = folded.select("content", "page_id").distinct().groupBy("content").count().where(F.col("count") >= least).select("content")
    standing = cut_lineage(folded.select("content", "fid", "form", "page_id").join(spread, "content", "leftsemi").distinct())
    forms = cut_lineage(standing.groupBy("content", "fid", "form").agg(F.count("*").alias("n_pages")))
    linked = components(links(forms))
    rooted = cut_lineage(linked.join(forms, ["content", "fid"]))
    named = rooted.groupBy("content", "root").agg(F.max_by("form", F.struct("n_pages", "form")).alias("cluster"))
    held = standing.select("content", "fid", "page_id").join(rooted.select("content", "fid", "root"), ["content", "fid"]).select("content", "root", "page_id").distinct()
    wide = held.groupBy("content", "root").count().where(F.col("count") >= least).join(named, ["content", "root"]).join(rooted.select("content", "root", "fid"), ["content", "root"])
    alone = forms.where(F.col("n_pages") >= least).join(rooted.select("content", "fid"), ["content", "fid"], "left_anti")
    found = cut_lineage(wide.select("content", "fid", "cluster").union(alone.select("content", "fid", "form")))
    return folded.select("manual_id", "page_id", "line_id", "content", "fid").join(found, ["content", "fid"]).select("manual_id", "page_id", "line_id", "cluster").distinct()


def without_repeated(lines: DataFrame, found: DataFrame) -> DataFrame:
    """The lines of ``lines`` that aren't repeated."""
    return lines.join(found.select("manual_id", "line_id").distinct(), ["manual_id", "line_id"], "left_anti")
