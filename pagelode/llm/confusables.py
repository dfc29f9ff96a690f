"""Texts that look the same but differ in their characters (problem 4).

The skeleton of a text: decompose it, replace every character by its prototype from the look-alike table, decompose again.
Texts with equal skeletons look the same; the skeleton, composed, is the one consistent form of them all. A letter of
another alphabet is replaced only in a word whose other letters are Latin or look Latin too, but for fewer foreign ones than
there are Latin ones, so whole foreign words and the Greek signs of mathematics stay. Styled letters of mathematics are
plain letters, but for script, Fraktur and double-struck ones, which mean something else.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelode.llm.mojibake import shared_decoder
from pagelode.llm.text import FOREIGN, LOOKALIKES

SPACES = "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
HYPHENS = "\u2010\u2011\ufe63\uff0d"
INVISIBLE = "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180e\u200b-\u200f\u202a-\u202e\u2060-\u2064\u2066-\u206f\ufe00-\ufe0f\ufeff\U000e0000-\U000e007f"
_INVISIBLE = re.compile(f"[{INVISIBLE}]+")
#: Letters, digits and numerals that are ordinary ones in another width or style: their compatibility form is the ordinary one.
STYLED = "\uff01-\uffee\ufb00-\ufb06\ufb13-\ufb17\u2160-\u217f\U0001d400-\U0001d49b\U0001d5a0-\U0001d6a3\U0001d7ce-\U0001d7d7\U0001d7e2-\U0001d7ff"
_WIDE = re.compile(f"[{STYLED}]")
_PLAIN = {ord(c): " " for c in SPACES} | {ord(c): "-" for c in HYPHENS}
_CEDILLA = re.compile("([sStT])\u0327")
_WORD = re.compile("[^\\W\\d_\u0300-\u036f](?:[\u0300-\u036f]*[^\\W\\d_])*")
_SMALL_GREEK = re.compile("[\u03b1-\u03c9]+")
#: Only a text with one of these characters can differ from its consistent form.
CANDIDATES = f"[{SPACES}{HYPHENS}{INVISIBLE}{STYLED}\u0300-\u036f\u0162\u0163\u015e\u015f\u212a\u212b\u2126\u0400-\u058f\u13a0-\u13ff" + "".join(k for k in LOOKALIKES if k < "\u0400") + "]"
CANDIDATE = f"[\\x{{80}}-\\x{{10ffff}}&&{CANDIDATES}]"  #: the same for Java, where ASCII is ruled out by one comparison


def _latin(match: re.Match) -> str:
    word = match[0]
    foreign = FOREIGN.findall(word)
    other = sum(c not in LOOKALIKES for c in foreign)
    if other == len(foreign) or _SMALL_GREEK.fullmatch(word):
        return word
    if other and sum(map(str.isalpha, word)) - len(foreign) <= other:
        return word
    return "".join(LOOKALIKES.get(c, c) for c in word)


def skeleton(text: str) -> str:
    """The decomposed prototype of a text; texts with equal skeletons look the same."""
    if text.isascii():
        return text
    out = _INVISIBLE.sub("", unicodedata.normalize("NFD", text)).translate(_PLAIN)
    if _WIDE.search(out):
        out = _WIDE.sub(lambda m: unicodedata.normalize("NFKC", m[0]), out)
    out = unicodedata.normalize("NFD", out)  # a mark that followed an invisible or wide character joins its letter
    if FOREIGN.search(out):
        out = _WORD.sub(_latin, out)
    return unicodedata.normalize("NFD", _CEDILLA.sub("\\1\u0326", out))


def ordinary(text: str) -> str:
    """The consistent form: the composed skeleton."""
    return text if text.isascii() else unicodedata.normalize("NFC", skeleton(text))


def consistent(records: DataFrame, keys: list[str], text: str, words: dict[str, int] | None = None) -> DataFrame:
    """Rows (keys..., text, skeleton, ordinary, misread) of the records whose text isn't in its consistent form.

    Null and empty texts and texts in their consistent form have no row; repeated records come out repeated; other columns
    are ignored. ``misread`` tells texts that were read in a wrong encoding, by the word frequencies given: what looks odd
    in them is another trouble.
    """
    shared = records.sparkSession.sparkContext.broadcast(words or {})
    schema = pa.schema([(k, pa.string()) for k in [*keys, "text", "skeleton", "ordinary"]] + [("misread", pa.bool_())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = shared_decoder(shared)
        for b in batches:
            rows = []
            for *key, t in zip(*(c.to_pylist() for c in b.columns)):
                skel = skeleton(t)
                usual = unicodedata.normalize("NFC", skel)
                if usual != t:
                    rows.append((*key, t, skel, usual, bool(decoder.decode(t)[1])))
            columns = list(zip(*rows)) if rows else [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    narrow = records.where(F.col(text).rlike(CANDIDATE)).select(*[F.col(k).cast("string").alias(k) for k in keys], F.col(text).alias("text"))
    return narrow.mapInArrow(scan, ", ".join(f"{f.name} {'boolean' if f.name == 'misread' else 'string'}" for f in schema))


def classes(records: DataFrame, text: str) -> DataFrame:
    """Rows (ordinary, forms, records): the classes of originals with equal skeletons that have several forms.

    Equal originals are counted before the shuffle; a class is known by its consistent form.
    """
    counted = records.where(F.col(text).isNotNull()).groupBy(F.col(text).alias("text")).agg(F.count("*").alias("n"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([ordinary(t) for t in b.column(0).to_pylist()], pa.string()), b.column(1)], names=["ordinary", "n"])

    odd = counted.where(F.col("text").rlike(CANDIDATE)).mapInArrow(scan, "ordinary string, n bigint")
    plain = counted.where(~F.col("text").rlike(CANDIDATE)).select(F.col("text").alias("ordinary"), "n")
    return odd.unionAll(plain).groupBy("ordinary").agg(F.count("*").alias("forms"), F.sum("n").alias("records")).where(F.col("forms") > 1)
