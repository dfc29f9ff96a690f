"""Text that was read in a wrong character encoding (problem 5).

Noisy-channel decoding. Each channel is one way in which text gets damaged: UTF-8 bytes read in an 8-bit code page
(once or twice), or an old font's code page read as Latin-1. For every word a byte lattice holds, for each channel, the
characters that its bytes can have been, with a wildcard where a byte was lost (U+FFFD). A Viterbi search finds the best
path through each lattice, from letter run to letter run, under the corpus's word frequencies: of a run's readings only
beginnings of known words are followed, so the number of wildcards doesn't matter; a lost letter that no known word tells
stays marked. A second search over the words of the text picks the channel of each word, with a cost for changing channel,
so that a foreign word that is right stays as it is.

Word frequencies are counted over all texts. The lexicon sent to the executors holds the words that at least
``LEXICON_SHARE`` of the texts hold: at most (mean words of a text / LEXICON_SHARE) words whatever the corpus's size.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import cached_property, lru_cache, reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEXICON_SHARE = 0.0001
LEXICON_LEAST = 3
CHANGE_COST = 1.0  #: of another channel than the word before
CHANNEL_COST = 0.7  #: of a word that isn't taken as it stands
CAPITAL_COST = 0.3  #: of each capital letter that a reading brings in
STRICT_GAIN = 3.0  #: for each whole UTF-8 sequence, which chance hardly makes

CODE_PAGES = ("cp1252", "cp1250", "iso8859-2", "mac_roman", "cp850", "cp437", "cp852", "cp1251", "koi8-r", "cp1253")
OTHER_ALPHABETS = ("cp1251", "koi8-r", "cp1253")  #: their letters are right in foreign words: only USUAL characters are read from them
# What old fonts and code pages show for Romanian letters.
OLD_FONT = {"ã": "ă", "Ã": "Ă", "þ": "ț", "Þ": "Ț", "º": "ș", "ª": "Ș"}
OLD_FONT_2 = OLD_FONT | {"æ": "ț", "Æ": "Ț", "ç": "ș", "Ç": "Ș"}
# Characters that a sequence with a lost byte may have been.
WILD_TARGETS = "ăâîșțĂÂÎȘȚ„”–—…’·²³°º→∈√∫∪≤≥ΔΣΠαβγδθλμπφω"

USUAL = frozenset(WILD_TARGETS + "şţŞŢ“‘’•«»\u00a0")

_C1 = {chr(b): bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0)}


def _bytes_of(page: str) -> dict[str, int]:
    out = {chr(b): b for b in range(0x80, 0xA0)}
    for b in range(0x80, 0x100):
        c = bytes([b]).decode(page, "ignore")
        if c:
            out[c] = b
    return out


BYTES = {page: _bytes_of(page) for page in CODE_PAGES} | {"latin-1": {chr(b): b for b in range(0x80, 0x100)}}
LOST = "�"
#: A text without any of these characters has nothing to decode (the same class for Java and Python).
_ALONE = "[\\u0080-\\u009f¡-±´-¶¸-ÁÃ-ÍÏ-áã-íï-ÿƒŒœŠšŽžŸČčĎďŁłŤąˆ˜˘ˇ˛‘’“†‡•‰‹›€™\\u2500-\\u259f]"
# First bytes of UTF-8 sequences as Windows' Cyrillic page shows them, and the bytes after (but for quotes, dots and dashes).
_CYRILLIC_TRAILS = "".join(c for b in range(0x80, 0xC0) if (c := bytes([b]).decode("cp1251", "ignore")) and c not in "„…–—”’“‘«»")
_PAIRS = f"[ÂÎĂ][\\u00a0²³·”„–—…\\ufffd]|â\\ufffd|[ГДЕИв][{_CYRILLIC_TRAILS}]"
#: The same for Java, where a character below U+0080 is ruled out by one comparison.
SUSPICIOUS = f"[\\x{{80}}-\\x{{10ffff}}&&{_ALONE}]|{_PAIRS}"
_SEEN_ALONE, _SEEN_LEADS, _SEEN_PAIRS = re.compile(_ALONE).search, re.compile("[ÂÎĂ\ufffdГДЕИв]").search, re.compile(_PAIRS).search


def suspicious(text: str) -> bool:
    """Whether SUSPICIOUS finds anything; single classes are searched much faster than alternatives."""
    return bool(_SEEN_ALONE(text) or _SEEN_LEADS(text) and _SEEN_PAIRS(text))


_LETTER = r"[^\W\d_²³¹⁰-₉¼-¾]"
UNITS = re.compile(rf"{_LETTER}*(?:�{_LETTER}*)+|{_LETTER}+|[^\x00-\x7f]")
_IS_LETTER = re.compile(_LETTER).match
_SIGN_LOST = re.compile(r"(?:^|(?<=[^\w�]))â�")  #: no word begins with â: it was the first byte of a sign
_MODERN = str.maketrans("şţŞŢ", "șțȘȚ")
_WILD = [(c.encode(), c) for c in WILD_TARGETS]


def _length(lead: int) -> int:
    return 2 if 0xC2 <= lead <= 0xDF else 3 if 0xE0 <= lead <= 0xEF else 4 if 0xF0 <= lead <= 0xF4 else 0


def lattice(word: str, page: str) -> tuple[list[tuple[str, ...]], int, int] | None:
    """What each stretch of a word can have been, the number of whole sequences and of those with lost bytes; None if there is none."""
    table = BYTES[page]
    out: list[tuple[str, ...]] = []
    strict = wild = i = 0
    while i < len(word):
        lead = 0 if word[i] == "\u00a0" else table.get(word[i], 0)
        n = _length(lead)
        if n and i + n <= len(word):
            rest = [-1 if c == LOST else table.get(c, 0) for c in word[i + 1 : i + n]]
            if all(b == -1 or 0x80 <= b <= 0xBF for b in rest):
                if -1 not in rest:
                    try:
                        c = bytes([lead, *rest]).decode()
                        if page in OTHER_ALPHABETS:
                            usual = c in USUAL
                        else:
                            usual = c < "\u0250" or "\u0370" <= c <= "\u04ff" or "\u1e00" <= c <= "\u22ff" or c in "\ufeff\ufffd\ufb01\ufb02"
                        if usual:  # else chance: texts of Latin, Greek and Cyrillic letters and signs are expected
                            out.append((c,))
                            strict += 1
                            i += n
                            continue
                    except UnicodeDecodeError:
                        pass
                elif options := tuple(c for b, c in _WILD if len(b) == n and b[0] == lead and all(x in (-1, y) for x, y in zip(rest, b[1:]))):
                    out.append(options)
                    wild += 1
                    i += n
                    continue
        out.append((word[i],))
        i += 1
    return (out, strict, wild) if strict or wild else None


def _better(a: tuple[float, tuple] | None, b: tuple[float, tuple]) -> tuple[float, tuple]:
    return b if a is None or b[0] > a[0] else a


_LAST: list[Decoder] = []


def shared_decoder(shared) -> Decoder:
    """The decoder of a broadcast lexicon, made once in each Python worker."""
    if not _LAST or _LAST[0].lexicon is not shared.value:
        _LAST[:] = [Decoder(shared.value)]
    return _LAST[0]


class Decoder:
    """Decodes texts under word frequencies."""

    def __init__(self, lexicon: dict[str, int]):
        self.lexicon = lexicon
        total = sum(lexicon.values()) + 1.0
        self.score = {w: math.log(n / total) for w, n in lexicon.items()}
        self.unknown = math.log(0.3 / total)
        self.options = lru_cache(maxsize=200_000)(self._options)

    def likelihood(self, word: str) -> float:
        get, unknown = self.score.get, self.unknown
        return sum(get(u, unknown) for u in UNITS.findall(word.translate(_MODERN).lower()))

    @cached_property
    def beginnings(self) -> frozenset[str]:
        return frozenset(w[:k] for w in self.score for k in range(1, len(w) + 1))

    def best(self, parts: list[tuple[str, ...]], capital: float = CAPITAL_COST) -> tuple[float, str]:
        """The likeliest reading of a lattice, less ``capital`` for each capital letter that isn't ASCII."""
        if all(len(p) == 1 for p in parts):
            reading = "".join(p[0] for p in parts)
            return self.likelihood(reading) - capital * sum(c > "\x7f" and c.isupper() for c in reading), reading
        cost = lambda c: capital * (c > "\x7f" and c.isupper())
        letters = [tuple(c for c in p if c == LOST or _IS_LETTER(c)) for p in parts]
        signs = [tuple(c for c in p if c != LOST and not _IS_LETTER(c)) for p in parts]
        n = len(parts)
        # Best (value, trail) up to each place, the last character a sign (or none) and a letter: runs of letters never touch.
        after_sign: list[tuple[float, tuple] | None] = [(0.0, ())] + [None] * n
        after_run: list[tuple[float, tuple] | None] = [None] * (n + 1)
        for i in range(n):
            ends = [x for x in (after_sign[i], after_run[i]) if x is not None]
            if ends and signs[i]:
                value, trail = max(ends, key=lambda x: x[0])
                gain, c = max((-cost(c) + (self.score.get(c, self.unknown) if c > "\x7f" else 0.0), c) for c in signs[i])
                after_sign[i + 1] = _better(after_sign[i + 1], (value + gain, (trail, c)))
            if after_sign[i] is None or not letters[i]:
                continue
            value, trail = after_sign[i]
            known = {"": (0.0, "")}  # beginnings of known words, with their cost and reading
            unknown, plain = self.unknown, ""
            for j in range(i, n):
                if not letters[j]:
                    break
                longer: dict[str, tuple[float, str]] = {}
                for key, (spent, reading) in known.items():
                    for c in letters[j]:
                        k = key + c.translate(_MODERN).lower()
                        if k in self.beginnings and ((old := longer.get(k)) is None or old[0] < spent - cost(c)):
                            longer[k] = (spent - cost(c), reading + c)
                known = longer
                only = letters[j][0] if len(letters[j]) == 1 else LOST
                unknown, plain = unknown - cost(only), plain + only
                if j + 1 == n or signs[j + 1]:
                    after_run[j + 1] = _better(after_run[j + 1], (value + unknown, (trail, plain)))
                    for key, (spent, reading) in known.items():
                        if key in self.score:
                            after_run[j + 1] = _better(after_run[j + 1], (value + spent + self.score[key], (trail, reading)))
        value, trail = max((x for x in (after_sign[n], after_run[n]) if x is not None), key=lambda x: x[0])
        out = []
        while trail:
            trail, c = trail
            out.append(c)
        return value, "".join(reversed(out))

    def _readings(self, word: str) -> Iterator[tuple[str, str, float]]:
        """(channel, reading, value) of a word, but for the word as it stands."""
        for page in BYTES:
            if (found := lattice(word, page)) is None:
                continue
            parts, strict, _ = found
            value, reading = self.best(parts)
            yield page, reading, value + STRICT_GAIN * strict
            if page == "cp1252":
                once = "".join(p[0] if len(p) == 1 else LOST for p in parts)
                if again := lattice(once, page):
                    value, reading = self.best(again[0], 0.0)
                    yield "cp1252 twice", reading, value + STRICT_GAIN * (strict + again[1])
        if _SIGN_LOST.search(word):
            reading = _SIGN_LOST.sub(LOST, word)
            yield "cp1252", reading, self.likelihood(reading) + STRICT_GAIN
        for name, table in (("control", _C1), ("old font", OLD_FONT | _C1), ("old font 2", OLD_FONT_2 | _C1)):
            reading = "".join(table.get(c, c) for c in word)
            if reading != word:
                yield name, reading, self.likelihood(reading)

    def _options(self, word: str) -> dict[str, tuple[float, str]]:
        """The best reading of a word by each channel; '' is the word as it stands."""
        out = {"": (self.likelihood(word), word)}
        for channel, reading, value in self._readings(word):
            if channel not in out or value - CHANNEL_COST > out[channel][0]:
                out[channel] = (value - CHANNEL_COST, reading)
        return out

    def decode(self, text: str) -> tuple[str, tuple[str, ...]]:
        """The text as it was, and the channels that damaged it (none: it is right)."""
        if not suspicious(text):
            return text, ()
        parts = re.split(r"([ \t-\r]+)", text)
        at = [k for k in range(0, len(parts), 2) if not parts[k].isascii()]
        best: dict[str, tuple[float, tuple]] = {"": (0.0, ())}
        for k in at:
            options = self.options(parts[k]) if suspicious(parts[k]) else {"": (0.0, parts[k])}
            if len(options) == 1 and len(best) == 1 and "" in best:
                continue
            top = max(best.items(), key=lambda x: x[1][0])
            new = {}
            for channel, (value, reading) in options.items():
                stay, move = best.get(channel), top[1]
                base, trail = stay if stay is not None and stay[0] >= move[0] - CHANGE_COST else (move[0] - CHANGE_COST * (top[0] != channel), move[1])
                new[channel] = (base + value, (trail, k, channel, reading) if channel else trail)
            best = new
        trail = max(best.values(), key=lambda x: x[0])[1]
        channels = set()
        while trail:
            trail, k, channel, reading = trail
            if reading != parts[k]:
                parts[k] = reading
                channels.add(channel)
        return "".join(parts), tuple(sorted(channels))


def strict_decode(text: str) -> str:
    """The text with whole wrongly read UTF-8 sequences restored, without a lexicon: for comparisons only."""
    if not suspicious(text):
        return text
    best, most = text, 0
    for page in BYTES:
        if (found := lattice(text, page)) and found[1] + found[2] > most:
            best, most = "".join(p[0] for p in found[0]), found[1] + found[2]
    return best.translate(_FONT) if most == 0 else best


_FONT = str.maketrans(OLD_FONT)


def lexicon(texts: list[DataFrame]) -> dict[str, int]:
    """Words and signs with how many texts hold them, of tokens (words with the signs about them) apart; those that at least
    LEXICON_SHARE of all texts hold. Each frame has one text column.

    Texts are split at ASCII blanks and signs and their tokens counted; only the distinct tokens are taken apart.
    """
    every = reduce(DataFrame.unionAll, [d.toDF("text") for d in texts]).where(F.col("text").isNotNull())
    n = every.count()
    tokens = every.select(F.explode(F.array_distinct(F.split(F.lower("text"), r"[\x00-`{-\x7f]+"))).alias("t")).groupBy("t").agg(F.count("*").alias("n"))
    units = tokens.select(F.explode(F.array_distinct(F.regexp_extract_all(F.translate("t", "şţ", "șț"), F.lit(r"\p{L}+|[^\p{L}\x00-\x7f]"), 0))).alias("u"), "n")
    counted = units.groupBy("u").agg(F.sum("n").alias("n"))
    return {r[0]: r[1] for r in counted.where(F.col("n") >= max(LEXICON_LEAST, n * LEXICON_SHARE)).collect()}


def decoded(records: DataFrame, words: dict[str, int], keys: list[str], text: str) -> DataFrame:
    """Rows (keys..., text, restored, channels) of the records whose text was read in a wrong encoding.

    Null, empty and right texts have no row; repeated records come out repeated; other columns are ignored. The keys
    are cast to strings.
    """
    shared = records.sparkSession.sparkContext.broadcast(words)
    schema = pa.schema([(k, pa.string()) for k in keys] + [("text", pa.string()), ("restored", pa.string()), ("channels", pa.string())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = shared_decoder(shared)
        for b in batches:
            rows = []
            for *key, t in zip(*(c.to_pylist() for c in b.columns)):
                restored, channels = decoder.decode(t)
                if channels:
                    rows.append((*key, t, restored, ", ".join(channels)))
            columns = list(zip(*rows)) if rows else [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], schema=schema)

    narrow = records.where(F.col(text).rlike(SUSPICIOUS)).select(*[F.col(k).cast("string").alias(k) for k in keys], F.col(text).alias("text"))
    return narrow.mapInArrow(scan, ", ".join(f"{f.name} string" for f in schema))
