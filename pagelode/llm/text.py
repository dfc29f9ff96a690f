"""Folding of text to a comparison form, shared by the operators of this package."""

from __future__ import annotations

import re
import unicodedata
from functools import cache

# Letters of other alphabets that look like a Latin letter, and that letter.
CYRILLIC_LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "к": "k", "і": "i", "ѕ": "s", "ј": "j", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w", "ӏ": "l", "ү": "y", "ѵ": "v",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "І": "I", "Ѕ": "S", "Ј": "J", "Ү": "Y", "Ӏ": "I", "Ѵ": "V", "Ԍ": "G", "Ԛ": "Q", "Ԝ": "W",
}
GREEK_LOOKALIKES = {
    "ο": "o", "ν": "v", "ϲ": "c", "ϳ": "j",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J",
}
ARMENIAN_LOOKALIKES = {"օ": "o", "ո": "n", "ս": "u", "հ": "h", "ց": "g", "զ": "q", "Տ": "S", "Օ": "O", "Լ": "L", "Ս": "U"}
CHEROKEE_LOOKALIKES = {
    "Ꭰ": "D", "Ꭱ": "R", "Ꭲ": "T", "Ꭺ": "A", "Ꭻ": "J", "Ꭼ": "E", "Ꮃ": "W", "Ꮇ": "M", "Ꮋ": "H", "Ꮐ": "G", "Ꮓ": "Z", "Ꮟ": "b", "Ꮩ": "V", "Ꮪ": "S", "Ꮮ": "L", "Ꮯ": "C", "Ꮲ": "P", "Ꮶ": "K", "Ᏼ": "B",
}
LOOKALIKES = CYRILLIC_LOOKALIKES | GREEK_LOOKALIKES | ARMENIAN_LOOKALIKES | CHEROKEE_LOOKALIKES
PLAIN_LETTERS = (("ă", "a"), ("â", "a"), ("î", "i"), ("ș", "s"), ("ț", "t"))  #: the letters that most texts here hold

FOREIGN = re.compile("[Ͱ-֏Ꭰ-᏿]")
MARKS = re.compile("[̀-ͯ­͏؜ᅟᅠ឴឵᠎​-‏‪-‮⁠-⁤⁦-⁯︀-️﻿]+")
_ALIKE = re.compile("[" + "".join(LOOKALIKES) + "]")


def _folded(text: str) -> str:
    out = MARKS.sub("", unicodedata.normalize("NFKD", text))
    if _ALIKE.search(out):
        out = _ALIKE.sub(lambda m: LOOKALIKES[m[0]], out)
    return out.casefold()


@cache
def _changing() -> re.Pattern:
    """Any character that folding changes, but for ASCII and the plain letters."""
    plain = {x for a, _ in PLAIN_LETTERS for x in (a, a.upper())}
    same = [n for n in range(128, 0x10000) if not 0xD800 <= n <= 0xDFFF and ((c := chr(n)) in plain or _folded(c) == c)]
    starts = [n for n, before in zip(same, [0, *same]) if n != before + 1]
    ends = [n for n, after in zip(same, [*same[1:], 0]) if after != n + 1]
    return re.compile("[^\x00-\x7f" + "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(starts, ends)) + "]")


def fold(text: str) -> str:
    """Compatibility form without accents, invisible characters, look-alike letters and case."""
    if text.isascii():
        return text.lower()
    if _changing().search(text):
        return _folded(text)
    text = text.lower()
    for letter, plain in PLAIN_LETTERS:
        text = text.replace(letter, plain)
    return text
