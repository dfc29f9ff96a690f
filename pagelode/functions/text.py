"""Column functions over text: white space, repair, folding, section numbers and contents lines.

Everything is a built-in expression but what needs Unicode normal forms: one Arrow function for each use, in which plain texts
take a short way.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

#: The 29 characters that count as white space.
SPACE = r"[\t-\r\x1c-\x20\x85\xa0  -     　]"
NUMBER = r"\p{Nd}+(?:\.\p{Nd}+){0,4}"
WIDE_DIGITS = "０１２３４５６７８９"

# Letters as legacy encodings of Romanian show them, for stored text and, with more pairs, for search.
LEGACY_FROM, LEGACY_TO = "ãÃþÞºª", "ăĂţŢşŞ"
SEARCH_FROM, SEARCH_TO = "ãÃþÞºªæÆçÇ", "ăĂţŢşŞţŢşŞ"
# UTF-8 sequences read as a Western code page, in the order of their repair.
SEARCH_SEQUENCES = [("Å£", "ţ"), ("Åž", "Ş"), ("ÅŸ", "ş"), ("Äƒ", "ă"), ("Ã®", "î"), ("Ã¢", "â")]
C1 = {chr(b): bytes([b]).decode("cp1252", "ignore") for b in range(0x80, 0xA0)}
C1_FROM = "".join(k for k, v in C1.items() if v)
C1_TO = "".join(v for v in C1.values() if v)


# Letters that most texts here hold, and what folding makes of them; a text of these, ASCII and common signs needs no normal form.
PLAIN_LETTERS = dict(zip("ăâîșțşţáéíóúàèìòùäöüçñêô", "aaiststaeiouaeiouaoucneo"))
_PLAIN = str.maketrans(PLAIN_LETTERS)
_UNPLAIN = re.compile("[^\x00-\x7f„“”‘’«»–—…·•²³°→←∈√∫∪∩≤≥∞\u00a0" + "".join(c + c.upper() for c in PLAIN_LETTERS) + "]")


def _compose(text: str) -> str:
    return text if text.isascii() or unicodedata.is_normalized("NFC", text) else unicodedata.normalize("NFC", text)


@pandas_udf(StringType())
def composed(s: pd.Series) -> pd.Series:
    """Canonical composition; null becomes the empty string."""
    return s.fillna("").map(_compose)


def _fold(text: str) -> str:
    if text.isascii():
        return text.lower()
    if not _UNPLAIN.search(text):
        return text.lower().translate(_PLAIN)
    text = unicodedata.normalize("NFD", text)
    return "".join(c for c in text if unicodedata.category(c) != "Mn").casefold()


@pandas_udf(StringType())
def folded(s: pd.Series) -> pd.Series:
    """Without diacritics and case; null becomes the empty string."""
    return s.fillna("").map(_fold)


_SEARCH = str.maketrans(SEARCH_FROM, SEARCH_TO)


def _search_fold(text: str) -> str:
    if text.isascii():
        return text.lower()
    text = _compose(text)
    for broken, right in SEARCH_SEQUENCES:
        text = text.replace(broken, right)
    return _fold(text.translate(_SEARCH))


@pandas_udf(StringType())
def search_folded(s: pd.Series) -> pd.Series:
    """Repaired for search and folded, in one pass."""
    return s.fillna("").map(_search_fold)


def stripped(c: Column) -> Column:
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def collapsed(c: Column) -> Column:
    return stripped(F.regexp_replace(c, f"{SPACE}+", " "))


def stored_repair(c: Column) -> Column:
    """What stored text gets: C1 controls as their Windows characters, legacy letters, composed."""
    return composed(F.translate(F.translate(c, C1_FROM, C1_TO), LEGACY_FROM, LEGACY_TO))


def search_repair(c: Column) -> Column:
    """What compared text gets: composed, misread sequences, then legacy letters."""
    out = composed(c)
    for broken, right in SEARCH_SEQUENCES:
        out = F.replace(out, F.lit(broken), F.lit(right))
    return F.translate(out, SEARCH_FROM, SEARCH_TO)


def match_form(c: Column) -> Column:
    """The form in which titles are compared: repaired, folded, words separated by single blanks."""
    return F.trim(F.regexp_replace(search_folded(c), r"[^\p{L}\p{N}_]+", " "))


_PREFIX = rf"(?i)^{SPACE}*(?:(?:capitol(?:ul)?|chapter){SPACE}+)?({NUMBER})[.)]?{SPACE}+"


def section_label(c: Column) -> Column:
    """The dotted number that a line begins with, null without one."""
    return F.nullif(F.translate(F.regexp_extract(c, _PREFIX, 1), WIDE_DIGITS, "0123456789"), F.lit(""))


def section_path(c: Column) -> Column:
    """The number as an array of integers."""
    return F.transform(F.split(section_label(c), r"\."), lambda x: x.cast("bigint"))


def without_section(c: Column) -> Column:
    return stripped(F.regexp_replace(c, _PREFIX, ""))


def without_page(c: Column) -> Column:
    """Without a trailing page number of up to four digits and the leader before it."""
    return stripped(F.regexp_replace(c, rf"(?:\.{{2,}}{SPACE}*|(^|[^\p{{L}}\p{{N}}_]))\p{{Nd}}{{1,4}}{SPACE}*$", "$1"))


def line_title(c: Column) -> Column:
    """A line's title in match form, without its number and page."""
    return match_form(without_page(without_section(c)))


def has_leader(c: Column) -> Column:
    return c.rlike(rf"\.{{2,}}{SPACE}*\p{{Nd}}{{1,4}}{SPACE}*$")


def is_numbered(c: Column) -> Column:
    return c.rlike(rf"^{SPACE}*{NUMBER}\.?{SPACE}+[^\t-\r\x1c-\x20\x85\xa0  -     　]")


_CONTENTS = rf"(?s)^(.*?)(?:\.{{2,}}{SPACE}*)?(\p{{Nd}}{{1,4}}){SPACE}*$"


def contents_page(c: Column) -> Column:
    """The printed page at the end of a contents line, null without one."""
    return F.translate(F.nullif(F.regexp_extract(stripped(c), _CONTENTS, 2), F.lit("")), WIDE_DIGITS, "0123456789").cast("int")


def contents_title(c: Column) -> Column:
    """The title in a contents line, without number, leader and page."""
    body = stripped(F.regexp_replace(F.regexp_extract(stripped(c), _CONTENTS, 1), r"[. ]+$", ""))
    return stripped(F.regexp_replace(body, rf"^{SPACE}*{NUMBER}\.?{SPACE}+", ""))


def contains_run(whole: Column, part: Column) -> Column:
    """Whether the blank-separated tokens of ``part`` are a run of those of ``whole``."""
    return F.contains(F.concat(F.lit(" "), whole, F.lit(" ")), F.concat(F.lit(" "), part, F.lit(" ")))


def snippet(c: Column, limit: int = 420) -> Column:
    clean = collapsed(c)
    return F.when(F.length(clean) > limit, F.concat(F.regexp_replace(F.substring(clean, 1, limit - 1), f"{SPACE}+$", ""), F.lit("…"))).otherwise(clean)


def slug(c: Column, default: str) -> Column:
    """A file-name form of a title: folded, runs of other characters as one hyphen."""
    return F.coalesce(F.nullif(F.regexp_replace(F.regexp_replace(folded(c), "[^a-z0-9]+", "-"), "^-+|-+$", ""), F.lit("")), F.lit(default))


CONTROLS = "".join(chr(k) for k in range(32) if chr(k) not in "\t\n\r")
PRIVATE = "".join(chr(0xE000 + ord(k)) for k in CONTROLS)


def escape_controls(c: Column) -> Column:
    """Control characters that XML forbids, as private-use characters."""
    return F.translate(c, CONTROLS, PRIVATE)


def count_controls(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"[\x00-\x08\x0b\x0c\x0e-\x1f]"))


def unresolved_codes(c: Column) -> Column:
    """Codes U+00xx of escaped controls in a word."""
    return F.transform(F.regexp_extract_all(c, F.lit("[-]"), 0), lambda x: F.format_string("U+%04X", F.ascii(x) - 0xE000))


def restore_word(c: Column) -> Column:
    """A word whose escaped controls are marked as lost, repaired."""
    return stored_repair(F.regexp_replace(c, "[-]", "�"))


def character_counts(c: Column) -> dict[str, Column]:
    """Counts that the quality gate rests on; a null text counts as empty."""
    t = F.coalesce(c, F.lit(""))
    size = F.length(t)
    return {
        "character_count": size.cast("bigint"),
        "non_whitespace_count": (size - F.regexp_count(t, F.lit(SPACE))).cast("bigint"),
        "control_count": F.regexp_count(t, F.lit(r"[\p{Cc}&&[^\t\n\r]]")).cast("bigint"),
        "replacement_count": F.regexp_count(t, F.lit("�")).cast("bigint"),
        "alphabetic_count": F.regexp_count(t, F.lit(r"\p{L}")).cast("bigint"),
    }


def quality_status(non_whitespace: Column, control: Column, replacement: Column) -> Column:
    base = F.greatest(non_whitespace, F.lit(1)).cast("double")
    worst = F.greatest(control / base, replacement / base)
    return F.when(non_whitespace == 0, "EMPTY").when(worst > 0.20, "UNUSABLE").when(worst > 0.005, "SUSPECT").otherwise("GOOD")


def status_rank(status: Column) -> Column:
    return F.when(status == "GOOD", 4).when(status == "SUSPECT", 3).when(status == "EMPTY", 2).when(status == "UNUSABLE", 1).otherwise(0)


def flag_names(flags: Column) -> Column:
    """Names of a span's style bits, in fixed order."""
    bit = lambda n: flags.bitwiseAND(F.lit(1 << n)) != 0
    return F.array_compact(
        F.array(
            F.when(bit(0), "superscript"),
            F.when(bit(1), "italic"),
            F.when(bit(2), "serif").otherwise("sans"),
            F.when(bit(3), "monospaced").otherwise("proportional"),
            F.when(bit(4), "bold"),
        )
    )


def rounded_box(c: Column) -> Column:
    return F.transform(c, lambda x: F.round(x, 3))
