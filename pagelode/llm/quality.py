"""Per-document text quality statistics and outliers of form (problem 1).

Each document gets counts, ratios and the share of its length that reads as list, table or junk. Within a language the
exact rank of each statistic comes from a range-partitioned sort of its distinct values with their counts (equal values
are counted before the sort, so a value that a third of all documents share is one row) and the offsets of the
partitions; the upper-tail shares of the statistics add up, as -ln, to an outlier score.

That score alone can't decide: how rare a form is among a language's documents says little about what the document is.
Measured on 9,925 documents with a like set of statistics, the best threshold told prose from the
rest with precision 0.76 and recall 0.84 (over the shares of form alone 0.92 and 0.89), and a language of which all
documents are lists has no outlier. ``kind`` is what most of a document's own length is; but whether its lines are the
entries of a list or wrapped text is decided by ranks, as the same exact sort gives them: for each of ``RANKED`` the share
of the language's prose whose value is as high or higher, and of its lists whose value is as high or lower, add up as
-ln and ln. Where the sum speaks ten to one against the first reading of the lines, the length is read the other way.

Common words are the words that at least ``COMMON_SHARE`` of all documents hold; there are at most (mean distinct words
of a document / COMMON_SHARE) of them whatever the size of the corpus, which is why they may be broadcast.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelode.session import cut_lineage, written

COMMON_SHARE = 0.0005  #: share of the documents that hold a common word
COMMON_LEAST = 4  #: documents that hold a common word at least
LINES = 3  #: lines, but for rows of a table, from which a document's lines are ranked
LEAST = 100  #: documents of prose and of lists, each, with which a language's documents are compared; with fewer, all languages' are
MARGIN = math.log(10)  #: evidence from which the first reading of a document's lines is given up: ten to one
SHARES = ("other_share", "list_share", "table_share", "junk_share", "repetition")
#: What is odd when it is high: shares of form, signs, characters but letters, words that are not common, lines without an end, long, short and few words.
STATISTICS = (*SHARES, "symbol_ratio", "unalphabetic_ratio", "uncommon_share", "open_line_share", "long_words", "short_words", "few_words")

#: What is high in lists: the share read as list; of lines without a comma or end of a sentence in them, with few words, that don't go on from the line before, without an end.
RANKED = ("list_share", "unbroken_lines", "scant_lines", "separate_lines", "open_lines")
SECOND = ("list_again", "table_again", "junk_again")  #: shares of the other reading of the lines

# Names of languages in codes and spellings met in labels.
LANGUAGE_NAMES = {
    "ro": "ro ron rum rom romanian romana română roumain rumanisch rumänisch",
    "en": "en eng english engleza engleză englisch anglais",
    "fr": "fr fra fre french franceza franceză français francais französisch",
    "de": "de ger deu german germana germană deutsch allemand",
    "hu": "hu hun hungarian maghiara maghiară magyar ungarisch",
    "es": "es spa spanish spaniola spaniolă español espanol castellano spanisch",
    "it": "it ita italian italiana italiană italiano italienisch",
}
_NAMES = {name: code for code, names in LANGUAGE_NAMES.items() for name in names.split()}


def label_language(label: Column) -> Column:
    """Two-letter code that a label names, null when it names no language here."""
    name = F.regexp_extract(F.lower(F.trim(label)), r"^([\p{L}]+)", 1)
    return F.create_map(*[F.lit(x) for pair in _NAMES.items() for x in pair])[name]


MARKER = re.compile(r"^\s*(?:[-–—*•▪◦‣·>]+|\(?(?:\d+(?:\.\d+)*|[a-zA-Z])[.)])\s+")
CELLS = re.compile(r"\s*\t\s*|\s+[|¦]\s+| {3,}|;(?=\S)|^[|¦]|[|¦]$|-\|-")
WORDS = re.compile(r"[^\W\d_]+")
LONG = re.compile(r"[^\W\d_]{4,}")
ODD = re.compile(r"[^\w\s.,;:!?\-|¦%()'\"’„”“«»/–—…•▪*]")
LEADER = re.compile(r"\.{3,}|(?:\. ){3,}|…{2,}")
END = re.compile(r"[.!?…:][\"'”»)]*\s*$")
PIECES = re.compile(r"[,;•|]+")
STOP = re.compile(r"[.!?…:;\d][\"'”»)]*\s*$")


MIXED = re.compile(r"\b(?=[^\W\d_]*\d)(?=\d*[^\W\d_])\w{10,}")
SENTENCES = re.compile(r"[.!?]\s+\w")
INNER = re.compile(r"(?:[^\W\d_]|\d)[,.!?]\s+\S")
RULE = re.compile(r"[\s|¦:+=-]{3,}")
SHORT = 160  #: length up to which a line may be an entry or wrapped


def _cells(line: str) -> list[str]:
    if "\t" in line or "|" in line or "¦" in line or "   " in line or ";" in line:
        return [c for c in CELLS.split(line) if c and c.strip(" -|¦,")]
    return []


def _paragraphs(lines: list[str], wrapped: bool | None = None) -> Iterator[str]:
    """Lines, those of wrapped text joined: a line is wrapped when the next one's first word had no room on it.

    ``wrapped`` says instead that all short lines are, or that none is.
    """
    block: list[str] = []
    marked = 0

    def units() -> Iterator[str]:
        return _joined(block, marked) if wrapped is None else iter([" ".join(block)] if wrapped and block else block)

    for line in lines:
        if len(line) > SHORT:
            yield from units()
            block, marked = [], 0
            yield line
        else:
            rest = MARKER.sub("", line)
            marked += len(rest) < len(line)
            block.append(rest.strip())
    yield from units()


def _joined(bare: list[str], marked: int) -> Iterator[str]:
    width = max(map(len, bare), default=0)
    if len(bare) < 2 or ((2 * marked > len(bare) or width < 25) and not any(map(INNER.search, bare))):
        yield from bare
        return
    full = [len(x) + 1 + len(y.split(None, 1)[0] if y else "") > width for x, y in zip(bare, bare[1:])]
    inner = [f for f, x in zip(full, bare) if not END.search(x)]
    flow = [bool(INNER.search(x)) for x in bare]  # entries of a list hold no comma or end of a sentence
    wrapped = len(inner) >= 3 and sum(inner) >= 0.8 * len(inner)
    if not wrapped:
        runs = [list(g) for _, g in groupby(full)]
        full = [f and len(g) >= 4 and any(flow) for g in runs for f in g]
        if sum(flow) >= 0.1 * len(flow):
            full = [f or (any(flow[max(0, n - 1) : n + 2]) and any(flow[n : n + 3]) and not END.search(bare[n])) for n, f in enumerate(full)]
    held: list[str] = []
    for n, line in enumerate(bare):
        held.append(line)
        if n < len(full) and (full[n] or wrapped and len(line) > 0.7 * width):
            continue
        yield " ".join(held)
        held = []


def _unreadable(unit: str, long: list[str], common: frozenset[str], size: int) -> bool:
    """Whether a stretch of text has no readable words."""
    known = sum(w in common for w in long)
    if long and known >= 0.6 * len(long):
        return len({*long}) <= 4 and any(len({*w}) == 1 for w in long)
    if len(long) >= 2 and known < 0.25 * len(long):
        return True
    return len(ODD.findall(unit)) > 0.2 * size or sum(map(len, MIXED.findall(unit))) > 0.3 * size


def shares(text: str, common: frozenset[str]) -> tuple[float, float, float, float]:
    """Shares of the length that reads as list, table and junk, and the share of repeated four-word runs."""
    return *_length_shares(_rows(text), common), _repetition(text)


def _repetition(text: str) -> float:
    words = WORDS.findall(text.lower())
    repetition = 0.0
    if len(words) >= 20 and (distinct := len({*words})) <= len(words) / 6:
        repetition = 1.0 if distinct <= max(4, len(words) // 25) and len(words) < 400 or distinct <= 8 else 1 - len({*zip(words, words[1:], words[2:], words[3:])}) / (len(words) - 3)
    return repetition


def _rows(text: str) -> list[tuple[str, int]]:
    """Lines that aren't blank, with the number of their cells if they are rows of a table, else 0; a rule has one."""
    rows = []
    for line in text.splitlines():
        if line.strip():
            cells = _cells(line)
            row = len(cells) >= 2 and len(WORDS.findall(line)) <= 5 * len(cells) or RULE.fullmatch(line)
            rows.append((line, max(1, len(cells)) if row else 0))
    return rows


def _length_shares(rows: list[tuple[str, int]], common: frozenset[str], wrapped: bool | None = None) -> tuple[float, float, float]:
    total = listed = table = junk = 0
    plain: list[str] = []

    def text_units(block: list[str]) -> None:
        nonlocal total, listed, junk
        for unit in _paragraphs(block, wrapped):
            size = len(unit)
            total += size
            found = WORDS.findall(unit.lower())
            long = [w for w in found if len(w) >= 4]
            odd = [w for w in found if len(w) >= 3 and w == len(w) * w[0]]
            if 2 * len(odd) > len(found) or (not long and len(found) < 3 and size > 40) or _unreadable(unit, long, common, size - unit.count(" ") or 1):
                junk += size
            elif len(found) < 8 or LEADER.search(unit):
                listed += size
            elif unit.count(",") + unit.count(";") + unit.count("•") >= 4:
                parts = [x for x in PIECES.split(unit) if x.strip()]
                if len(found) <= 4 * len(parts) and not SENTENCES.search(unit):
                    listed += size

    for line, cells in rows:
        if cells:
            if plain:
                text_units(plain)
                plain = []
            total += len(line)
            if _unreadable(line, [w for w in LONG.findall(line.lower())], common, len(line)) and cells < 8:
                junk += len(line)
            else:
                table += len(line)
        else:
            plain.append(line)
    if plain:
        text_units(plain)
    total = total or 1
    return listed / total, table / total, junk / total


def line_figures(rows: list[tuple[str, int]]) -> tuple[float, float, float, float] | None:
    """RANKED but for the first, of the lines that are no rows of a table; null with fewer than LINES."""
    lines = [line.strip() for line, cells in rows if not cells]
    n = len(lines)
    if n < LINES:
        return None
    bare = [MARKER.sub("", x) for x in lines]
    broken = sum("," in x.rstrip(" ,;.") or bool(INNER.search(x)) for x in bare)
    going_on = sum(x == y and y[:1].islower() and not STOP.search(before) for before, x, y in zip(bare, lines[1:], bare[1:]))
    ended = sum(bool(END.search(x)) for x in lines)
    return 1 - broken / n, 1 / (1 + len(WORDS.findall("\n".join(bare))) / n), 1 - going_on / (n - 1), 1 - ended / n


def figures(text: str, common: frozenset[str]) -> tuple:
    """Counts and ratios of characters, words and lines."""
    size = len(text)
    spaces = sum(map(str.isspace, text))
    letters = sum(map(str.isalpha, text))
    control = sum(1 for c in text if unicodedata.category(c) == "Cc" and c not in "\t\n\r")
    lost = text.count("�")
    base = max(size - spaces, 1)
    words = WORDS.findall(text)
    lines = [x for x in text.splitlines() if x.strip()]
    long = [w for w in words if len(w) >= 4]
    return (
        size, size - spaces, control, lost, letters,
        round(control / base, 6), round(lost / base, 6), round(letters / base, 6),
        len(words), round(sum(map(len, words)) / (len(words) or 1), 6), round(len(ODD.findall(text)) / base, 6),
        round(sum(bool(END.search(x)) for x in lines) / (len(lines) or 1), 6), round(sum(w.lower() in common for w in long) / (len(long) or 1), 6),
    )


def common_words(documents: DataFrame, text: str = "text") -> frozenset[str]:
    """Words of four letters and more that at least COMMON_SHARE of all documents hold."""
    counted = documents.where(F.length(F.trim(text)) > 0).select(F.filter(F.array_distinct(F.split(F.lower(text), r"[^\p{L}]+")), lambda w: F.length(w) >= 4).alias("w"))
    n = documents.count()
    least = max(COMMON_LEAST, n * COMMON_SHARE)
    rows = counted.select(F.explode("w").alias("w")).groupBy("w").count().where(F.col("count") >= least).select("w").collect()
    return frozenset(r[0] for r in rows)


FIGURES = (
    "doc_id bigint, character_count bigint, non_whitespace_count bigint, control_count bigint, replacement_count bigint, alphabetic_count bigint, "
    "control_ratio double, replacement_ratio double, alphabetic_ratio double, word_count bigint, mean_word_length double, symbol_ratio double, "
    "terminal_line_share double, common_word_share double"
)


def _emit(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def text_figures(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Figures of every document; a null text has the figures of an empty one. Repeated rows come out repeated."""
    common = documents.sparkSession.sparkContext.broadcast(common_words(documents, text))
    kinds = [pa.int64()] * 6 + [pa.float64()] * 3 + [pa.int64()] + [pa.float64()] * 4
    schema = pa.schema(list(zip([x.split()[0] for x in FIGURES.split(", ")], kinds)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _emit([(i, *figures(t or "", common.value)) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist())], schema)

    return documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(scan, FIGURES)


def form_shares(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", statistics: tuple[str, ...] = SHARES) -> DataFrame:
    """The named statistics (SHARES, or all STATISTICS) of every document with text, its line figures and, where it has these, the shares of the other reading of its lines."""
    common = documents.sparkSession.sparkContext.broadcast(common_words(documents, text))
    schema = pa.schema([("doc_id", pa.int64()), ("language", pa.string())] + [(s, pa.float64()) for s in (*statistics, *RANKED[1:], *SECOND)])
    more = statistics != SHARES

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, language, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                lines = _rows(t)
                listed, table, junk = (round(x, 6) for x in _length_shares(lines, common.value))
                repetition = round(_repetition(t), 6)
                row = (i, language, round(min(1.0, listed + table + junk), 6), listed, table, junk, repetition)
                if more:
                    *_, letters, words, length, symbols, ended, known = figures(t, common.value)
                    row += tuple(round(x, 6) for x in (symbols, 1 - letters, 1 - known, 1 - ended, length, 1 / (1 + length), 1 / (1 + words)))
                ranked = line_figures(lines)
                again = (None,) * 3
                if ranked:  # a single short line reads the same either way
                    again = _length_shares(lines, common.value, wrapped=row[2] >= 0.5) if sum(len(x) <= SHORT for x, cells in lines if not cells) > 1 else (listed, table, junk)
                rows.append(row + (tuple(round(x, 3) for x in ranked) if ranked else (None,) * 4) + again)
            yield _emit(rows, schema)

    narrow = documents.where(F.col(text).rlike(r"[^\s\x{85}\x{a0}\x{2000}-\x{200f}\x{2028}\x{2029}\x{3000}\x{feff}]"))
    language = F.coalesce(label_language(F.col(lang)), F.lit("und"))
    return narrow.select(F.col(doc_id).cast("bigint").alias("doc_id"), language.alias("language"), F.col(text).alias("text")).mapInArrow(scan, ", ".join(f"{f.name} {'double' if f.type == pa.float64() else 'bigint' if f.type == pa.int64() else 'string'}" for f in schema))


def tail_shares(values: DataFrame) -> DataFrame:
    """Of rows (language, statistic, value, n): the share of the language's documents whose value is as high or higher.

    ``n`` counts the documents with that value. The rows are range-partitioned by (language, statistic, value), sorted in
    each partition, and ranked by running counts plus the counts of the partitions before.
    """
    return _at_least(values.where(F.col("value") > 0), "n").drop("n").withColumnRenamed("n_at_least", "at_least")


def _at_least(values: DataFrame, *counts: str) -> DataFrame:
    """Adds, for every named count, ``..._at_least``: its sum over the rows of the same language and statistic with a value as high or higher."""
    by = ["part", "language", "statistic"]
    ranged = values.repartitionByRange("language", "statistic", F.desc("value")).sortWithinPartitions("language", "statistic", F.desc("value"))
    ranged = cut_lineage(ranged.withColumn("part", F.spark_partition_id()))
    own = Window.partitionBy(*by).orderBy(F.desc("value")).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("language", "statistic").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(*by).agg(*[F.sum(c).alias(c) for c in counts])
    offsets = sums.select(*by, *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in counts])
    running = ranged.select("*", *[F.sum(c).over(own).alias(f"{c}_running") for c in counts]).join(offsets, by)
    return running.select("language", "statistic", "value", *counts, *[(F.col(f"{c}_running") + F.col(f"{c}_before")).alias(f"{c}_at_least") for c in counts])


def line_evidence(forms: DataFrame) -> DataFrame:
    """Adds ``evidence``: the sum over RANKED of ln(share of lists with a value as high or lower) - ln(share of prose with one as high or higher).

    Lists and prose are those of the document's language by the first reading (``kind``), with LINES lines and more,
    or of all languages where the language has fewer than LEAST of either; with fewer than LEAST in all it is 0. Shares
    count as 1 in the smaller number plus one at least, so that neither side can say more than the other. Values have
    three digits, so there are at most 1,001 of each statistic and language whatever the size of the corpus, which is why
    they may be broadcast.
    """
    ranked = F.col(RANKED[1]).isNotNull() & (F.col("kind").isNull() | (F.col("kind") == "list"))
    value = {s: F.round(s, 3) for s in RANKED}
    long = forms.where(ranked).select("language", F.col("kind").isNull().cast("bigint").alias("prose"), F.explode(F.create_map(*[x for s in RANKED for x in (F.lit(s), value[s])])).alias("statistic", "value"))
    sums = [F.sum(c).alias(c) for c in ("prose", "lists")]
    counted = long.withColumn("lists", 1 - F.col("prose")).groupBy("language", "statistic", "value").agg(*sums)
    every = counted.groupBy(F.lit("").alias("language"), "statistic", "value").agg(*sums)
    tails = cut_lineage(_at_least(counted.unionAll(every), "prose", "lists"))
    sizes = tails.where(F.col("statistic") == RANKED[0]).groupBy("language").agg(F.sum("prose").alias("all_prose"), F.sum("lists").alias("all_lists"))
    enough = sizes.where(F.least("all_prose", "all_lists") >= LEAST)
    floor = 1 / (F.least("all_prose", "all_lists") + 1)
    listed = F.greatest(floor, (F.col("all_lists") - F.col("lists_at_least") + F.col("lists")) / F.col("all_lists"))
    prose = F.greatest(floor, F.col("prose_at_least") / F.col("all_prose"))
    said = cut_lineage(tails.join(F.broadcast(enough), "language").select(F.col("language").alias("peers"), "statistic", "value", (F.log(listed) - F.log(prose)).alias("said")))
    peers = F.broadcast(enough.where("language <> ''").select("language", F.col("language").alias("peers")))  # a row for each language
    out = forms.join(peers, "language", "left").withColumn("peers", F.coalesce("peers", F.lit("")))
    for s in RANKED:
        own = said.where(F.col("statistic") == s).select("peers", F.col("value").alias(f"{s}_value"), F.col("said").alias(f"{s}_said"))
        out = out.withColumn(f"{s}_value", F.when(ranked, value[s])).join(F.broadcast(own), ["peers", f"{s}_value"], "left")
    return out.select(*forms.columns, sum((F.coalesce(f"{s}_said", F.lit(0.0)) for s in RANKED), F.lit(0.0)).alias("evidence"))


def outliers(forms: DataFrame) -> DataFrame:
    """Adds ``score``: the sum over STATISTICS of -ln(share of the language's documents with a value as high or higher).

    A value of 0 is the least possible, so its share is 1 and adds nothing; such rows never enter the sort.
    """
    sizes = forms.groupBy("language").agg(F.count("*").alias("documents"))
    long = forms.select("doc_id", "language", F.explode(F.create_map(*[x for s in STATISTICS for x in (F.lit(s), F.col(s))])).alias("statistic", "value")).where(F.col("value") > 0)
    tails = tail_shares(long.groupBy("language", "statistic", "value").agg(F.count("*").alias("n")))
    scores = (
        long.join(tails, ["language", "statistic", "value"])
        .join(F.broadcast(sizes), "language")  # a row for each language
        .groupBy("doc_id")
        .agg(F.sum(F.log(F.col("documents") / F.col("at_least"))).alias("score"))
    )
    return forms.join(scores, "doc_id", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))


def document_forms(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", statistics: tuple[str, ...] = SHARES) -> DataFrame:
    """Rows (doc_id, language, statistics, kind) of documents with text; kind is null for prose.

    Null, empty and blank texts have no row. Repeated doc_ids with the same text come out once. ``kind`` is the form that
    most of the length has: ``junk``, ``table`` or ``list``; ties go in that order. Where the ranks of its lines among the
    language's documents speak by MARGIN for entries in what was read as prose, or for wrapped text in what was read as a
    list, it is the form by the other reading of the lines; the shares stay those of the first.
    """
    forms = form_shares(documents, doc_id, text, lang, statistics)
    once = forms.groupBy("doc_id").agg(F.max(F.struct("language", *statistics, *RANKED[1:], *SECOND)).alias("f"))
    read = line_evidence(written(once.select("doc_id", "f.*").withColumn("kind", kind_of())))
    doubted = F.when(F.col("kind").isNull(), F.col("evidence") > MARGIN).otherwise((F.col("kind") == "list") & (F.col("evidence") < -MARGIN))
    return read.select("doc_id", "language", *statistics, F.when(doubted, kind_of(*SECOND)).otherwise(F.col("kind")).alias("kind"))


def ranked_documents(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Rows of :func:`document_forms` with all STATISTICS and the outlier ``score`` within the label's language."""
    return outliers(cut_lineage(document_forms(documents, doc_id, text, lang, STATISTICS)))


def kind_of(listed: str = "list_share", table: str = "table_share", junk: str = "junk_share") -> Column:
    """What most of the length is, by the shares."""
    listed, table, junk = F.col(listed), F.col(table), F.col(junk)
    return (
        F.when((F.col("repetition") >= 0.8) & (table < 0.5), "junk")
        .when(F.round(listed + table + junk, 6) < 0.5, None)
        .when((junk >= table) & (junk >= listed), "junk")
        .when(table >= listed, "table")
        .otherwise("list")
    )


def is_junk(text: str, common: frozenset[str]) -> bool:
    """Whether a text has no readable words or says the same over and over."""
    listed, table, junk, repetition = shares(text, common)
    return repetition >= 0.8 and table < 0.5 or listed + table + junk >= 0.5 and junk >= table and junk >= listed
