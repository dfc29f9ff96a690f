"""Queries of the engine's own operators, by name, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.functions import similarity as S
from pagelode.functions import text as X
from pagelode.operators import contents, lines, locate, quality, reports, vectors
from pagelode.plans import oracles as Q
from pagelode.session import cut_lineage, shared_path
from pagelode.sources import canonical, index, sinks, xhtml
from pagelode.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return lines.with_geometry(lines.current_lines(read_table(spark, folder, "line_records")))


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "manual_pages")


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    return contents.toc_pages(_lines(spark, folder), _pages(spark, folder))


def _lessons(spark: SparkSession, folder: str) -> DataFrame:
    """The stated query set: the first contents title of each manual, as a reader would ask for it."""
    t = read_table(spark, folder, "toc_entries").where("title IS NOT NULL")
    return t.groupBy("manual_id").agg(F.min(F.struct("line_id", "title")).alias("t")).select("manual_id", F.lit(1).alias("query_id"), "t.title")


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    return decisions(spark, folder)


@query(f"WITH {Q.LINES} SELECT manual_id, line_id, page_id, pdf_page_number, block_id, text, y0, y1, height, round(top_fraction, 6) AS top_fraction FROM lines")
def lines_flatten(spark: SparkSession, folder: str) -> DataFrame:
    """Current lines with geometry and provenance."""
    return _lines(spark, folder).select("manual_id", "line_id", "page_id", "pdf_page_number", "block_id", "text", "y0", "y1", "height", F.round("top_fraction", 6).alias("top_fraction"))


@query("SELECT DISTINCT manual_id, line_id, array_to_string(list_transform(bbox, lambda x: printf('%.3f', round(x, 3))), ',') AS box FROM line_records WHERE bbox IS NOT NULL")
def bbox_round(spark: SparkSession, folder: str) -> DataFrame:
    """Boxes rounded to three decimals."""
    t = read_table(spark, folder, "line_records").where("bbox IS NOT NULL")
    return t.select("manual_id", "line_id", F.array_join(F.transform(X.rounded_box(F.col("bbox")), lambda x: F.format_string("%.3f", x)), ",").alias("box")).distinct()


@query(
    """SELECT DISTINCT f AS flags, concat_ws(',', CASE WHEN f & 1 <> 0 THEN 'superscript' END, CASE WHEN f & 2 <> 0 THEN 'italic' END, CASE WHEN f & 4 <> 0 THEN 'serif' ELSE 'sans' END,
       CASE WHEN f & 8 <> 0 THEN 'monospaced' ELSE 'proportional' END, CASE WHEN f & 16 <> 0 THEN 'bold' END) AS names FROM (SELECT CAST(l_orderkey % 32 AS INTEGER) AS f FROM lineitem)"""
)
def flag_names(spark: SparkSession, folder: str) -> DataFrame:
    """names of style bits."""
    t = read_table(spark, folder, "lineitem").select((F.col("l_orderkey") % 32).cast("int").alias("flags")).distinct()
    return t.select("flags", F.array_join(X.flag_names(F.col("flags")), ",").alias("names"))


_QUALITY_COLUMNS = ["character_count", "non_whitespace_count", "control_count", "replacement_count", "alphabetic_count", "control_ratio", "replacement_ratio", "alphabetic_ratio", "status"]


@query(f"SELECT doc_id, {Q.quality('text')} FROM documents")
def text_quality_gate(spark: SparkSession, folder: str) -> DataFrame:
    """The quality gate over every document."""
    return quality.assess(read_table(spark, folder, "documents")).select("doc_id", *_QUALITY_COLUMNS)


@query(f"WITH {Q.LINES}, {Q.PAGE_TEXTS} SELECT manual_id, page_id, {Q.quality('text')} FROM page_texts")
def page_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Page texts put together from lines and blocks, and their quality."""
    own = lines.page_texts(lines.current_lines(read_table(spark, folder, "line_records")), _pages(spark, folder))
    return quality.assess(own).select("manual_id", "page_id", *_QUALITY_COLUMNS)


@query(
    """SELECT CASE WHEN grouping(page_quality) = 0 THEN 'status' ELSE 'backend' END AS dimension, CASE WHEN grouping(page_quality) = 0 THEN page_quality ELSE backend END AS value, count(*) AS pages
       FROM manual_pages GROUP BY GROUPING SETS ((page_quality), (backend))"""
)
def quality_summary(spark: SparkSession, folder: str) -> DataFrame:
    """A1: pages by status and by backend, in one pass."""
    return quality.status_counts(_pages(spark, folder))


@query(
    """SELECT manual_id, count(*) AS pages, CASE WHEN bool_or(coalesce(page_quality, '') = 'UNUSABLE') THEN 'FAILED' WHEN bool_or(coalesce(page_quality, '') = 'SUSPECT') THEN 'USABLE_WITH_WARNINGS' ELSE 'USABLE' END AS overall_status,
       bool_or(coalesce(page_quality, '') IN ('SUSPECT', 'UNUSABLE')) AS native_problem FROM manual_pages GROUP BY manual_id"""
)
def overall_status(spark: SparkSession, folder: str) -> DataFrame:
    """The status of each manual."""
    return quality.overall_status(_pages(spark, folder))


@query(f"WITH {Q.LINES}, {Q.PAGE_TEXTS}, {Q.LAYERS} {Q.CHOICE}")
def backend_choice(spark: SparkSession, folder: str) -> DataFrame:
    """The better of two text layers of each page; the second one here is the first without lost characters."""
    own = lines.page_texts(lines.current_lines(read_table(spark, folder, "line_records")), _pages(spark, folder))
    other = own.withColumn("text", F.regexp_replace("text", "[\\x00-\\x08�]", ""))
    chosen = quality.choose_layer(quality.assess(own), quality.assess(other))
    return chosen.withColumn("warnings", F.array_join("warnings", ","))


@query(f"WITH {Q.LINES} SELECT manual_id, count(*) AS lines, sum({Q.count('text', Q.XML_CONTROLS)}) AS illegal_controls, sum({Q.count('text', chr(0xFFFD))}) AS lost FROM lines GROUP BY manual_id")
def control_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Control characters and lost characters by manual."""
    own = lines.current_lines(read_table(spark, folder, "line_records"))
    return own.groupBy("manual_id").agg(F.count("*").alias("lines"), F.sum(X.count_controls(F.col("text"))).alias("illegal_controls"), F.sum(F.regexp_count("text", F.lit("�"))).alias("lost"))


@query(f"WITH {Q.LINES} SELECT manual_id, line_id, {Q.stored_repair(Q.lost_controls('text'))} AS restored, {Q.control_codes('text')} AS codes FROM lines WHERE regexp_matches(text, '{Q.XML_CONTROLS}')")
def control_escape(spark: SparkSession, folder: str) -> DataFrame:
    """Escaped control characters restored as lost ones, with their codes."""
    own = lines.current_lines(read_table(spark, folder, "line_records")).where(X.count_controls(F.col("text")) > 0)
    own = own.withColumn("escaped", X.escape_controls(F.col("text")))
    return own.select("manual_id", "line_id", X.restore_word(F.col("escaped")).alias("restored"), F.array_join(X.unresolved_codes(F.col("escaped")), ",").alias("codes"))


@query(f"WITH {Q.LINES}, r AS (SELECT manual_id, line_id, text, {Q.stored_repair('text')} AS stored, {Q.search_repair('text')} AS search FROM lines) SELECT manual_id, line_id, stored, search FROM r WHERE stored <> text OR search <> text")
def legacy_repair(spark: SparkSession, folder: str) -> DataFrame:
    """What repair changes in stored and in compared text."""
    own = lines.current_lines(read_table(spark, folder, "line_records"))
    own = own.select("manual_id", "line_id", "text", X.stored_repair(F.col("text")).alias("stored"), X.search_repair(F.col("text")).alias("search"))
    return own.where((F.col("stored") != F.col("text")) | (F.col("search") != F.col("text"))).drop("text")


@query(f"WITH {Q.LINES} SELECT manual_id, line_id, {Q.match_form('text')} AS match_form, {Q.line_title('text')} AS title FROM lines")
def normalized_titles(spark: SparkSession, folder: str) -> DataFrame:
    """Lines in match form, and as titles."""
    own = lines.current_lines(read_table(spark, folder, "line_records"))
    return own.select("manual_id", "line_id", X.match_form(F.col("text")).alias("match_form"), X.line_title(F.col("text")).alias("title"))


@query(f"WITH {Q.LINES} SELECT manual_id, line_id, {Q.section_label('text')} AS section, len(string_split({Q.section_label('text')}, '.')) AS depth FROM lines WHERE {Q.section_label('text')} IS NOT NULL")
def section_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Section numbers of lines."""
    own = lines.current_lines(read_table(spark, folder, "line_records")).where(X.section_label(F.col("text")).isNotNull())
    return own.select("manual_id", "line_id", F.array_join(X.section_path(F.col("text")).cast("array<string>"), ".").alias("section"), F.size(X.section_path(F.col("text"))).cast("bigint").alias("depth"))


@query(f"WITH {Q.LINES} SELECT manual_id, page_id, coalesce(median(height) FILTER (WHERE height > 0), 0) AS median_height FROM lines GROUP BY manual_id, page_id")
def page_height_median(spark: SparkSession, folder: str) -> DataFrame:
    """A3: exact median height of each page's lines."""
    return locate.page_medians(_lines(spark, folder))


@query(f"WITH {Q.LINES}, {Q.TOC_PAGES} SELECT * FROM toc_pages")
def toc_page_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Contents scores of all pages."""
    return _scored(spark, folder)


@query(f"WITH {Q.LINES}, {Q.TOC_PAGES}, {Q.ENTRIES} SELECT manual_id, pos, page_id, line_id, raw_text, section, title, normalized_title, printed_page FROM entries")
def toc_entry_parse(spark: SparkSession, folder: str) -> DataFrame:
    """Contents entries in document order."""
    own = contents.toc_entries(_lines(spark, folder), _scored(spark, folder))
    return own.drop("pdf_page_number").withColumn("section", F.array_join(F.col("section").cast("array<string>"), "."))


@query(
    f"""WITH {Q.LINES}, {Q.TOC_PAGES}, {Q.ENTRIES} SELECT a.manual_id, a.pos, min(b.pos) AS next_pos FROM entries a LEFT JOIN entries b
        ON a.manual_id = b.manual_id AND b.pos > a.pos AND b.depth <= a.depth GROUP BY a.manual_id, a.pos"""
)
def toc_next_entry(spark: SparkSession, folder: str) -> DataFrame:
    """The next entry that is no deeper."""
    return contents.next_entries(contents.toc_entries(_lines(spark, folder), _scored(spark, folder)))


@query(
    """WITH e AS (SELECT DISTINCT manual_id, line_id, section_number AS s FROM toc_entries), p AS (SELECT *, lead(s) OVER (PARTITION BY manual_id ORDER BY line_id) AS n FROM e)
       SELECT manual_id, line_id, len(n) = len(s) AND n[1:len(n)-1] = s[1:len(s)-1] AND n[-1] = s[-1] + 1 AS immediate, len(n) = len(s) AND n[1:len(n)-1] = s[1:len(s)-1] AND n[-1] > s[-1] AS later,
       len(n) > len(s) AND n[1:len(s)] = s AS below FROM p WHERE n IS NOT NULL"""
)
def section_relations(spark: SparkSession, folder: str) -> DataFrame:
    """How each entry's section relates to the one before."""
    from pyspark.sql import Window

    e = read_table(spark, folder, "toc_entries").select("manual_id", "line_id", F.col("section_number").alias("s")).distinct()
    p = e.withColumn("n", F.lead("s").over(Window.partitionBy("manual_id").orderBy("line_id"))).where("n IS NOT NULL")
    n, s = F.col("n"), F.col("s")
    return p.select("manual_id", "line_id", contents.immediate_peer(n, s).alias("immediate"), contents.later_peer(n, s).alias("later"), contents.descendant(n, s).alias("below"))


@query(f"WITH {Q.LINES}, {Q.LESSONS}, {Q.LEXICAL} SELECT manual_id, line_id, exact, round(jaccard, 6) AS jaccard, round(containment, 6) AS containment, round(ratio_bound, 6) AS ratio_bound FROM lexical WHERE jaccard > 0")
def title_score_lexical(spark: SparkSession, folder: str) -> DataFrame:
    """Token scores of every line for its manual's lesson."""
    own = locate.prepared_lines(_lines(spark, folder)).join(locate.prepared_queries(_lessons(spark, folder)), "manual_id")
    scored = S.lexical_scores(own).where("jaccard > 0")
    return scored.select("manual_id", "line_id", "exact", *[F.round(c, 6).alias(c) for c in ("jaccard", "containment", "ratio_bound")])


@query(
    f"""WITH RECURSIVE {Q.LINES}, {Q.LESSONS}, {Q.TITLES} SELECT manual_id, line_id, round(title_score, 6) AS title_score, array_to_string(title_reasons, ',') AS reasons FROM titles"""
)
def title_score_full(spark: SparkSession, folder: str) -> DataFrame:
    """Title scores with sequence similarity."""
    own = locate.prepared_lines(_lines(spark, folder)).join(locate.prepared_queries(_lessons(spark, folder)), "manual_id")
    return S.title_scores(own).select("manual_id", "line_id", F.round("title_score", 6).alias("title_score"), F.array_join("title_reasons", ",").alias("reasons"))


@query(f"WITH {Q.LINES}, {Q.HEADINGS} SELECT manual_id, line_id, round(heading_score, 6) AS heading_score FROM headings")
def heading_score(spark: SparkSession, folder: str) -> DataFrame:
    """Lines as headings."""
    return locate.heading_scores(locate.prepared_lines(_lines(spark, folder)))


def _found(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    own = cut_lineage(locate.prepared_lines(_lines(spark, folder)))  # read by every later step
    q = locate.prepared_queries(_lessons(spark, folder))
    return own, q, cut_lineage(locate.candidates(own, q, contents.toc_pages(own, _pages(spark, folder))))


@query(
    f"""WITH RECURSIVE {Q.LINES}, {Q.TOC_PAGES}, {Q.LESSONS}, {Q.CANDIDATES} SELECT manual_id, 1 AS query_id, rank, line_id, section_label,
        round(title_score, 4) AS title_score, round(heading_score, 4) AS heading_score, round(toc_support, 4) AS toc_support, round(toc_penalty, 4) AS toc_penalty, round(quality_penalty, 4) AS quality_penalty, round(final_score, 4) AS final_score,
        array_to_string(reasons, ',') AS reasons FROM found"""
)
def candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Ranked candidates."""
    _, _, found = _found(spark, folder)
    scores = [F.round(c, 4).alias(c) for c in ("title_score", "heading_score", "toc_support", "toc_penalty", "quality_penalty", "final_score")]
    return found.select("manual_id", "query_id", "rank", "line_id", "section_label", *scores, F.array_join("reasons", ",").alias("reasons"))


@query(
    f"""WITH RECURSIVE {Q.LINES}, {Q.TOC_PAGES}, {Q.LESSONS}, {Q.CANDIDATES}, {Q.DECISIONS}
        SELECT manual_id, 1 AS query_id, query, line_id, round(top, 4) AS top, round(margin, 4) AS margin, candidates, deterministic_status, status FROM decided"""
)
def decisions(spark: SparkSession, folder: str) -> DataFrame:
    """The decision for each query."""
    _, q, found = _found(spark, folder)
    return locate.decisions(found, q).select("manual_id", "query_id", "query", "line_id", F.round("top", 4).alias("top"), F.round("margin", 4).alias("margin"), "candidates", "deterministic_status", "status")


@query(
    f"""WITH RECURSIVE {Q.LINES}, {Q.TOC_PAGES}, {Q.LESSONS}, {Q.CANDIDATES} SELECT manual_id, 1 AS query_id, n, page_id, pdf_page_number, line_id, text, match_score FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY manual_id ORDER BY page_index, block_index, line_index, line_id) AS INTEGER) AS n, round(title_score, 4) AS match_score FROM found WHERE is_toc AND title_score >= 0.72::DOUBLE) WHERE n <= 10"""
)
def toc_support(spark: SparkSession, folder: str) -> DataFrame:
    """Contents lines that support a query."""
    _, _, found = _found(spark, folder)
    return locate.toc_matches(found)


def _anchored(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    own, q, found = _found(spark, folder)
    entries = cut_lineage(contents.toc_entries(own, contents.toc_pages(own, _pages(spark, folder))))
    return own, entries, cut_lineage(locate.anchors(locate.decisions(found, q), own))


#: Anchors that need no sequence similarity: for each manual its first numbered line outside the contents.
@query(f"WITH {Q.LINES}, {Q.NUMBERED} {Q.NEXT_PEERS}")
def next_peer_heading(spark: SparkSession, folder: str) -> DataFrame:
    """The next heading of the same level after each manual's first section line."""
    own = locate.prepared_lines(_lines(spark, folder))
    first = own.where("section IS NOT NULL AND page_index >= 1").groupBy("manual_id").agg(F.min(F.struct(*locate.ORDER)).alias("f")).select("manual_id", "f.line_id")
    a = own.join(first, ["manual_id", "line_id"]).withColumn("query_id", F.lit(1))
    return locate.next_peer_headings(a, own).select("manual_id", "line_id")


@query(
    f"""WITH RECURSIVE {Q.LINES}, {Q.TOC_PAGES}, {Q.LESSONS}, {Q.CANDIDATES}, {Q.DECISIONS}, {Q.ANCHORS}, {Q.ENTRIES}, {Q.EXPECTED}
        SELECT manual_id, 1 AS query_id, expected_title, expected_printed_page, line_id, round(score, 4) AS score FROM boundary"""
)
def expected_boundary(spark: SparkSession, folder: str) -> DataFrame:
    """The next contents entry's heading near its page."""
    own, entries, a = _anchored(spark, folder)
    return locate.expected_boundaries(a, entries, own).withColumn("score", F.round("score", 4))


@query(
    f"""WITH RECURSIVE {Q.LINES}, {Q.TOC_PAGES}, {Q.LESSONS}, {Q.CANDIDATES}, {Q.DECISIONS}, {Q.ANCHORS}, {Q.ENTRIES}, {Q.EXPECTED}, {Q.REGIONS} {Q.REGION}"""
)
def region_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Evidence regions of the queries found with high confidence."""
    own, entries, a = _anchored(spark, folder)
    counts = _pages(spark, folder).groupBy("manual_id").agg(F.max("pdf_page_number").alias("page_count"))
    out = locate.regions(a, locate.boundaries(a, entries, own), own, counts)
    return out.withColumns({c: F.array_join(c, ",") for c in ("context_before", "context_after")})


def _located(spark: SparkSession, folder: str) -> DataFrame:
    own = cut_lineage(locate.prepared_lines(_lines(spark, folder)))
    scored = cut_lineage(contents.toc_pages(own, _pages(spark, folder)))
    counts = _pages(spark, folder).groupBy("manual_id").agg(F.max("pdf_page_number").alias("page_count"))
    return locate.locate(own, _lessons(spark, folder), scored, cut_lineage(contents.toc_entries(own, scored)), counts)


@query(
    f"""WITH RECURSIVE {Q.LINES}, {Q.TOC_PAGES}, {Q.LESSONS}, {Q.CANDIDATES}, {Q.DECISIONS}, {Q.ANCHORS}, {Q.ENTRIES}, {Q.EXPECTED}, {Q.REGIONS}, {Q.LOCATED}
        SELECT manual_id, 1 AS query_id, status, anchor_line, region_end, source, listed, first_reasons, matches, toc_scores FROM located"""
)
def location_result(spark: SparkSession, folder: str) -> DataFrame:
    """Nested results as JSON, of which some fields are read again."""
    out = _located(spark, folder)
    made = out.select("manual_id", "query_id", "status", F.to_json(F.struct(*out.columns)).alias("j"))
    own = F.from_json("j", "anchor struct<line_id:string>, region struct<end_line_id:string,source:string>, candidate_list array<struct<reasons:array<string>>>, toc_matches array<struct<line_id:string>>, toc_page_scores map<string,double>")
    x = made.withColumn("r", own)
    scores = F.array_join(F.transform(F.sort_array(F.map_entries("r.toc_page_scores")), lambda e: F.format_string("%s=%.4f", e["key"], e["value"])), ",")
    return x.select(
        "manual_id", "query_id", "status", F.col("r.anchor.line_id").alias("anchor_line"), F.col("r.region.end_line_id").alias("region_end"), F.col("r.region.source").alias("source"),
        F.coalesce(F.array_size("r.candidate_list"), F.lit(0)).cast("bigint").alias("listed"), F.array_join(F.get("r.candidate_list", 0)["reasons"], ",").alias("first_reasons"),
        F.array_join(F.col("r.toc_matches.line_id"), ",").alias("matches"), scores.alias("toc_scores"),
    )


@query(
    f"""WITH RECURSIVE {Q.LINES}, {Q.TOC_PAGES}, {Q.LESSONS}, {Q.CANDIDATES}, {Q.DECISIONS}, {Q.ANCHORS}, {Q.ENTRIES}, {Q.EXPECTED}, {Q.REGIONS}, {Q.LOCATED} {Q.LOCATION_REPORT}"""
)
def location_report(spark: SparkSession, folder: str) -> DataFrame:
    """K7: readable results."""
    return reports.location_report(_located(spark, folder))


def _chunks(spark: SparkSession, folder: str, *window: int) -> DataFrame:
    return lines.window_chunks(lines.current_lines(read_table(spark, folder, "line_records")), _scored(spark, folder), *window)


@query(f"WITH {Q.LINES}, {Q.TOC_PAGES}, {Q.chunks(220, 60, 30)} SELECT * FROM chunks")
def chunks_default(spark: SparkSession, folder: str) -> DataFrame:
    """Windows of 220 words, 60 shared."""
    return _chunks(spark, folder)


@query(f"WITH {Q.LINES}, {Q.TOC_PAGES}, {Q.chunks(50, 10, 30)} SELECT * FROM chunks")
def chunks_tail_shift(spark: SparkSession, folder: str) -> DataFrame:
    """Short last windows move back."""
    return _chunks(spark, folder, 50, 10, 30)


@query(f"SELECT chunk_id, {Q.snippet('text')} AS snippet FROM (SELECT DISTINCT chunk_id, text FROM retrieval_chunks)")
def snippets(spark: SparkSession, folder: str) -> DataFrame:
    """Texts cut for display."""
    return read_table(spark, folder, "retrieval_chunks").select("chunk_id", "text").distinct().select("chunk_id", X.snippet(F.col("text")).alias("snippet"))


@query(f"SELECT DISTINCT title, {Q.slug('title', 'lesson')} AS lesson_slug, {Q.slug('title', 'query')} AS query_slug FROM toc_entries")
def slugs(spark: SparkSession, folder: str) -> DataFrame:
    """Titles as file names."""
    t = read_table(spark, folder, "toc_entries").select("title").distinct()
    return t.select("title", X.slug(F.col("title"), "lesson").alias("lesson_slug"), X.slug(F.col("title"), "query").alias("query_slug"))


@query("SELECT chunk_id, sha256(text) AS sha256, concat('query: ', text) AS query_text, concat('passage: ', text) AS passage_text FROM retrieval_chunks")
def source_hash(spark: SparkSession, folder: str) -> DataFrame:
    """Content hashes and prefixed texts."""
    return read_table(spark, folder, "retrieval_chunks").select("chunk_id", F.sha2("text", 256).alias("sha256"), F.concat(F.lit("query: "), "text").alias("query_text"), F.concat(F.lit("passage: "), "text").alias("passage_text"))


@query("SELECT DISTINCT sha256(text) AS sha256, concat('image-', sha256(text), '.', coalesce(nullif(lower(trim(source[1:3])), ''), 'bin')) AS name FROM documents WHERE text IS NOT NULL")
def asset_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    """K5, S3: contents stored once, named by their hash."""
    t = read_table(spark, folder, "documents").select(F.col("text").cast("binary").alias("content"), F.substring("source", 1, 3).alias("extension"))
    return sinks.distinct_assets(t).select("sha256", "name")


_TOP = """WITH q AS (SELECT vec_id AS query_id, embedding AS query FROM embeddings WHERE vec_id % 100 = 0), s AS (SELECT query_id, vec_id,
    list_dot_product(CAST(embedding AS DOUBLE[]), CAST(query AS DOUBLE[])) AS score FROM embeddings, q),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score FROM r WHERE rank <= 15"""


@query(_TOP)
def vector_topk_batch(spark: SparkSession, folder: str) -> DataFrame:
    """The 15 nearest vectors of every vector whose id is divisible by 100."""
    v = read_table(spark, folder, "embeddings")
    q = v.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    return vectors.top_k(v, q, 15).withColumn("score", F.round("score", 6))


@query("SELECT vec_id, round(list_dot_product(CAST(embedding AS DOUBLE[]), CAST((SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) AS DOUBLE[])), 6) AS score FROM embeddings ORDER BY 2 DESC, 1 LIMIT 15")
def vector_topk(spark: SparkSession, folder: str) -> DataFrame:
    """L1: top 15 of one query vector (the one with the least id)."""
    v = read_table(spark, folder, "embeddings")
    q = v.orderBy("vec_id").limit(1).select(F.col("embedding").alias("query"))
    scored = v.crossJoin(F.broadcast(q)).select("vec_id", F.round(vectors.dot(F.col("embedding"), F.col("query")), 6).alias("score"))
    return scored.orderBy(F.desc("score"), "vec_id").limit(15)


def _index(spark: SparkSession, folder: str) -> tuple[index.Index, DataFrame]:
    """The index of all manuals, written and read back, and the lesson titles as queries."""
    keys = index.index_keys(read_table(spark, folder, "manuals"), "hashing")
    held = index.ensure_index(spark, shared_path(spark, "index"), keys, _chunks(spark, folder), vectors.hashing_encoder, element="double")
    return held, _lessons(spark, folder).select("manual_id", "query_id", F.col("title").alias("query"))


@query(
    f"""WITH {Q.LINES}, {Q.TOC_PAGES}, {Q.chunks(220, 60, 30)}, {Q.HASHED} SELECT manual_id, 1 AS query_id, rank, score, chunk_id, pdf_page_number, start_line_id, end_line_id, is_toc_page, text FROM best JOIN chunks USING (manual_id, chunk_id)"""
)
def search_result(spark: SparkSession, folder: str) -> DataFrame:
    """Every manual's chunks encoded, indexed and searched with its lesson title."""
    held, q = _index(spark, folder)
    return index.search(held, q, vectors.hashing_encoder, element="double").select("manual_id", "query_id", "rank", "score", "chunk_id", "pdf_page_number", "start_line_id", "end_line_id", "is_toc_page", "text")


@query(
    f"""WITH {Q.LINES}, {Q.TOC_PAGES}, {Q.chunks(220, 60, 30)}, {Q.HASHED} SELECT manual_id, 1 AS query_id, string_agg(printf('  %d. %.6f p.%d%s %s [%s - %s] ', rank, score, pdf_page_number, CASE WHEN is_toc_page THEN ' [TOC]' ELSE '' END, chunk_id, start_line_id, end_line_id) || {Q.snippet('text')}, chr(10) ORDER BY rank) AS report
        FROM best JOIN chunks USING (manual_id, chunk_id) GROUP BY manual_id"""
)
def search_report(spark: SparkSession, folder: str) -> DataFrame:
    """K8: search results as text."""
    return reports.search_report(search_result(spark, folder))


@query(
    f"""WITH {Q.LINES}, {Q.TOC_PAGES}, {Q.chunks(220, 60, 30)}, c AS (SELECT manual_id, count(*) AS chunk_count, count(DISTINCT CASE WHEN is_toc_page THEN page_id END) AS toc_page_count FROM chunks GROUP BY manual_id)
        SELECT manual_id, sha256 AS source_sha256, 'hashing' AS model_name, 220 AS chunk_words, 60 AS overlap_words, coalesce(chunk_count, 0) AS chunk_count, CASE WHEN chunk_count > 0 THEN 64 ELSE 0 END AS embedding_dimension, coalesce(toc_page_count, 0) AS toc_page_count
        FROM manuals LEFT JOIN c USING (manual_id)"""
)
def index_meta(spark: SparkSession, folder: str) -> DataFrame:
    """The descriptions of an index that was written, checked and read back."""
    return _index(spark, folder)[0].meta.drop("index_version")


@query("SELECT manual_id, CASE WHEN page_count % 2 = 0 THEN 'source_sha256' ELSE 'new' END AS reason FROM manuals WHERE page_count % 2 = 0 OR page_count IS NULL")
def index_stale(spark: SparkSession, folder: str) -> DataFrame:
    """Manuals to build again: of even page counts the source has changed here, those without a page count were never built."""
    keys = index.index_keys(read_table(spark, folder, "manuals"), "hashing")
    pages = read_table(spark, folder, "manuals").select("manual_id", "page_count")
    stored = keys.join(pages, "manual_id").where("page_count IS NOT NULL").withColumn("source_sha256", F.when(F.col("page_count") % 2 == 0, "another").otherwise(F.col("source_sha256")))
    todo = vectors.stale(stored, keys).select("manual_id")
    return todo.join(stored.select("manual_id", F.lit("source_sha256").alias("reason")), "manual_id", "left").fillna("new", ["reason"])


def _counts(spark: SparkSession, folder: str) -> DataFrame:
    pages = _pages(spark, folder)
    own = pages.select("manual_id", F.explode(F.create_map(F.lit("status"), "page_quality", F.lit("backend"), "backend")).alias("dimension", "value"))
    return own.groupBy("manual_id", "dimension", "value").agg(F.count("*").alias("pages"))


@query(Q.REPORT)
def extraction_report(spark: SparkSession, folder: str) -> DataFrame:
    """K6: a readable summary of each manual."""
    return reports.extraction_report(read_table(spark, folder, "manuals"), _counts(spark, folder))


@query(
    """WITH c AS (SELECT manual_id, page_quality, backend, id FROM (SELECT manual_id, page_quality, backend, page_id AS id FROM manual_pages)),
        s AS (SELECT manual_id, string_agg(v || '=' || n, ',' ORDER BY v) AS statuses FROM (SELECT manual_id, page_quality AS v, count(*) AS n FROM c WHERE page_quality IS NOT NULL GROUP BY ALL) GROUP BY manual_id),
        b AS (SELECT manual_id, string_agg(v || '=' || n, ',' ORDER BY v) AS backends FROM (SELECT manual_id, backend AS v, count(*) AS n FROM c GROUP BY ALL) GROUP BY manual_id)
        SELECT manual_id, filename, sha256, page_count, overall_status, coalesce(statuses, '') AS statuses, coalesce(backends, '') AS backends FROM manuals LEFT JOIN s USING (manual_id) LEFT JOIN b USING (manual_id)"""
)
def manifests(spark: SparkSession, folder: str) -> DataFrame:
    """A JSON manifest for each manual, read again by the manifests' schema."""
    made = sinks.manifest_rows(read_table(spark, folder, "manuals"), _counts(spark, folder))
    own = made.withColumn("m", F.from_json("manifest", canonical.MANIFEST))
    counts = lambda c: F.coalesce(F.array_join(F.transform(F.sort_array(F.map_entries(c)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ","), F.lit(""))
    return own.select(
        "manual_id", "m.source.filename", "m.source.sha256", "m.source.page_count", "m.extraction_summary.overall_status", counts("m.extraction_summary.page_status_counts").alias("statuses"),
        counts("m.extraction_summary.backend_page_counts").alias("backends"),
    )


@query(
    """WITH e AS (SELECT DISTINCT manual_id, line_id, len(section_number) AS level, title, printed_page FROM toc_entries WHERE section_number IS NOT NULL)
       SELECT manual_id, CAST(row_number() OVER (PARTITION BY manual_id ORDER BY line_id, level, title, printed_page NULLS FIRST) - 1 AS INTEGER) AS pos, CAST(level AS INTEGER) AS level, title, printed_page AS pdf_page_number,
       CASE WHEN printed_page > 0 THEN printed_page - 1 END AS pdf_page_index FROM e"""
)
def outline(spark: SparkSession, folder: str) -> DataFrame:
    """The outlines of manifests with page indexes; the contents entries stand for the PDF's own outline."""
    t = read_table(spark, folder, "toc_entries").where("section_number IS NOT NULL").select("manual_id", "line_id", F.size("section_number").alias("level"), "title", "printed_page").distinct()
    entry = F.transform(F.sort_array(F.collect_list(F.struct("line_id", "level", "title", "printed_page"))), lambda x: F.struct(x["level"].alias("level"), x["title"].alias("title"), x["printed_page"].alias("pdf_page_number")))
    return canonical.outline(t.groupBy("manual_id").agg(entry.alias("toc")).select(F.struct("manual_id").alias("source"), "toc"))


@query(f"WITH {Q.LINES} SELECT manual_id, page_id, pdf_page_number, block_id, line_id, {Q.stripped('text')} AS text, page_quality, page_height FROM lines")
def pages_flatten(spark: SparkSession, folder: str) -> DataFrame:
    """Canonical pages of all lines, written as JSON, read again and flattened."""
    own = lines.current_lines(read_table(spark, folder, "line_records"))
    line = F.struct("line_index", F.col("line_id").alias("id"), "bbox", F.array(F.struct("text")).alias("spans"))
    page = ["manual_id", "page_id", "pdf_page_number", "page_index", "page_width", "page_height", "page_quality", "backend"]
    blocks = own.groupBy(*page, "block_index", "block_id").agg(F.sort_array(F.collect_list(line)).alias("lines"))
    pages = blocks.groupBy(*page).agg(F.sort_array(F.collect_list(F.struct("block_index", F.col("block_id").alias("id"), F.lit("text").alias("type"), "lines"))).alias("blocks"))
    layer = F.struct("backend", F.struct(F.col("page_quality").alias("status")).alias("quality"), "blocks")
    path = shared_path(spark, "pages")
    sinks.write_pages(pages.select("manual_id", F.col("page_id").alias("id"), "pdf_page_number", F.col("page_index").alias("pdf_page_index"), F.col("page_width").alias("width"), F.col("page_height").alias("height"), layer.alias("text_layer")), path)
    flat = canonical.flatten(canonical.read_pages(spark, path))
    return lines.source_ref(flat, "page_quality", "page_height")


@query(
    f"""WITH {Q.LINES}, w AS (SELECT manual_id, page_id, block_index, line_index, line_id, {Q.stored_repair(Q.lost_controls("array_to_string(list_filter(regexp_split_to_array(text, '[ \t\n\r]+'), lambda x: x <> ''), ' ')"))} AS t FROM lines),
        b AS (SELECT manual_id, page_id, block_index, string_agg(t, chr(10) ORDER BY line_index, line_id) AS t FROM w GROUP BY ALL) SELECT manual_id, page_id, string_agg(t, chr(10) || chr(10) ORDER BY block_index) AS text FROM b GROUP BY ALL"""
)
def xhtml_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's lines as word boxes in XHTML, parsed and put together again."""
    own = lines.current_lines(read_table(spark, folder, "line_records"))
    escaped = F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    box = 'xMin="1" yMin="2" xMax="3" yMax="4"'
    tagged = lambda tag, c: F.concat(F.lit(f"<{tag} {box}>"), c, F.lit(f"</{tag}>"))
    line = tagged("line", F.array_join(F.transform(F.filter(F.split(escaped, r"[ \t\n\r]+"), lambda x: x != ""), lambda x: tagged("word", x)), ""))
    blocks = own.groupBy("manual_id", "page_id", "block_index").agg(F.sort_array(F.collect_list(F.struct("line_index", "line_id", line.alias("x")))).alias("l"))
    block = tagged("block", F.array_join("l.x", ""))
    pages = blocks.groupBy("manual_id", "page_id").agg(F.sort_array(F.collect_list(F.struct("block_index", block.alias("x")))).alias("b"))
    whole = pages.select(F.to_json(F.struct("manual_id", "page_id")).alias("manual_id"), F.concat(F.lit('<page width="1" height="1"><flow>'), F.array_join("b.x", ""), F.lit("</flow></page>")).alias("xhtml"))
    texts = xhtml.page_texts(xhtml.parse(whole)).withColumn("k", F.from_json("manual_id", "manual_id string, page_id string"))
    return texts.select("k.manual_id", "k.page_id", "text")


@query("SELECT manual_id, page_id, pdf_page_index, pdf_page_number, coalesce(page_label, '') AS page_label, round(width, 3) AS width, round(height, 3) AS height, rotation, coalesce(len(warnings), 0) AS warnings FROM manual_pages")
def page_geometry(spark: SparkSession, folder: str) -> DataFrame:
    """Geometry and labels of pages."""
    return _pages(spark, folder).select("manual_id", "page_id", "pdf_page_index", "pdf_page_number", F.coalesce("page_label", F.lit("")).alias("page_label"), F.round("width", 3).alias("width"), F.round("height", 3).alias("height"), "rotation", F.coalesce(F.array_size("warnings"), F.lit(0)).cast("bigint").alias("warnings"))
