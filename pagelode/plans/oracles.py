"""Pieces of the SQL counterparts, in DuckDB's dialect."""

from __future__ import annotations

# Fixed values of the repairs, stated here again so that a wrong table in the engine shows.
C1_FROM = "".join(chr(k) for k in (0x80, *range(0x82, 0x8D), 0x8E, *range(0x91, 0x9D), 0x9E, 0x9F))
C1_TO = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
LEGACY_FROM, LEGACY_TO = "ãÃþÞºª", "ăĂţŢşŞ"
SEARCH_FROM, SEARCH_TO = "ãÃþÞºªæÆçÇ", "ăĂţŢşŞţŢşŞ"
SEARCH_SEQUENCES = [("Å£", "ţ"), ("Åž", "Ş"), ("ÅŸ", "ş"), ("Äƒ", "ă"), ("Ã®", "î"), ("Ã¢", "â")]
WIDE_DIGITS = "０１２３４５６７８９"

#: Members of the white space class.
_WS = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WS, NWS = f"[{_WS}]", f"[^{_WS}]"
XML_CONTROLS = r"[\x{00}-\x{08}\x{0b}\x{0c}\x{0e}-\x{1f}]"
BAD_CONTROLS = r"[\x{00}-\x{08}\x{0b}\x{0c}\x{0e}-\x{1f}\x{7f}-\x{9f}]"
NUM = r"\p{Nd}+(?:\.\p{Nd}+){0,4}"


def sub(c: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({c}, '{pattern}', '{to}', 'g')"


def count(c: str, pattern: str) -> str:
    return f"(length({c}) - length({sub(c, pattern)}))"


def stripped(c: str) -> str:
    return sub(c, f"^{WS}+|{WS}+$")


def _chr(s: str) -> str:
    return " || ".join(f"chr({ord(c)})" for c in s)


def stored_repair(c: str) -> str:
    return f"nfc_normalize(translate(translate({c}, {_chr(C1_FROM)}, {_chr(C1_TO)}), '{LEGACY_FROM}', '{LEGACY_TO}'))"


def search_repair(c: str) -> str:
    out = f"nfc_normalize({c})"
    for broken, right in SEARCH_SEQUENCES:
        out = f"replace({out}, '{broken}', '{right}')"
    return f"translate({out}, '{SEARCH_FROM}', '{SEARCH_TO}')"


def folded(c: str) -> str:
    out = f"lower(strip_accents({c}))"
    for a, b in (("ß", "ss"), ("ς", "σ"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("µ", "μ"), ("ſ", "s")):
        out = f"replace({out}, '{a}', '{b}')"
    return out


def match_form(c: str) -> str:
    return f"trim({sub(folded(search_repair(c)), '[^' + chr(92) + 'p{L}' + chr(92) + 'p{N}_]+', ' ')})"


PREFIX = rf"(?i)^{WS}*(?:(?:capitol(?:ul)?|chapter){WS}+)?({NUM})[.)]?{WS}+"


def section_label(c: str) -> str:
    return f"nullif(translate(regexp_extract({c}, '{PREFIX}', 1), '{WIDE_DIGITS}', '0123456789'), '')"


def without_section(c: str) -> str:
    return stripped(sub(c, PREFIX))


def without_page(c: str) -> str:
    return stripped(sub(c, rf"(?:\.{{2,}}{WS}*|(^|[^\p{{L}}\p{{N}}_]))\p{{Nd}}{{1,4}}{WS}*$", r"\1"))


def line_title(c: str) -> str:
    return match_form(without_page(without_section(c)))


def snippet(c: str) -> str:
    clean = stripped(sub(c, f"{WS}+", " "))
    return f"CASE WHEN length({clean}) > 420 THEN {sub(f'{clean}[1:419]', f'{WS}+$')} || '…' ELSE {clean} END"


def slug(c: str, default: str) -> str:
    return f"coalesce(nullif({sub(sub(folded(c), '[^a-z0-9]+', '-'), '^-+|-+$')}, ''), '{default}')"


def lost_controls(c: str) -> str:
    return sub(c, XML_CONTROLS, "�")


def control_codes(c: str) -> str:
    return f"array_to_string(list_transform(regexp_extract_all({c}, '{XML_CONTROLS}'), lambda x: printf('U+%04X', ord(x))), ',')"


def quality(c: str) -> str:
    t = f"coalesce({c}, '')"
    solid = f"(length({t}) - {count(t, WS)})"
    base = f"CAST(greatest({solid}, 1) AS DOUBLE)"
    bad, lost, alpha = count(t, BAD_CONTROLS), count(t, "�"), count(t, r"\p{L}")
    worst = f"greatest({bad} / {base}, {lost} / {base})"
    return (
        f"length({t}) AS character_count, {solid} AS non_whitespace_count, {bad} AS control_count, {lost} AS replacement_count, {alpha} AS alphabetic_count, "
        f"round({bad} / {base}, 6) AS control_ratio, round({lost} / {base}, 6) AS replacement_ratio, round({alpha} / {base}, 6) AS alphabetic_ratio, "
        f"CASE WHEN {solid} = 0 THEN 'EMPTY' WHEN {worst} > 0.20 THEN 'UNUSABLE' WHEN {worst} > 0.005 THEN 'SUSPECT' ELSE 'GOOD' END AS status"
    )


LINES = f"""lines AS (SELECT *, greatest(0, y1 - y0) AS height, CASE WHEN page_height <= 0 THEN 1 ELSE y0 / page_height END AS top_fraction FROM (
    SELECT *, coalesce(bbox[2], 0) AS y0, coalesce(bbox[4], 0) AS y1, row_number() OVER (PARTITION BY manual_id, line_id ORDER BY ingested_at DESC, text NULLS LAST) AS rn FROM line_records)
    WHERE rn = 1 AND {sub('text', WS)} <> '')"""

PAGE_TEXTS = """page_texts AS (SELECT p.manual_id, p.page_id, coalesce(t.text, '') AS text FROM (SELECT DISTINCT manual_id, page_id FROM manual_pages) p LEFT JOIN (
    SELECT manual_id, page_id, string_agg(b, chr(10) || chr(10) ORDER BY block_index) AS text FROM (
    SELECT manual_id, page_id, block_index, string_agg(text, chr(10) ORDER BY line_index) AS b FROM lines GROUP BY ALL) GROUP BY ALL) t USING (manual_id, page_id))"""

_RANK = "CASE {c} WHEN 'GOOD' THEN 4 WHEN 'SUSPECT' THEN 3 WHEN 'EMPTY' THEN 2 WHEN 'UNUSABLE' THEN 1 ELSE 0 END"
_OTHER = sub("text", r"[\x{00}-\x{08}\x{fffd}]")
LAYERS = f"""a AS (SELECT manual_id, page_id, {quality('text')} FROM page_texts), b AS (SELECT manual_id, page_id, {quality(_OTHER)} FROM page_texts),
    layers AS (SELECT a.manual_id, a.page_id, a.status AS s, b.status AS t, a.status IN ('SUSPECT', 'UNUSABLE') AS poor, bool_or(a.status IN ('SUSPECT', 'UNUSABLE')) OVER (PARTITION BY a.manual_id) AS trouble,
    b.replacement_ratio < a.replacement_ratio OR b.control_ratio < a.control_ratio AS less FROM a JOIN b USING (manual_id, page_id)),
    taken AS (SELECT *, trouble AND ({_RANK.format(c='t')} > {_RANK.format(c='s')} OR (poor AND less)) AS take FROM layers)"""
CHOICE = """SELECT manual_id, page_id, CASE WHEN take THEN 'POPPLER_PDFTOTEXT' ELSE 'PYMUPDF_NATIVE' END AS backend, CASE WHEN take THEN t ELSE s END AS status,
    CASE CASE WHEN take THEN t ELSE s END WHEN 'EMPTY' THEN 'no_machine_readable_text' WHEN 'SUSPECT' THEN 'text_requires_visual_validation' WHEN 'UNUSABLE' THEN 'do_not_create_semantic_units_from_this_page' ELSE '' END AS warnings FROM taken"""

TOC_PAGES = rf"""toc_pages AS (SELECT manual_id, page_id, coalesce(dots, 0) AS dots, coalesce(numbered, 0) AS numbered, coalesce(n, 0) AS lines, CASE WHEN s IS NULL THEN 0 ELSE round(least(1, s), 6) END AS score, s IS NOT NULL AND round(least(1, s), 6) >= 0.55 AS is_toc
    FROM (SELECT DISTINCT manual_id, page_id FROM manual_pages) p LEFT JOIN (SELECT *, CASE WHEN named THEN 0.65::DOUBLE ELSE 0 END + least(0.25::DOUBLE, dots * 0.04::DOUBLE) + least(0.25::DOUBLE, numbered * 0.025::DOUBLE) + CASE WHEN short / n::DOUBLE > 0.75 AND n >= 8 THEN 0.10::DOUBLE ELSE 0 END AS s FROM (
    SELECT manual_id, page_id, bool_or(m = 'cuprins' OR starts_with(m, 'cuprins ')) AS named, count(*) FILTER (WHERE regexp_matches(text, '\.{{2,}}{WS}*\p{{Nd}}{{1,4}}{WS}*$')) AS dots,
    count(*) FILTER (WHERE regexp_matches(text, '^{WS}*{NUM}\.?{WS}+{NWS}')) AS numbered, count(*) FILTER (WHERE length({stripped('text')}) BETWEEN 3 AND 120) AS short, count(*) AS n
    FROM (SELECT manual_id, page_id, text, {match_form('text')} AS m FROM lines) GROUP BY ALL)) f USING (manual_id, page_id))"""

_CONTENTS = rf"(?s)^(.*?)(?:\.{{2,}}{WS}*)?(\p{{Nd}}{{1,4}}){WS}*$"
_PAGE = f"CAST(nullif(translate(regexp_extract({stripped('text')}, '{_CONTENTS}', 2), '{WIDE_DIGITS}', '0123456789'), '') AS INTEGER)"
_BODY = stripped(sub(f"regexp_extract({stripped('text')}, '{_CONTENTS}', 1)", "[. ]+$"))
_TITLE = stripped(sub(_BODY, rf"^{WS}*{NUM}\.?{WS}+"))
ENTRIES = f"""entries AS (SELECT manual_id, CAST(row_number() OVER (PARTITION BY manual_id ORDER BY page_index, y0, block_index, line_index, line_id) AS INTEGER) AS pos, page_id, line_id, raw_text, section,
    len(string_split(section, '.')) AS depth, title, {match_form('title')} AS normalized_title, printed_page FROM (
    SELECT manual_id, page_id, page_index, y0, block_index, line_index, line_id, {stripped('text')} AS raw_text, {section_label(stripped('text'))} AS section, {_TITLE} AS title, {_PAGE} AS printed_page
    FROM lines SEMI JOIN (SELECT manual_id, page_id FROM toc_pages WHERE is_toc) USING (manual_id, page_id)) WHERE section IS NOT NULL AND printed_page IS NOT NULL AND title <> '')"""

LESSONS = f"""lessons AS (SELECT manual_id, {match_form('title')} AS query FROM (SELECT manual_id, title, row_number() OVER (PARTITION BY manual_id ORDER BY line_id, title) AS n FROM toc_entries WHERE title IS NOT NULL) WHERE n = 1)"""
LEXICAL = f"""titled AS (SELECT manual_id, line_id, {line_title('text')} AS title FROM lines),
    tokens AS (SELECT *, string_split(query, ' ') AS qt, string_split(title, ' ') AS tt FROM titled JOIN lessons USING (manual_id) WHERE query <> '' AND title <> ''),
    sides AS (SELECT *, CASE WHEN len(qt) <= len(tt) THEN query ELSE title END AS short, CASE WHEN len(qt) <= len(tt) THEN title ELSE query END AS long FROM tokens),
    lexical AS (SELECT manual_id, line_id, query, title, query = title AS exact, len(list_intersect(qt, tt)) / CAST(len(list_distinct(list_concat(qt, tt))) AS DOUBLE) AS jaccard,
    CASE WHEN least(len(qt), len(tt)) >= 2 AND contains(' ' || long || ' ', ' ' || short || ' ') THEN 0.75 + 0.25 * length(short) / CAST(length(long) AS DOUBLE) ELSE 0 END AS containment,
    2 * least(length(query), length(title)) / CAST(length(query) + length(title) AS DOUBLE) AS ratio_bound FROM sides)"""

HEADINGS = f"""medians AS (SELECT manual_id, page_id, coalesce(median(height) FILTER (WHERE height > 0), 0) AS med FROM lines GROUP BY ALL),
    headings AS (SELECT manual_id, line_id, least(1, CASE WHEN {section_label('text')} IS NOT NULL THEN 0.36::DOUBLE ELSE 0 END + CASE WHEN size <= 80 THEN 0.16::DOUBLE WHEN size <= 140 THEN 0.08::DOUBLE ELSE 0 END
    + CASE WHEN top_fraction <= 0.22 THEN 0.14::DOUBLE WHEN top_fraction <= 0.38 THEN 0.07::DOUBLE ELSE 0 END + CASE WHEN med > 0 AND height >= med * 1.15::DOUBLE THEN 0.18::DOUBLE WHEN med > 0 AND height >= med * 1.05::DOUBLE THEN 0.08::DOUBLE ELSE 0 END
    + CASE WHEN regexp_matches(s, '[.;,:]$') THEN 0 ELSE 0.06::DOUBLE END) AS heading_score FROM (SELECT *, {stripped('text')} AS s, length({stripped('text')}) AS size FROM lines) JOIN medians USING (manual_id, page_id))"""

NUMBERED = f"""numbered AS (SELECT *, list_transform(string_split({section_label('text')}, '.'), lambda x: CAST(x AS BIGINT)) AS section FROM lines WHERE {section_label('text')} IS NOT NULL),
    firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY manual_id ORDER BY page_index, block_index, line_index, line_id) AS n FROM numbered WHERE page_index >= 1) WHERE n = 1)"""
NEXT_PEERS = f"""SELECT manual_id, line_id FROM (SELECT l.manual_id, l.line_id, row_number() OVER (PARTITION BY l.manual_id ORDER BY CASE WHEN l.section[-1] = a.section[-1] + 1 THEN 1 ELSE 2 END, l.page_index, l.block_index, l.line_index, l.line_id) AS n
    FROM numbered l JOIN firsts a ON l.manual_id = a.manual_id AND (l.page_index, l.block_index, l.line_index) > (a.page_index, a.block_index, a.line_index)
    WHERE len(l.section) = len(a.section) AND l.section[1:len(l.section)-1] = a.section[1:len(a.section)-1] AND l.section[-1] > a.section[-1]
    AND {count(match_form(without_section('l.text')), chr(92) + 'p{L}')} >= 3 AND length({stripped('l.text')}) <= 180
    AND (l.height <= 0 OR a.height <= 0 OR l.height >= 0.8::DOUBLE * a.height OR l.top_fraction <= 0.35)) WHERE n = 1"""


def ratios(name: str, pairs: str) -> str:
    """CTEs giving ``name`` (q, t, r): matching-block similarity of the pairs (q, t) that ``pairs`` selects.

    The longest common run, first in q and then in t, splits both strings; what is left of it and right of it is matched alike.
    """
    longest = "list_max(list_transform(range(1, length(a) + 1), lambda i: 100000 * list_max(list_append(list_filter(range(1, least(length(a) - i + 1, length(b)) + 1), lambda k: contains(b, substring(a, i, k))), 0)) - i))"
    return f"""{name}_pairs AS ({pairs}),
    {name}_parts AS (SELECT q, t, q AS a, t AS b, CAST(0 AS BIGINT) AS n FROM {name}_pairs UNION ALL
    SELECT q, t, unnest([substring(a, 1, i - 1), substring(a, i + k, 100000)]) AS a, unnest([substring(b, 1, j - 1), substring(b, j + k, 100000)]) AS b, unnest([k, 0]) AS n FROM (
    SELECT *, strpos(b, substring(a, i, k)) AS j FROM (SELECT *, k * 100000 - m AS i FROM (SELECT *, (m + 99999) // 100000 AS k FROM (
    SELECT *, CAST({longest} AS BIGINT) AS m FROM {name}_parts WHERE a <> '' AND b <> '')) WHERE k > 0))),
    {name} AS (SELECT q, t, 2 * sum(n) / CAST(length(q) + length(t) AS DOUBLE) AS r FROM {name}_parts GROUP BY q, t)"""


_OPEN = "NOT exact AND (containment > 0 OR 0.55::DOUBLE * jaccard + 0.45::DOUBLE * ratio_bound >= 0.42::DOUBLE)"
TITLES = f"""{LEXICAL}, {ratios('alike', f'SELECT DISTINCT query AS q, title AS t FROM lexical WHERE {_OPEN}')},
    titles AS (SELECT manual_id, line_id, query, 1::DOUBLE AS title_score, ['normalized_exact_title'] AS title_reasons FROM lexical WHERE exact UNION ALL SELECT manual_id, line_id, query, title_score, title_reasons FROM (
    SELECT *, least(1, greatest(0.55::DOUBLE * jaccard + 0.45::DOUBLE * r, containment)) AS title_score, list_filter([CASE WHEN containment > 0 THEN 'normalized_token_containment' END,
    CASE WHEN jaccard >= 0.8::DOUBLE THEN 'high_token_overlap' END, CASE WHEN r >= 0.85::DOUBLE THEN 'high_sequence_similarity' END], lambda x: x IS NOT NULL) AS title_reasons
    FROM lexical JOIN alike ON q = query AND t = title WHERE {_OPEN}) WHERE title_score >= 0.42::DOUBLE)"""

CANDIDATES = f"""{HEADINGS}, {TITLES},
    shown AS (SELECT s.*, l.text, l.page_id, l.pdf_page_number, l.page_index, l.block_index, l.line_index, l.height, coalesce(is_toc, false) AS is_toc, h.heading_score, {section_label('l.text')} AS section_label,
    list_concat(title_reasons, list_filter([CASE WHEN {section_label('l.text')} IS NOT NULL THEN 'numbered_heading_candidate' END, CASE WHEN length({stripped('l.text')}) <= 80 THEN 'short_line' END,
    CASE WHEN l.top_fraction <= 0.22 THEN 'near_page_top' END, CASE WHEN med > 0 AND l.height >= med * 1.15::DOUBLE THEN 'larger_than_page_body' END], lambda x: x IS NOT NULL)) AS reasons,
    CASE WHEN l.page_quality = 'SUSPECT' THEN 0.06::DOUBLE WHEN l.page_quality IN ('EMPTY', 'UNUSABLE') THEN 0.40::DOUBLE ELSE 0 END + CASE WHEN contains(l.text, chr(65533)) THEN 0.10::DOUBLE ELSE 0 END AS quality_penalty
    FROM titles s JOIN lines l USING (manual_id, line_id) JOIN headings h USING (manual_id, line_id) JOIN medians USING (manual_id, page_id) LEFT JOIN toc_pages p USING (manual_id, page_id)),
    weighed AS (SELECT *, CASE WHEN bool_or(is_toc AND title_score >= 0.72::DOUBLE) OVER (PARTITION BY manual_id) AND NOT is_toc THEN 0.07::DOUBLE ELSE 0 END AS toc_support, CASE WHEN is_toc THEN 0.58::DOUBLE ELSE 0 END AS toc_penalty FROM shown),
    found AS (SELECT *, CAST(row_number() OVER (PARTITION BY manual_id ORDER BY final_score DESC, title_score DESC, heading_score DESC, pdf_page_number, page_index, block_index, line_index, line_id) AS INTEGER) AS rank FROM (
    SELECT *, greatest(0, least(1, 0.74::DOUBLE * title_score + 0.26::DOUBLE * heading_score + toc_support - toc_penalty - quality_penalty)) AS final_score FROM weighed))"""

DECISIONS = """decided AS (SELECT *, CASE WHEN deterministic_status = 'FOUND_HIGH_CONFIDENCE' THEN deterministic_status ELSE 'NEEDS_SEMANTIC_LOCALIZATION' END AS status FROM (
    SELECT *, CASE WHEN top IS NULL OR top < 0.50::DOUBLE THEN 'NOT_FOUND' WHEN top >= 0.82::DOUBLE AND margin >= 0.10::DOUBLE THEN 'FOUND_HIGH_CONFIDENCE' WHEN top >= 0.68::DOUBLE AND margin < 0.08::DOUBLE AND candidates > 1 THEN 'MULTIPLE_CANDIDATES'
    ELSE 'FOUND_LOW_CONFIDENCE' END AS deterministic_status FROM (SELECT q.manual_id, q.query, line_id, top, coalesce(top - coalesce(second, 0), 0) AS margin, coalesce(candidates, 0) AS candidates FROM lessons q LEFT JOIN (
    SELECT manual_id, max(final_score) FILTER (WHERE rank = 1) AS top, max(final_score) FILTER (WHERE rank = 2) AS second, max(line_id) FILTER (WHERE rank = 1) AS line_id, count(*) AS candidates FROM found GROUP BY manual_id) USING (manual_id))))"""

_PATH = "list_transform(string_split({c}, '.'), lambda x: CAST(x AS BIGINT))"
ANCHORS = f"""anchors AS (SELECT d.manual_id, d.query, d.line_id, l.pdf_page_number, l.page_index, l.block_index, l.line_index, l.height, {section_label('l.text')} AS section FROM decided d JOIN lines l USING (manual_id, line_id) WHERE deterministic_status = 'FOUND_HIGH_CONFIDENCE')"""
EXPECTED = f"""fitting AS (SELECT a.manual_id, coalesce(min(e.pos) FILTER (WHERE contains(e.normalized_title, a.query) OR contains(a.query, e.normalized_title)), CASE WHEN count(*) = 1 THEN min(e.pos) END) AS pos FROM anchors a JOIN entries e USING (manual_id, section) GROUP BY a.manual_id),
    after AS (SELECT f.manual_id, f.pos, min(b.pos) AS next_pos FROM fitting f JOIN entries a ON a.manual_id = f.manual_id AND a.pos = f.pos JOIN entries b ON a.manual_id = b.manual_id AND b.pos > a.pos AND b.depth <= a.depth GROUP BY f.manual_id, f.pos),
    due AS (SELECT x.manual_id, n.title AS expected_title, n.normalized_title AS expected, n.printed_page AS expected_printed_page, n.printed_page + a.pdf_page_number - c.printed_page AS page FROM after x
    JOIN entries c ON c.manual_id = x.manual_id AND c.pos = x.pos JOIN entries n ON n.manual_id = x.manual_id AND n.pos = x.next_pos JOIN anchors a ON a.manual_id = x.manual_id),
    near AS (SELECT * FROM (SELECT l.*, d.expected, {match_form('l.text')} AS own, CASE WHEN l.top_fraction <= 0.35 THEN 0.08::DOUBLE ELSE 0 END + CASE WHEN length({stripped('l.text')}) <= 180 THEN 0.04::DOUBLE ELSE 0 END AS bonus
    FROM lines l JOIN due d ON l.manual_id = d.manual_id AND l.pdf_page_number BETWEEN d.page - 2 AND d.page + 2) WHERE own <> ''),
    {ratios('close', "SELECT DISTINCT expected AS q, own AS t FROM near WHERE NOT contains(own, expected) AND 2 * least(length(own), length(expected)) / CAST(length(own) + length(expected) AS DOUBLE) + bonus >= 0.68::DOUBLE")},
    rated AS (SELECT *, CASE WHEN contains(own, expected) THEN 1 ELSE r END + bonus AS score FROM near LEFT JOIN close ON q = expected AND t = own WHERE contains(own, expected) OR r IS NOT NULL),
    ahead AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY manual_id ORDER BY score DESC, page_index, block_index, line_index) AS n FROM rated WHERE score >= 0.68::DOUBLE) WHERE n = 1),
    boundary AS (SELECT d.manual_id, expected_title, expected_printed_page, line_id, score FROM due d LEFT JOIN ahead USING (manual_id))"""
REGIONS = f"""sections AS (SELECT *, {_PATH.format(c=section_label('text'))} AS path FROM lines WHERE {section_label('text')} IS NOT NULL),
    peers AS (SELECT * FROM (SELECT l.manual_id, l.line_id, row_number() OVER (PARTITION BY l.manual_id ORDER BY CASE WHEN l.path[-1] = p.path[-1] + 1 THEN 1 ELSE 2 END, l.page_index, l.block_index, l.line_index, l.line_id) AS n
    FROM sections l JOIN (SELECT *, {_PATH.format(c='section')} AS path FROM anchors WHERE section IS NOT NULL) p ON l.manual_id = p.manual_id AND (l.page_index, l.block_index, l.line_index) > (p.page_index, p.block_index, p.line_index)
    WHERE len(l.path) = len(p.path) AND l.path[1:len(l.path)-1] = p.path[1:len(p.path)-1] AND l.path[-1] > p.path[-1] AND {count(match_form(without_section('l.text')), chr(92) + 'p{L}')} >= 3 AND length({stripped('l.text')}) <= 180
    AND (l.height <= 0 OR p.height <= 0 OR l.height >= 0.8::DOUBLE * p.height OR l.top_fraction <= 0.35)) WHERE n = 1),
    ends AS (SELECT a.manual_id, a.line_id AS start_line_id, a.pdf_page_number AS start_page, coalesce(b.line_id, p.line_id) AS end_line_id, CASE WHEN b.line_id IS NOT NULL THEN 'TOC_CONFIRMED' WHEN p.line_id IS NOT NULL THEN 'BODY_HEADING_INFERENCE' END AS source,
    expected_title, expected_printed_page FROM anchors a LEFT JOIN boundary b USING (manual_id) LEFT JOIN peers p USING (manual_id)),
    counts AS (SELECT manual_id, max(pdf_page_number) AS page_count FROM manual_pages GROUP BY manual_id),
    sized AS (SELECT e.*, c.page_count, l.pdf_page_number AS end_found, coalesce(l.pdf_page_number, least(page_count, start_page + 4)) AS end_page FROM ends e LEFT JOIN counts c USING (manual_id) LEFT JOIN lines l ON l.manual_id = e.manual_id AND l.line_id = e.end_line_id)"""
REGION = """SELECT manual_id, 1 AS query_id, start_line_id, end_line_id, source, expected_title, expected_printed_page, start_page, end_page,
    array_to_string(list_transform(range(greatest(1, start_page - 1), start_page), lambda p: printf('p%04d', p)), ',') AS context_before,
    array_to_string(list_transform(range(greatest(1, end_page), least(page_count, end_page) + 1), lambda p: printf('p%04d', p)), ',') AS context_after,
    CASE WHEN end_found IS NOT NULL THEN 'exclusive_next_peer_heading' ELSE 'fallback_fixed_page_window' END AS boundary_policy, end_page < start_page AS reversed FROM sized"""


LOCATED = """listing AS (SELECT manual_id, count(*) AS listed, first(array_to_string(reasons, ',') ORDER BY rank) AS first_reasons FROM found WHERE rank <= 10 GROUP BY manual_id),
    matching AS (SELECT *, row_number() OVER (PARTITION BY manual_id ORDER BY page_index, block_index, line_index, line_id) AS n FROM found WHERE is_toc AND title_score >= 0.72::DOUBLE),
    matched AS (SELECT manual_id, string_agg(line_id, ',' ORDER BY n) AS matches, string_agg(printf('  p.%d %s (%.4f)', pdf_page_number, text, round(title_score, 4)), chr(10) ORDER BY n) FILTER (WHERE n <= 5) AS match_lines FROM matching WHERE n <= 10 GROUP BY manual_id),
    shown_pages AS (SELECT manual_id, string_agg(printf('%s=%.4f', page_id, score), ',' ORDER BY page_id) AS toc_scores FROM toc_pages WHERE score >= 0.30::DOUBLE GROUP BY manual_id),
    located AS (SELECT d.*, CASE WHEN z.start_line_id IS NOT NULL THEN d.line_id END AS anchor_line, z.end_line_id AS region_end, z.source, z.start_page, z.end_page, z.page_count, coalesce(listed, 0) AS listed, first_reasons, matches, match_lines, toc_scores
    FROM decided d LEFT JOIN sized z USING (manual_id) LEFT JOIN listing USING (manual_id) LEFT JOIN matched USING (manual_id) LEFT JOIN shown_pages USING (manual_id))"""
LOCATION_REPORT = """, offered AS (SELECT manual_id, string_agg(printf('  %d. p.%d %s [%.4f]', rank, pdf_page_number, text, round(final_score, 4)), chr(10) ORDER BY rank) AS lines FROM found WHERE rank <= 5 GROUP BY manual_id),
    wanted AS (SELECT manual_id, title FROM (SELECT manual_id, title, row_number() OVER (PARTITION BY manual_id ORDER BY line_id, title) AS n FROM toc_entries WHERE title IS NOT NULL) WHERE n = 1)
    SELECT x.manual_id, 1 AS query_id, concat_ws(chr(10), 'Location in ' || x.manual_id, 'Title: ' || title, 'Status: ' || status || ' (' || deterministic_status || ')',
    CASE WHEN anchor_line IS NOT NULL THEN printf('Anchor: p.%d %s (%.4f)', a.pdf_page_number, a.text, round(top, 4)) END,
    CASE WHEN anchor_line IS NULL THEN 'Region: none, the evidence is not decisive' ELSE printf('Region: pages %d-%d', start_page, end_page) || chr(10) || 'Starts at: ' || anchor_line || chr(10) || 'Ends: ' || coalesce('before ' || region_end, 'after a fixed number of pages') || chr(10) || 'Context: '
    || coalesce(nullif(array_to_string(list_transform(list_concat(range(greatest(1, start_page - 1), start_page), range(greatest(1, end_page), least(page_count, end_page) + 1)), lambda p: printf('p%04d', p)), ', '), ''), 'none') END,
    CASE WHEN match_lines IS NOT NULL THEN 'Contents:' || chr(10) || match_lines END, 'Candidates:', o.lines) AS report
    FROM located x JOIN wanted USING (manual_id) LEFT JOIN lines a ON a.manual_id = x.manual_id AND a.line_id = anchor_line LEFT JOIN offered o ON o.manual_id = x.manual_id"""


def chunks(words: int, overlap: int, least: int) -> str:
    step = words - overlap
    return f"""tok AS (SELECT manual_id, page_id, pdf_page_number, line_id, block_index, line_index, unnest(list_filter(regexp_split_to_array(text, '{WS}+'), lambda w: w <> '')) AS w, generate_subscripts(list_filter(regexp_split_to_array(text, '{WS}+'), lambda w: w <> ''), 1) AS i FROM lines),
    pg AS (SELECT manual_id, page_id, min(pdf_page_number) AS pdf_page_number, list(w ORDER BY block_index, line_index, line_id, i) AS ws, list(line_id ORDER BY block_index, line_index, line_id, i) AS ls, count(*) AS n FROM tok GROUP BY ALL),
    ks AS (SELECT *, CAST(greatest(0, ceil((n - {words}) / {step}.0)) AS INTEGER) AS last FROM pg),
    win AS (SELECT *, CASE WHEN k = last AND k > 0 AND n - k * {step} < {least} THEN greatest(0, n - {words}) ELSE k * {step} END AS s FROM (SELECT *, unnest(range(0, last + 1)) AS k FROM ks)),
    cut AS (SELECT *, ws[s + 1:s + {words}] AS cw, ls[s + 1:s + {words}] AS cl FROM win),
    chunks AS (SELECT printf('%s-%s-c%03d', manual_id, page_id, CAST(k + 1 AS INTEGER)) AS chunk_id, manual_id, page_id, pdf_page_number, cl[1] AS start_line_id, cl[-1] AS end_line_id, array_to_string(cw, ' ') AS text,
    {search_repair("array_to_string(cw, ' ')")} AS embedding_text, CAST(len(cw) AS INTEGER) AS word_count, coalesce(is_toc, false) AS is_toc_page FROM cut LEFT JOIN toc_pages USING (manual_id, page_id))"""


#: Signed hashes of words as vectors, and the 15 chunks of each manual that are nearest to its lesson title.
HASHED = f"""asked AS (SELECT manual_id, title FROM (SELECT manual_id, title, row_number() OVER (PARTITION BY manual_id ORDER BY line_id, title) AS n FROM toc_entries WHERE title IS NOT NULL) WHERE n = 1),
    said AS (SELECT manual_id, chunk_id, unnest(string_split('passage: ' || embedding_text, ' ')) AS w FROM chunks UNION ALL SELECT manual_id, NULL, unnest(string_split('query: ' || {search_repair('title')}, ' ')) FROM asked),
    placed AS (SELECT manual_id, chunk_id, h % 64 AS d, CASE WHEN h & 65536 <> 0 THEN 1 ELSE -1 END AS s FROM (SELECT *, CAST('0x' || md5(w)[1:8] AS BIGINT) AS h FROM said WHERE w <> '')),
    parts AS (SELECT manual_id, chunk_id, d, CAST(sum(s) AS BIGINT) AS v FROM placed GROUP BY ALL),
    norms AS (SELECT manual_id, chunk_id, sqrt(sum(v * v)) AS norm FROM parts GROUP BY ALL),
    dots AS (SELECT c.manual_id, c.chunk_id, CAST(sum(CASE WHEN c.d = q.d THEN c.v * q.v ELSE 0 END) AS DOUBLE) AS dot FROM parts c JOIN parts q ON q.manual_id = c.manual_id AND q.chunk_id IS NULL WHERE c.chunk_id IS NOT NULL GROUP BY ALL),
    best AS (SELECT manual_id, chunk_id, CAST(rank AS INTEGER) AS rank, score FROM (SELECT d.manual_id, d.chunk_id, round(dot / greatest(c.norm * q.norm, 1e-9), 6) AS score, row_number() OVER (PARTITION BY d.manual_id ORDER BY round(dot / greatest(c.norm * q.norm, 1e-9), 9) DESC, d.chunk_id) AS rank
    FROM dots d JOIN norms c ON c.manual_id = d.manual_id AND c.chunk_id = d.chunk_id JOIN norms q ON q.manual_id = d.manual_id AND q.chunk_id IS NULL) WHERE rank <= 15)"""


REPORT = """WITH c AS (SELECT manual_id, 'status' AS dimension, page_quality AS value, count(*) AS pages FROM manual_pages GROUP BY ALL UNION ALL SELECT manual_id, 'backend', backend, count(*) FROM manual_pages GROUP BY ALL),
    t AS (SELECT manual_id, string_agg('  ' || coalesce(value, '?') || ': ' || pages || ' page(s)', chr(10) ORDER BY value NULLS FIRST) FILTER (WHERE dimension = 'backend') AS backends,
    string_agg('  ' || coalesce(value, '?') || ': ' || pages || ' page(s)', chr(10) ORDER BY value NULLS FIRST) FILTER (WHERE dimension = 'status') AS statuses FROM c GROUP BY manual_id)
    SELECT m.manual_id, concat_ws(chr(10), 'Extraction of ' || filename, 'Manual: ' || m.manual_id, 'Pages: ' || coalesce(CAST(page_count AS VARCHAR), '?'), 'SHA-256: ' || sha256, 'Status: ' || coalesce(overall_status, '?'),
    'Text layers:', coalesce(backends, '  none'), 'Page quality:', coalesce(statuses, '  none')) AS report FROM manuals m LEFT JOIN t USING (manual_id)"""
