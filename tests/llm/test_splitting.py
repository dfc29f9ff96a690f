from __future__ import annotations

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from pagelode.llm import splitting as S

TEXT = st.lists(st.sampled_from(["cuvânt", "a", "Propoziție.", "parte,", "\n", "\n\n", "x" * 300, "lung" * 700, "α·β·" * 90, " ", "12"]), max_size=600).map(" ".join)


@settings(max_examples=60, deadline=None)
@given(TEXT)
def test_pieces_cover_the_text_within_the_limits(text):
    out = S.pieces(text)
    words = text.split()
    assert bool(out) == bool(words or len(text) > S.MOST_CHARS)
    if len(words) <= S.MOST_WORDS and len(text) <= S.MOST_CHARS:
        assert len(out) <= 1
        return
    assert all(e - s <= S.MOST_CHARS and len(text[s:e].split()) <= S.MOST_WORDS for s, e in out)
    assert not text[: out[0][0]].strip() and not text[out[-1][1] :].strip()
    for (s, e), (s2, e2) in zip(out, out[1:]):
        assert s < s2 or s2 <= e
        assert e < e2 and not text[e:s2].strip()


def test_plain_words_share_sixty():
    text = ". ".join(" ".join(f"c{i}" for i in range(k, k + 11)) for k in range(0, 900, 11))
    out = S.pieces(text)
    assert len(out) > 4
    for (_, e), (s2, _) in zip(out, out[1:]):
        assert len(text[s2:e].split()) == 60
        assert text[e - 1] == "." or text[e : e + 1] == "."


def test_cuts_fall_on_the_strongest_boundary():
    text = ("unu doi trei patru, cinci șase. " * 20).strip() + "\n\n" + ("șapte opt nouă, zece unsprezece. " * 25).strip()
    assert any(text[e : e + 2] == "\n\n" for _, e in S.pieces(text))


def chunks(spark, rows):
    return spark.createDataFrame(rows, "chunk_id string, manual_id string, start_line_id string, end_line_id string, text string, piece string, own string")


def test_chunks_and_their_lines(spark):
    line = lambda p, k: f"p{p:04d}-b0001-l{k:03d}"
    texts = {line(p, k): " ".join(f"p{p}k{k}w{i}" for i in range(12)) + "." for p in (1, 2, 3) for k in range(1, 11)}
    at = dt.datetime(2025, 1, 1)
    rows = [("m", i[:5], i, t, at, "x") for i, t in texts.items()] + [("m", "p0001", line(1, 1), "altceva", at - dt.timedelta(1), "x"), ("m", "p0002", line(2, 1), texts[line(2, 1)], at, "x"), ("n", "p0001", line(1, 1), "alt manual", at, "x")]
    lines = spark.createDataFrame(rows, "manual_id string, page_id string, line_id string, text string, ingested_at timestamp, chunk_id string")
    long = "\n".join(texts.values())
    df = chunks(spark, [("c1", "m", line(1, 1), line(3, 10), long, "x", "x"), ("c1", "m", line(1, 1), line(3, 10), long, "x", "x"), ("c2", "m", line(1, 1), line(1, 2), "scurt", "x", "x"), ("c3", "m", None, None, long, "x", "x"), ("c4", "m", line(1, 1), line(1, 2), None, "x", "x"), ("c5", None, line(1, 1), line(1, 1), "x" * 5000, "x", "x")])
    out = S.split_chunks(df, lines).orderBy("chunk_id", "piece").collect()
    assert {r["chunk_id"] for r in out} == {"c1", "c3", "c5"}
    for r in out:
        assert r["word_count"] == len(r["text"].split()) <= S.MOST_WORDS and len(r["text"]) <= S.MOST_CHARS
        if r["chunk_id"] == "c1":
            assert r["text"].split()[0] in texts[r["start_line_id"]] and r["text"].split()[-1] in texts[r["end_line_id"]]
    assert [r["start_line_id"] for r in out if r["chunk_id"] == "c3"][0] is None
    assert {r["chunk_id"] for r in S.split_chunks(df).collect()} == {"c1", "c3", "c5"}
    assert S.split_chunks(df.limit(0), lines).count() == 0 and S.split_chunks(df, lines.limit(0)).count() == len(out)


def test_limits_are_exact(spark):
    rows = [("a", "m", None, None, " ".join(["w"] * 220), "", ""), ("b", "m", None, None, " ".join(["w"] * 221), "", ""), ("c", "m", None, None, "x" * 2400, "", ""), ("d", "m", None, None, "x" * 2401, "", ""), ("e", "m", None, None, "　".join(["w"] * 221), "", "")]
    assert {r["chunk_id"] for r in S.oversized(chunks(spark, rows)).collect()} == {"b", "d", "e"}


def test_size_from_white_space_counts_too(spark):
    padded = " ".join(f"c{i}" for i in range(200)) + " " * 2300
    rows = [("a", "m", None, None, padded, "", ""), ("b", "m", None, None, " " * 2500, "", ""), ("c", "m", None, None, " " * 2400, "", ""), ("d", "m", None, None, "  \n ".join(f"c{i}" for i in range(500)) + " " * 90, "", "")]
    out = S.split_chunks(chunks(spark, rows)).collect()
    assert {r["chunk_id"] for r in out if r["piece"] == 1} == {"a", "b", "d"}
    assert [(r["text"], r["word_count"]) for r in out if r["chunk_id"] == "b"] == [("", 0)]


def test_long_words_share_sixty_while_they_fit():
    text = " ".join("x" * 29 + f"{i:03d}" for i in range(200))  # 60 words are 1,979 characters
    out = S.pieces(text)
    assert all(e - s <= S.MOST_CHARS for s, e in out) and out[-1][1] == len(text)
    assert all(len(text[s2:e].split()) == 60 for (_, e), (s2, _) in zip(out, out[1:]))
    wide = " ".join("x" * 79 + f"{i:03d}" for i in range(90))  # 60 words don't fit
    assert all(0 < len(wide[s2:e].split()) < 60 for (_, e), (s2, _) in zip(S.pieces(wide), S.pieces(wide)[1:]))


def test_coverage(spark):
    text = ". ".join(" ".join(f"c{i}" for i in range(k, k + 11)) for k in range(0, 900, 11))
    (r,) = S.coverage(S.split_chunks(chunks(spark, [("a", "m", None, None, text, "", ""), ("b", "m", None, None, "x" * 3000, "", "")]))).collect()
    import hashlib

    assert tuple(r) == ("a", hashlib.md5(" ".join(text.split()).encode()).hexdigest(), True, 60)
