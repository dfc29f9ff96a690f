from __future__ import annotations

import json
import stat

import pytest
from pyspark.sql import functions as F

from pagelode import cli
from pagelode.sources import canonical, extraction as E, pdf, sinks


def span(text, flags=0, chars=None):
    return {"chars": None if chars is None else [{"c": c} for c in chars], "text": text, "bbox": [1.00049, 2.0, 3.0, 4.0], "origin": [1.23456, 7.0], "font": "Serif", "size": 11.5, "flags": flags}


def text_block(number, *lines):
    return {"type": 0, "number": number, "bbox": [0.0, 1.0 * number, 9.0, 9.0], "lines": [{"bbox": [0.0, 0.0, 1.0, 1.0], "wmode": 0, "dir": [1.0, 0.0], "spans": list(spans)} for spans in lines]}


def picture(number, content, ext="PNG"):
    return {"type": 1, "number": number, "bbox": [0.0, 0.0, 5.0, 5.0], "lines": None, "image": content, "ext": ext, "width": 4, "height": 3, "colorspace": 3, "bpc": 8}


BAD = "x\x01\x02 y"


@pytest.fixture(scope="module")
def raw(spark):
    pages = [
        ("m", 0, 3, 595.0, 842.0, 0, None, [2, 0], [text_block(0, [span("jos", 20), span(None, chars="ul")], [span("doi")]), picture(1, b"a"), text_block(2, [span("sus")]), picture(3, b"a"), picture(4, b"b", None)]),
        ("m", 1, 3, 595.0, 842.0, 90, "ii", [0], [text_block(0, [span(BAD)])]),
        ("m", 2, 3, 595.0, 842.0, 0, "1", [], []),
        ("n", 0, 1, 595.0, 842.0, 0, "1", [0], [text_block(0, [span("bun")])]),
    ]
    fill = lambda b: {"image": None, "ext": None, "width": None, "height": None, "colorspace": None, "bpc": None} | b
    return spark.createDataFrame([(*p[:8], [fill(b) for b in p[8]]) for p in pages], E.RAW)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame([("m", "m.pdf", "aa", 10, 3, {"title": "M"}, [(1, "Unu", 1), (2, "Doi", 0)]), ("n", "n.pdf", "bb", 11, 1, {}, [])], E.DOCUMENT)


def xhtml(*pages):
    word = lambda t: f'<word xMin="1" yMin="2" xMax="3" yMax="4">{t}</word>'
    box = 'xMin="0" yMin="0" xMax="1" yMax="1"'
    return "<doc>" + "".join(f'<page width="10" height="20">' + (f"<flow><block {box}><line {box}>{''.join(map(word, p))}</line></block></flow>" if p else "") + "</page>" for p in pages) + "</doc>"


def test_native_blocks(raw):
    rows = {(r["manual_id"], r["page_index"]): r for r in E.native_blocks(raw).collect()}
    first = rows["m", 0]
    assert [(b["id"], b["raw_order_index"], b["reading_order_index"]) for b in first["blocks"]] == [("p0001-b0001", 0, 1), ("p0001-b0003", 2, 0)]
    assert first["text"] == "josul\ndoi\n\nsus" and rows["m", 2]["text"] == "" and rows["m", 2]["blocks"] == []
    s = first["blocks"][0]["lines"][0]["spans"]
    assert [(x["id"], x["text"], x["flag_names"]) for x in s] == [("p0001-b0001-l001-s001", "jos", ["serif", "proportional", "bold"]), ("p0001-b0001-l001-s002", "ul", ["sans", "proportional"])]
    assert (s[0]["bbox"], s[0]["origin"], s[0]["font"], s[0]["extraction_method"]) == ([1.0, 2.0, 3.0, 4.0], [1.235, 7.0], "Serif", "PYMUPDF_NATIVE")


def test_images_and_assets(raw, tmp_path):
    rows = E.images(raw).orderBy("index").collect()
    assert [(r["id"], r["index"], r["colorspace"], r["bits_per_component"], r["asset_path"][-4:]) for r in rows] == [("p0001-img001", 0, 3, 8, ".png"), ("p0001-img002", 1, 3, 8, ".png"), ("p0001-img003", 2, 3, 8, ".bin")]
    sinks.write_assets(E.images(raw), str(tmp_path))
    files = sorted(tmp_path.glob("image-*"))
    assert sorted(f.read_bytes() for f in files) == [b"a", b"b"]
    files[0].write_bytes(b"kept")
    sinks.write_assets(E.images(raw), f"file://{tmp_path}")
    assert files[0].read_bytes() == b"kept"


def test_pages_take_the_better_layer(spark, raw, documents, tmp_path):
    second = spark.createDataFrame([("m", xhtml(["jos"], ["Sã", "y\x1d"], []))], "manual_id string, xhtml string")
    only = raw.where("manual_id = 'm'")
    pages = E.page_records(only, documents, second, versions=("1.0", "2.0"))
    rows = {r["id"]: r for r in pages.collect()}
    assert {k: r["text_layer"]["backend"] for k, r in rows.items()} == {"p0001": "PYMUPDF_NATIVE", "p0002": "POPPLER_PDFTOTEXT", "p0003": "PYMUPDF_NATIVE"}
    assert (rows["p0001"]["page_label"], rows["p0002"]["page_label"], rows["p0002"]["rotation"], rows["p0002"]["text_layer"]["backend_version"]) == ("", "ii", 90, "2.0")
    assert rows["p0003"]["warnings"] == ["no_machine_readable_text"] and [i["id"] for i in rows["p0001"]["images"]] == ["p0001-img001", "p0001-img002", "p0001-img003"]
    words = json.loads(rows["p0002"]["text_layer"]["blocks"])[0]["lines"][0]["spans"]
    assert [(w["id"], w["text"], w["extraction_confidence"]) for w in words] == [("p0002-b0001-l001-s001", "Să", "HIGH"), ("p0002-b0001-l001-s002", "y\ufffd", "REQUIRES_VISUAL_CHECK")]
    made = E.manifests(documents.where("manual_id = 'm'"), pages, E.second_layer_totals(second), ("1.0", "2.0"))
    (m,) = made.collect()
    assert m["extraction_summary"]["second_layer"].asDict() == {"version": "2.0", "illegal_controls": 1, "unresolved_glyphs": 1}
    assert m["extraction_summary"]["backend_page_counts"] == {"PYMUPDF_NATIVE": 2, "POPPLER_PDFTOTEXT": 1} and m["page_files"] == ["pages/p0001.json", "pages/p0002.json", "pages/p0003.json"]
    assert [(e["title"], e["pdf_page_index"]) for e in m["toc"]] == [("Unu", 0), ("Doi", None)] and m["pdf_metadata"] == {"title": "M"}
    assert "lost glyphs: 1" in E.report(made).first()["report"]
    with pytest.raises(Exception):
        E.page_records(only, documents, spark.createDataFrame([("m", xhtml(["jos"]))], "manual_id string, xhtml string")).collect()


def test_pages_without_a_tool(raw, documents):
    pages = E.page_records(raw, documents)
    warned = {(r["manual_id"], r["id"]): r["warnings"] for r in pages.collect()}
    assert "poppler_fallback_unavailable" in warned["m", "p0002"] and warned["n", "p0001"] == []
    assert {r["manual_id"]: r["extraction_summary"]["second_layer"] for r in E.manifests(documents, pages).collect()} == {"m": None, "n": None}


def test_tool_runs_on_pipes(spark, tmp_path):
    script = tmp_path / "pdftotext"
    script.write_text("#!/bin/sh\nif [ \"$1\" = -v ]; then echo 'tool 9.9' >&2; else cat; fi\n")
    script.chmod(script.stat().st_mode | stat.S_IEXEC)
    assert pdf.find_tool(str(script)) == (str(script), "tool 9.9")
    (tmp_path / "a.pdf").write_text(xhtml(["Sã"]))
    files = E.read_files(spark, str(tmp_path))
    assert files.select("manual_id", "filename", "size_bytes").first()[:2] == ("a", "a.pdf") and len(files.first()["sha256"]) == 64
    assert E.run_tool(files, str(script)).first()["xhtml"] == xhtml(["Sã"])
    with pytest.raises(Exception):
        E.run_tool(files, "false").collect()
    if pdf.pymupdf is None:
        with pytest.raises(RuntimeError):
            E.extract(spark, str(tmp_path), str(tmp_path / "out"))
    with pytest.raises(ValueError):
        E.extract(spark, str(tmp_path), str(tmp_path / "out"), policy="other")


def test_command_lines(spark, tmp_path, capsys):
    from tests.manuals import CIRCUITS, QUERY

    for n, page in enumerate(CIRCUITS, 1):
        lines = [{"id": f"p{n:04d}-b0001-l{k:03d}", "bbox": [50.0, y, 500.0, y + h], "spans": [{"text": t + " "}]} for k, (t, y, h) in enumerate(page, 1)]
        body = {"manual_id": "a", "id": f"p{n:04d}", "pdf_page_index": n - 1, "pdf_page_number": n, "width": 595.0, "height": 842.0, "source_sha256": "s", "text_layer": {"backend": "N", "quality": {"status": "GOOD"}, "blocks": [{"id": "b", "type": "text", "lines": lines}]}}
        (tmp_path / "pages" / "a").mkdir(parents=True, exist_ok=True)
        (tmp_path / "pages" / "a" / f"p{n:04d}.json").write_text(json.dumps(body))
    pages, out = str(tmp_path / "pages"), str(tmp_path / "out")
    assert canonical.read_pages(spark, pages).count() == 4
    cli.main(["locate", pages, QUERY, f"{out}/locate"], spark)
    assert "Region: pages 3-4" in capsys.readouterr().out
    assert json.loads((tmp_path / "out/locate/results/a.json").read_text())["anchor"]["page_id"] == "p0003"
    cli.main(["search", pages, "curentului fir lung", f"{out}/search", "--top", "2"], spark)
    assert "a-p0003-c001" in capsys.readouterr().out
    found = json.loads((tmp_path / "out/search/results/a.json").read_text())
    assert len(found["matches"]) == 2 and found["index"]["chunk_count"] == 4
    with pytest.raises(ValueError):
        cli.main(["search", pages, "x", out, "--top", "0"], spark)
    with pytest.raises(SystemExit):
        cli.main(["extract", pages], spark)
