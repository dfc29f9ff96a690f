from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from pagelode.sources import canonical, pdf, sinks, xhtml


def page(number, blocks, images=()):
    return {"manual_id": "m", "id": f"p{number:04d}", "pdf_page_index": number - 1, "pdf_page_number": number, "width": 595, "height": 842, "text_layer": {"backend": "N", "quality": {"status": "GOOD"}, "blocks": blocks}, "images": list(images)}


def block(*lines, kind="text", **more):
    return {"id": "b1", "type": kind, "lines": [{"id": f"l{k}", "bbox": [1, 2, 3, 4], "spans": [{"text": t} for t in spans]} for k, spans in enumerate(lines)]} | more


def test_pages_flatten(spark, tmp_path):
    (tmp_path / "p1.json").write_text(json.dumps(page(1, [block(["Legi", "de"], ["a b", "c"], [" "]), block(["x"], kind="image"), {"id": "b3", "lines": [{"spans": [{"text": "fără id"}]}]}])))
    (tmp_path / "p2.json").write_text(json.dumps(page(2, [])))
    pages = canonical.read_pages(spark, str(tmp_path))
    assert pages.count() == 2
    out = canonical.flatten(pages).orderBy("block_index", "line_index").collect()
    assert [(r["text"], r["line_id"]) for r in out] == [("Legi de", "l0"), ("a bc", "l1"), ("fără id", "")]


def test_order_images_and_outline(spark, tmp_path):
    blocks = [block(["x"], id="low", bbox=[0, 90, 1, 91], raw_order_index=0), block(["y"], id="high", bbox=[0, 10, 1, 11], raw_order_index=1)]
    (tmp_path / "p.json").write_text(json.dumps(page(1, blocks, [{"bbox": [1.23456, 0, 0, 0], "extension": "png"}])))
    (tmp_path / "manifest").mkdir()
    (tmp_path / "manifest" / "manifest.json").write_text(json.dumps({"source": {"manual_id": "m"}, "toc": [{"level": 1, "title": "a", "pdf_page_number": 3}, {"level": 1, "title": "b", "pdf_page_number": 0}]}))
    pages = canonical.read_pages(spark, str(tmp_path / "p.json"))
    assert {r["block_id"]: r["reading_order_index"] for r in canonical.reading_order(pages).collect()} == {"high": 0, "low": 1}
    (image,) = canonical.images(pages).collect()
    assert (image["image_id"], image["bbox"][0]) == ("p0001-img001", 1.235)
    assert [r["pdf_page_index"] for r in canonical.outline(canonical.read_manifests(spark, str(tmp_path / "manifest"))).orderBy("pos").collect()] == [2, None]


def test_xhtml_words(spark):
    word = lambda t, x: f'<word xMin="{x}" yMin="1.23456" xMax="2" yMax="3">{t}</word>'
    text = f'<doc><page width="10" height="20"><flow><block xMin="0" yMin="0" xMax="1" yMax="1"><line xMin="0" yMin="0" xMax="1" yMax="1">{word("Sã", 1)}{word("x\x1dy", 2)}</line></block></flow></page><page width="10" height="20"></page></doc>'
    df = spark.createDataFrame([("m", text)], "manual_id string, xhtml string")
    out = xhtml.parse(df).orderBy("word_index").collect()
    assert [(r["text"], r["unresolved_source_codes"], r["extraction_confidence"]) for r in out] == [("Să", [], "HIGH"), ("x�y", ["U+001D"], "REQUIRES_VISUAL_CHECK")]
    assert out[0]["bbox"] == [1.0, 1.235, 2.0, 3.0]
    assert xhtml.page_texts(xhtml.parse(df)).first()["text"] == "Să x�y"
    assert xhtml.diagnostics(df).first()["illegal_controls"] == 1


def test_tool_is_gated():
    assert pdf.find_tool("/nonexistent/pdftotext") is None


def test_sinks(spark, tmp_path):
    images = spark.createDataFrame([(b"a", "PNG"), (b"a", "png"), (b"b", None), (None, "x")], "content binary, extension string")
    names = {r["name"].split(".")[1] for r in sinks.distinct_assets(images).collect()}
    assert names == {"png", "bin"} and sinks.distinct_assets(images).count() == 2
    sinks.write_documents(spark.createDataFrame([("m/1", "{\"ț\":1}")], "manual_id string, document string"), str(tmp_path / "docs"))
    assert (tmp_path / "docs" / "m_1.json").read_bytes() == '{"ț":1}\n'.encode()
    df = spark.createDataFrame([("m", "p1", 1)], "manual_id string, page_id string, n int")
    sinks.write_table(df, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).where("manual_id = 'm'").count() == 1
    sinks.write_pages(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 1
    manuals = spark.createDataFrame([("m", "f", "s", 1, 2, "USABLE", "1", "1")], "manual_id string, filename string, sha256 string, size_bytes int, page_count int, overall_status string, schema_version string, extractor_version string")
    counts = spark.createDataFrame([("m", "status", "GOOD", 2), ("m", "backend", "N", 2)], "manual_id string, dimension string, value string, pages int")
    assert json.loads(sinks.manifest_rows(manuals, counts).first()["manifest"])["extraction_summary"]["page_status_counts"] == {"GOOD": 2}


def test_missing_folder_fails(spark):
    with pytest.raises(Exception):
        canonical.read_manifests(spark, "/nonexistent/manifest.json").withColumn("x", F.lit(1)).collect()
