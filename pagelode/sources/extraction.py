"""From PDF documents to canonical pages: native text layer, second layer, choice, page records, manifests and assets.

Only two steps leave Spark's own functions, one task a document: :func:`read_raw` (a PDF library) and :func:`run_tool` (the
command-line tool). What they return are plain nested rows, and everything after is expressed over columns, so it runs and is
tested without either.
"""

from __future__ import annotations

import subprocess
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.functions.text import flag_names
from pagelode.operators import quality
from pagelode.sources import pdf, sinks, xhtml

SCHEMA_VERSION = "1"
CHAR = "struct<c:string>"
SPAN = f"struct<chars:array<{CHAR}>,text:string,bbox:array<double>,origin:array<double>,font:string,size:double,flags:int>"
LINE = f"struct<bbox:array<double>,wmode:int,dir:array<double>,spans:array<{SPAN}>>"
BLOCK = f"struct<type:int,number:int,bbox:array<double>,lines:array<{LINE}>,image:binary,ext:string,width:int,height:int,colorspace:int,bpc:int>"
#: A page as the PDF library gives it; ``sorted_numbers`` are the text blocks' numbers in reading order.
RAW = (
    "manual_id string, page_index int, page_count int, width double, height double, rotation int, page_label string, sorted_numbers array<int>, "
    f"blocks array<{BLOCK}>"
)
DOCUMENT = "manual_id string, filename string, sha256 string, size_bytes bigint, page_count int, pdf_metadata map<string,string>, toc array<struct<level:int,title:string,pdf_page_number:int>>"


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(manual_id, filename, sha256, size_bytes, content) of the PDF files in a folder; a manual is known by its file's name."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(path)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return files.select(F.regexp_replace(name, r"(?i)\.pdf$", "").alias("manual_id"), name.alias("filename"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("size_bytes"), "content")


def _open(content: bytes):
    if pdf.pymupdf is None:
        raise RuntimeError("reading PDF files needs PyMuPDF, which is not installed")
    doc = pdf.pymupdf.open(stream=content, filetype="pdf")
    if doc.needs_pass:
        raise ValueError("documents with a password can't be read")
    return doc


def read_raw(files: DataFrame) -> DataFrame:
    """The raw pages of PDF files, one task a file and a page a row."""
    if pdf.pymupdf is None:
        raise RuntimeError("reading PDF files needs PyMuPDF, which is not installed")

    def label(page) -> str:
        try:
            return page.get_label() or ""
        except Exception:  # a broken label table is no reason to lose the page
            return ""

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for manual_id, content in zip(frame["manual_id"], frame["content"]):
                with _open(content) as doc:
                    for n, page in enumerate(doc):
                        numbers = [b["number"] for b in page.get_text("dict", sort=True)["blocks"] if b.get("type") == 0]
                        texts = page.get_text("rawdict", sort=False)["blocks"]
                        pictures = {b["number"]: b for b in page.get_text("dict", sort=False)["blocks"] if b.get("type") == 1}
                        blocks = [{**b, **pictures.get(b.get("number"), {})} for b in texts]
                        yield pd.DataFrame([(manual_id, n, doc.page_count, page.rect.width, page.rect.height, page.rotation, label(page), numbers, blocks)], columns=[c.split()[0] for c in RAW.split(", ")])

    return files.select("manual_id", "content").mapInPandas(parse, RAW)


def read_documents(files: DataFrame) -> DataFrame:
    """Metadata and outline of PDF files."""

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for manual_id, name, sha, size, content in zip(*(frame[c] for c in ("manual_id", "filename", "sha256", "size_bytes", "content"))):
                with _open(content) as doc:
                    toc = [{"level": x[0], "title": str(x[1]), "pdf_page_number": x[2]} for x in doc.get_toc(simple=True) if len(x) >= 3]
                    rows.append((manual_id, name, sha, size, doc.page_count, {str(k): None if v is None else str(v) for k, v in (doc.metadata or {}).items()}, toc))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in DOCUMENT.split(", ")])

    return files.mapInPandas(parse, DOCUMENT)


def run_tool(files: DataFrame, tool: str, timeout: float = 600.0) -> DataFrame:
    """(manual_id, xhtml): the word boxes that the command-line tool finds; the document goes in and out by pipes."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = []
            for content in frame["content"]:
                done = subprocess.run([tool, "-bbox-layout", "-enc", "UTF-8", "-", "-"], input=content, capture_output=True, timeout=timeout)
                if done.returncode:
                    raise RuntimeError(f"{tool} failed: {done.stderr.decode('utf-8', 'replace')[:500]}")
                texts.append(done.stdout.decode("utf-8", "replace"))
            yield pd.DataFrame({"manual_id": frame["manual_id"], "xhtml": texts})

    return files.select("manual_id", "content").mapInPandas(run, "manual_id string, xhtml string")


def page_id(index: Column) -> Column:
    return F.format_string("p%04d", index + 1)


def _box(c: Column, size: int = 4) -> Column:
    """The first numbers of a box or point, to three decimals; null where there are too few."""
    return F.when(F.size(c) >= size, F.transform(F.slice(c, 1, size), lambda x: F.round(x, 3)))


def span_text(span: Column) -> Column:
    """The characters of a span, joined; its text where it has no characters."""
    return F.when(span["chars"].isNotNull(), F.array_join(F.transform(span["chars"], lambda c: F.coalesce(c["c"], F.lit(""))), "")).otherwise(F.coalesce(span["text"], F.lit("")))


def native_blocks(raw: DataFrame) -> DataFrame:
    """(manual_id, page_index, blocks, text): the text blocks of raw pages with ids, order, spans and styles.

    A block's id follows from its place among all blocks, pictures too, so ids may leave gaps.
    """
    numbered = F.transform(F.coalesce("blocks", F.array()), lambda b, i: F.struct(b.alias("b"), i.alias("i")))
    one = raw.select("manual_id", "page_index", "sorted_numbers", F.explode_outer(F.filter(numbered, lambda x: x["b"]["type"] == 0)).alias("x"))
    block_id = F.format_string("%s-b%04d", page_id(F.col("page_index")), F.col("x.i") + 1)

    def span(line_id: Column):
        return lambda s, k: F.struct(
            F.format_string("%s-s%03d", line_id, k + 1).alias("id"), k.alias("index"), span_text(s).alias("text"), _box(s["bbox"]).alias("bbox"), _box(s["origin"], 2).alias("origin"),
            s["font"].alias("font"), s["size"].alias("size"), F.coalesce(s["flags"], F.lit(0)).alias("flags"), flag_names(F.coalesce(s["flags"], F.lit(0))).alias("flag_names"),
            F.lit("PYMUPDF_NATIVE").alias("extraction_method"), F.lit("HIGH").alias("extraction_confidence"),
        )

    def line(l: Column, j: Column) -> Column:
        line_id = F.format_string("%s-l%03d", F.col("block_id"), j + 1)
        return F.struct(line_id.alias("id"), j.alias("index"), _box(l["bbox"]).alias("bbox"), l["wmode"].alias("writing_mode"), _box(l["dir"], 2).alias("direction"), F.transform(F.coalesce(l["spans"], F.array()), span(line_id)).alias("spans"))

    place = F.array_position("sorted_numbers", F.col("x.b.number")).cast("int")
    built = one.withColumn("block_id", F.when(F.col("x").isNotNull(), block_id)).withColumn("lines", F.transform(F.coalesce("x.b.lines", F.array()), line))
    block = F.struct(
        F.col("block_id").alias("id"), F.lit("text").alias("type"), F.col("x.b.number").alias("source_block_number"), F.col("x.i").alias("raw_order_index"),
        F.when(place > 0, place - 1).alias("reading_order_index"), _box(F.col("x.b.bbox")).alias("bbox"), "lines",
    )
    shown = F.array_join(F.transform("lines", lambda l: F.array_join(F.transform(l["spans"], lambda s: s["text"]), "")), "\n")
    pages = built.groupBy("manual_id", "page_index").agg(F.sort_array(F.collect_list(F.when(F.col("x").isNotNull(), F.struct(F.col("x.i").alias("i"), block.alias("b"), shown.alias("t"))))).alias("all"))
    return pages.select("manual_id", "page_index", F.transform("all", lambda x: x["b"]).alias("blocks"), F.array_join(F.transform("all", lambda x: x["t"]), "\n\n").alias("text"))


def images(raw: DataFrame) -> DataFrame:
    """The pictures of raw pages with their bytes: dense numbers within the page, hash, size, colour space and bits."""
    own = raw.select("manual_id", "page_index", F.posexplode(F.filter("blocks", lambda b: b["type"] == 1)).alias("index", "b"))
    sha, ext = F.sha2("b.image", 256), sinks.extension(F.col("b.ext"))
    return own.select(
        "manual_id", "page_index", "index", F.format_string("%s-img%03d", page_id(F.col("page_index")), F.col("index") + 1).alias("id"), _box(F.col("b.bbox")).alias("bbox"), F.col("b.width").alias("width_px"),
        F.col("b.height").alias("height_px"), F.col("b.ext").alias("extension"), F.col("b.colorspace").alias("colorspace"), F.col("b.bpc").alias("bits_per_component"), sha.alias("asset_sha256"),
        F.concat(F.lit("assets/image-"), sha, F.lit("."), ext).alias("asset_path"), F.col("b.image").alias("content"),
    )


def word_blocks(words: DataFrame, pages: DataFrame) -> DataFrame:
    """(manual_id, page_index, blocks, text) of a second layer's words (as :func:`xhtml.parse` gives them), for all ``pages`` (manual_id, page_index)."""
    at = ["manual_id", "page_index", "block_index"]
    block_id = F.format_string("%s-b%04d", page_id(F.col("page_index")), F.col("block_index") + 1)
    line_id = F.format_string("%s-l%03d", block_id, F.col("line_index") + 1)
    span = F.struct(
        F.format_string("%s-s%03d", line_id, F.col("word_index") + 1).alias("id"), F.col("word_index").alias("index"), "text", "bbox", "unresolved_source_codes",
        F.lit("POPPLER_PDFTOTEXT").alias("extraction_method"), "extraction_confidence",
    )
    lines = words.groupBy(*at, "line_index").agg(F.sort_array(F.collect_list(F.struct(F.col("word_index").alias("k"), span.alias("s")))).alias("w"))
    line = F.struct(F.col("line_index").alias("k"), line_id.alias("id"), F.transform("w", lambda x: x["s"]).alias("spans"))
    blocks = lines.groupBy(*at).agg(F.sort_array(F.collect_list(line)).alias("l"))
    block = F.struct(F.col("block_index").alias("k"), block_id.alias("id"), F.lit("text").alias("type"), F.transform("l", lambda x: F.struct(x["id"].alias("id"), x["k"].alias("index"), x["spans"].alias("spans"))).alias("lines"))
    own = blocks.groupBy("manual_id", "page_index").agg(F.sort_array(F.collect_list(block)).alias("b"))
    own = own.select("manual_id", "page_index", F.transform("b", lambda x: F.struct(x["id"].alias("id"), x["type"].alias("type"), x["k"].alias("raw_order_index"), x["lines"].alias("lines"))).alias("blocks"))
    return pages.join(own, ["manual_id", "page_index"], "left").join(xhtml.page_texts(words), ["manual_id", "page_index"], "left").fillna("", ["text"])


def page_records(raw: DataFrame, documents: DataFrame, second: DataFrame | None = None, policy: str = "auto", versions: tuple[str, str] = ("", ""), tool_available: bool = False) -> DataFrame:
    """Canonical page records: the better text layer of each page with its quality, pictures and warnings.

    ``second`` has the second layer's xhtml (manual_id, xhtml); without one, ``tool_available`` tells whether there could be. A layer with other
    pages than the first fails. The blocks of the chosen layer are JSON text, as the two layers' spans differ.
    """
    keys = ["manual_id", "page_index"]
    layer = lambda df: quality.assess(df.withColumn("blocks", F.to_json("blocks"))).withColumn("page_id", page_id(F.col("page_index")))
    native = layer(native_blocks(raw))
    if second is None:
        alternative, available, policy = native, tool_available, "native"
    else:
        words = xhtml.parse(second)
        counted = second.select("manual_id", F.explode(F.sequence(F.lit(0), F.regexp_count("xhtml", F.lit("<page\\b")) - 1)).alias("page_index"))
        alternative, available = layer(word_blocks(words, counted)), True
    chosen = quality.choose_layer(native, alternative, policy, available).withColumnRenamed("status", "chosen")
    measures = ["status", *[f"{k}_count" for k in ("character", "non_whitespace", "control", "replacement", "alphabetic")], *[f"{k}_ratio" for k in ("control", "replacement", "alphabetic")]]
    both = native.select("manual_id", "page_id", "page_index", F.lit("PYMUPDF_NATIVE").alias("backend"), F.lit(versions[0]).alias("version"), F.struct(*measures).alias("quality"), "blocks")
    if second is not None:
        both = both.unionByName(alternative.select("manual_id", "page_id", "page_index", F.lit("POPPLER_PDFTOTEXT").alias("backend"), F.lit(versions[1]).alias("version"), F.struct(*measures).alias("quality"), "blocks"))
    text_layer = F.struct("backend", F.col("version").alias("backend_version"), "quality", "blocks").alias("text_layer")
    kept = chosen.join(both, ["manual_id", "page_id", "backend"]).select("manual_id", "page_id", "page_index", "warnings", text_layer)
    shown = images(raw).drop("content")
    listed = shown.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("index", F.struct(*[c for c in shown.columns if c not in (*keys, "index")]).alias("i")))).alias("all"))
    listed = listed.select(*keys, F.transform("all", lambda x: x["i"]).alias("images"))
    out = kept.join(raw.select(*keys, "width", "height", "rotation", F.coalesce("page_label", F.lit("")).alias("page_label")), keys).join(listed, keys, "left").join(documents.select("manual_id", F.col("sha256").alias("source_sha256")), "manual_id")
    return out.select(
        F.lit(SCHEMA_VERSION).alias("schema_version"), "source_sha256", "manual_id", F.col("page_id").alias("id"), F.col("page_index").alias("pdf_page_index"), (F.col("page_index") + 1).alias("pdf_page_number"),
        "page_label", "width", "height", "rotation", "text_layer", "images", "warnings",
    )


def second_layer_totals(second: DataFrame) -> DataFrame:
    """(manual_id, illegal_controls, unresolved_glyphs) of the second layer's xhtml."""
    lost = xhtml.parse(second).groupBy("manual_id").agg(F.sum(F.size("unresolved_source_codes")).alias("unresolved_glyphs"))
    return xhtml.diagnostics(second).join(lost, "manual_id", "left").fillna(0, ["unresolved_glyphs"])


def manifests(documents: DataFrame, pages: DataFrame, totals: DataFrame | None = None, versions: tuple[str, str] = ("", "")) -> DataFrame:
    """A nested manifest for each document: source, metadata, outline, summary by status and layer, second layer's totals, page files."""
    judged = pages.select("manual_id", F.col("text_layer.quality.status").alias("page_quality"), F.col("text_layer.backend").alias("backend"), "id")
    status = quality.overall_status(judged).select("manual_id", "overall_status")
    counted = lambda c: judged.groupBy("manual_id", c).agg(F.count("*").alias("n")).groupBy("manual_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(c, "n")))).alias(c))
    files = judged.groupBy("manual_id").agg(F.sort_array(F.collect_list(F.concat(F.lit("pages/"), "id", F.lit(".json")))).alias("page_files"))
    out = documents.join(status, "manual_id", "left").join(counted("page_quality"), "manual_id", "left").join(counted("backend"), "manual_id", "left").join(files, "manual_id", "left")
    second = F.lit(None).cast("struct<version:string,illegal_controls:bigint,unresolved_glyphs:bigint>")
    if totals is not None:
        out = out.join(totals, "manual_id", "left")
        second = F.when(F.col("illegal_controls").isNotNull(), F.struct(F.lit(versions[1]).alias("version"), "illegal_controls", "unresolved_glyphs"))
    outline = F.transform(F.coalesce("toc", F.array()), lambda e: F.struct(e["level"].alias("level"), e["title"].alias("title"), e["pdf_page_number"].alias("pdf_page_number"), F.when(e["pdf_page_number"] > 0, e["pdf_page_number"] - 1).alias("pdf_page_index")))
    return out.select(
        "manual_id", F.lit(SCHEMA_VERSION).alias("schema_version"), F.struct(F.lit("pagelode").alias("name"), F.lit(versions[0]).alias("native_version"), F.current_timestamp().alias("generated_at_utc")).alias("extractor"),
        F.struct("manual_id", "filename", "sha256", "size_bytes", "page_count").alias("source"), "pdf_metadata", outline.alias("toc"),
        F.struct("overall_status", F.col("page_quality").alias("page_status_counts"), F.col("backend").alias("backend_page_counts"), second.alias("second_layer")).alias("extraction_summary"), "page_files",
    )


def report(manifest: DataFrame) -> DataFrame:
    """(manual_id, report): a readable summary of each manifest, with the second layer's totals where there are any."""
    counts = lambda c: F.array_join(F.transform(F.sort_array(F.map_entries(c)), lambda e: F.format_string("  %s: %d page(s)", e["key"], e["value"])), "\n")
    summary, second = F.col("extraction_summary"), F.col("extraction_summary.second_layer")
    text = F.concat_ws(
        "\n", F.format_string("Extraction of %s", "source.filename"), F.format_string("Manual: %s", "manual_id"), F.format_string("Pages: %d", "source.page_count"), F.format_string("SHA-256: %s", "source.sha256"),
        F.format_string("Status: %s", summary["overall_status"]), F.lit("Text layers:"), counts(summary["backend_page_counts"]), F.lit("Page quality:"), counts(summary["page_status_counts"]),
        F.when(second.isNotNull(), F.format_string("Second layer: %s\n  control characters kept as lost ones: %d\n  lost glyphs: %d", second["version"], second["illegal_controls"], second["unresolved_glyphs"])),
    )
    return manifest.select("manual_id", text.alias("report"))


def extract(spark: SparkSession, path: str, out: str, policy: str = "auto", tool: str | None = None) -> DataFrame:
    """All PDF files of a folder to pages, assets, manifests and reports in ``out``; returns the manifests.

    The second layer is read only for manuals whose first one has a poor page, or for all, to policy ``poppler``.
    """
    if policy not in ("auto", "native", "poppler"):
        raise ValueError("policy must be auto, native or poppler")
    found = pdf.find_tool(tool)
    if policy == "poppler" and found is None:
        raise ValueError("policy poppler needs the tool")
    files = read_files(spark, path)
    read_raw(files).write.mode("overwrite").parquet(f"{out}/raw")
    raw = spark.read.parquet(f"{out}/raw")
    documents = read_documents(files)
    versions = (getattr(pdf.pymupdf, "__version__", ""), found[1] if found else "")
    second = None
    if found is None or policy == "native":
        pages = page_records(raw, documents, None, "native", versions, found is not None)
    else:
        wanted = files
        if policy == "auto":
            poor = quality.assess(native_blocks(raw)).where(F.col("status").isin("SUSPECT", "UNUSABLE")).select("manual_id").distinct()
            wanted = files.join(poor, "manual_id", "leftsemi")
        run_tool(wanted, found[0]).write.mode("overwrite").parquet(f"{out}/second")
        second = spark.read.parquet(f"{out}/second")
        with_second, without = (raw.join(second.select("manual_id"), "manual_id", how) for how in ("leftsemi", "left_anti"))
        pages = page_records(with_second, documents, second, policy, versions).unionByName(page_records(without, documents, None, "native", versions, True))
    sinks.write_pages(pages, f"{out}/pages")
    sinks.write_assets(images(raw).select("content", F.col("extension")), f"{out}/assets")
    made = manifests(documents, pages, None if second is None else second_layer_totals(second), versions)
    sinks.write_documents(made.select("manual_id", F.to_json(F.struct(*made.columns)).alias("document")), f"{out}/manifests")
    sinks.write_documents(report(made).withColumnRenamed("report", "document"), f"{out}/reports", "txt")
    return made
