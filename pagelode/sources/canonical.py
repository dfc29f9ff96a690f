"""Canonical page JSON and manifests: nested pages to flat tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelode.functions.text import SPACE, stripped

SPAN = "struct<id:string,text:string,bbox:array<double>,font:string,size:double,flags:int,unresolved_source_codes:array<string>>"
LINE = f"struct<id:string,index:int,bbox:array<double>,spans:array<{SPAN}>>"
BLOCK = f"struct<id:string,type:string,raw_order_index:int,reading_order_index:int,bbox:array<double>,lines:array<{LINE}>>"
IMAGE = "struct<id:string,bbox:array<double>,width_px:int,height_px:int,extension:string,asset_sha256:string,asset_path:string>"
QUALITY = "struct<status:string,character_count:bigint,non_whitespace_count:bigint,control_count:bigint,replacement_count:bigint,alphabetic_count:bigint,control_ratio:double,replacement_ratio:double,alphabetic_ratio:double>"
PAGE = (
    "schema_version string, source_sha256 string, manual_id string, id string, pdf_page_index int, pdf_page_number int, page_label string, width double, height double, rotation int, "
    f"text_layer struct<backend:string,backend_version:string,quality:{QUALITY},blocks:array<{BLOCK}>>, images array<{IMAGE}>, warnings array<string>"
)
OUTLINE = "struct<level:int,title:string,pdf_page_number:int,pdf_page_index:int>"
MANIFEST = (
    "schema_version string, extractor struct<name:string,version:string>, source struct<manual_id:string,filename:string,sha256:string,size_bytes:bigint,page_count:int>, "
    f"pdf_metadata map<string,string>, toc array<{OUTLINE}>, extraction_summary struct<overall_status:string,page_status_counts:map<string,bigint>,backend_page_counts:map<string,bigint>>, page_files array<string>"
)


def read_pages(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Pages of one or many manuals, a JSON document in each line or, to ``multi_line``, in each file; missing fields are null."""
    return spark.read.schema(T._parse_datatype_string(PAGE)).option("multiLine", multi_line).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(path)


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(T._parse_datatype_string(MANIFEST)).option("multiLine", True).json(path)


def line_text(spans: F.Column) -> F.Column:
    """Spans joined as they are where any holds a blank, else (words) joined by blanks; stripped."""
    texts = F.transform(spans, lambda s: F.coalesce(s["text"], F.lit("")))
    words = F.array_join(F.filter(texts, lambda t: t != ""), " ")
    return stripped(F.when(F.forall(texts, lambda t: ~t.rlike("[ \n]")), words).otherwise(F.array_join(texts, "")))


def flatten(pages: DataFrame) -> DataFrame:
    """Lines with visible text of text blocks, with their place in the document."""
    layer = F.col("text_layer")
    blocks = pages.select(
        "manual_id", F.col("id").alias("page_id"), "pdf_page_number", F.col("pdf_page_index").alias("page_index"), F.col("width").alias("page_width"), F.col("height").alias("page_height"),
        layer["quality"]["status"].alias("page_quality"), layer["backend"].alias("backend"), F.posexplode(layer["blocks"]).alias("block_index", "block"),
    ).where("coalesce(block.type, 'text') = 'text'")
    lines = blocks.select("*", F.posexplode("block.lines").alias("line_index", "line"))
    block_id = F.coalesce("block.id", F.lit(""))
    out = lines.select(
        "manual_id", "page_id", "pdf_page_number", "page_index", block_id.alias("block_id"), F.coalesce("line.id", F.lit("")).alias("line_id"), "block_index", "line_index",
        line_text(F.coalesce("line.spans", F.array())).alias("text"), F.col("line.bbox").alias("bbox"), "page_width", "page_height", "page_quality", "backend",
    )
    return out.where(F.regexp_replace("text", SPACE, "") != "")


def outline(manifests: DataFrame) -> DataFrame:
    """Entries of the PDF outline; the page index is null where the page number is not above 0."""
    page = F.col("entry.pdf_page_number")
    own = manifests.select(F.col("source.manual_id").alias("manual_id"), F.posexplode("toc").alias("pos", "entry"))
    return own.select("manual_id", "pos", "entry.level", "entry.title", page.alias("pdf_page_number"), F.when(page > 0, page - 1).alias("pdf_page_index"))


def reading_order(pages: DataFrame) -> DataFrame:
    """(manual_id, page_id, block_id, raw_order_index, reading_order_index): blocks sorted from top left, by their boxes."""
    own = pages.select("manual_id", F.col("id").alias("page_id"), F.expr("transform(text_layer.blocks, b -> struct(b.bbox[1] AS y, b.bbox[0] AS x, b.raw_order_index AS raw, b.id AS id))").alias("b"))
    placed = own.select("manual_id", "page_id", F.posexplode(F.sort_array("b")).alias("reading_order_index", "b"))
    return placed.select("manual_id", "page_id", F.col("b.id").alias("block_id"), F.col("b.raw").alias("raw_order_index"), "reading_order_index")


def images(pages: DataFrame) -> DataFrame:
    """Image records with a dense index within their page."""
    own = pages.select("manual_id", F.col("id").alias("page_id"), F.posexplode("images").alias("index", "image"))
    image_id = F.format_string("%s-img%03d", "page_id", F.col("index") + 1)
    return own.select("manual_id", "page_id", image_id.alias("image_id"), "index", F.expr("transform(image.bbox, x -> round(x, 3))").alias("bbox"), "image.width_px", "image.height_px", "image.extension", "image.asset_sha256")
