"""Writers: page records, manifests, assets, vector indexes, results and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_pages(pages: DataFrame, path: str) -> None:
    """Page records, one line of compact JSON each, in one folder for each manual."""
    pages.withColumn("manual", F.col("manual_id")).write.mode("overwrite").partitionBy("manual").json(path)


def write_table(df: DataFrame, path: str, by: str | None = "manual_id") -> None:
    """Parquet, in one folder for each value of ``by``."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).parquet(path)


def extension(c: Column) -> Column:
    return F.lower(F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit("bin")))


def distinct_assets(images: DataFrame) -> DataFrame:
    """(sha256, name, content): each content once, named by its hash; ``images`` has (content, extension)."""
    ext = extension(F.col("extension"))
    named = images.where(F.col("content").isNotNull()).select(F.sha2(F.col("content"), 256).alias("sha256"), ext.alias("ext"), "content")
    return named.groupBy("sha256", "ext").agg(F.first("content").alias("content")).select("sha256", F.concat(F.lit("image-"), "sha256", F.lit("."), "ext").alias("name"), "content")


def manifest_rows(manuals: DataFrame, counts: DataFrame) -> DataFrame:
    """(manual_id, manifest): a JSON document for each manual; ``counts`` has (manual_id, dimension, value, pages)."""
    maps = counts.where(F.col("value").isNotNull()).groupBy("manual_id", "dimension").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("value", "pages")))).alias("m"))
    wide = maps.groupBy("manual_id").agg(F.first(F.when(F.col("dimension") == "status", F.col("m")), True).alias("page_status_counts"), F.first(F.when(F.col("dimension") == "backend", F.col("m")), True).alias("backend_page_counts"))
    out = manuals.join(wide, "manual_id", "left")
    source = F.struct("manual_id", "filename", "sha256", "size_bytes", "page_count")
    summary = F.struct("overall_status", "page_status_counts", "backend_page_counts")
    return out.select("manual_id", F.to_json(F.struct("schema_version", F.struct(F.col("extractor_version").alias("version")).alias("extractor"), source.alias("source"), summary.alias("extraction_summary"))).alias("manifest"))


def _folder(path: str):
    """The file system and folder of a path, for writing from any executor."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))


def _write_named(df: DataFrame, path: str, keep: bool) -> None:
    """Rows (name, content binary) as files of a folder, written where the rows are; with ``keep``, names that stand there stay."""

    def write(rows) -> None:
        from pyarrow import fs

        system, folder = _folder(path)
        system.create_dir(folder, recursive=True)
        for row in rows:
            target = f"{folder}/{row[0]}"
            if keep and system.get_file_info(target).type == fs.FileType.File:
                continue
            with system.open_output_stream(target) as f:
                f.write(bytes(row[1]))

    df.select("name", "content").foreachPartition(write)


def write_assets(images: DataFrame, path: str) -> None:
    """Each distinct content once, as image-<hash>.<extension>; what was written before stays."""
    _write_named(distinct_assets(images), path, keep=True)


def write_documents(documents: DataFrame, path: str, kind: str = "json") -> None:
    """Rows (manual_id, document text) as one UTF-8 file for each manual, a newline at the end."""
    name = F.concat(F.regexp_replace("manual_id", r"[^\w.-]+", "_"), F.lit(f".{kind}"))
    _write_named(documents.select(name.alias("name"), F.encode(F.concat("document", F.lit("\n")), "UTF-8").alias("content")), path, keep=False)
