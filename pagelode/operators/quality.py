"""Text quality gate, choice between text layers, and summaries by manual."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelode.functions.text import character_counts, quality_status, status_rank


def assess(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds counts, ratios (six decimals) and the quality status of a text column."""
    out = df.withColumns(character_counts(F.col(text)))
    base = F.greatest("non_whitespace_count", F.lit(1)).cast("double")
    ratios = {f"{k}_ratio": F.round(F.col(f"{k}_count") / base, 6) for k in ("control", "replacement", "alphabetic")}
    return out.withColumns(ratios).withColumn("status", quality_status(F.col("non_whitespace_count"), F.col("control_count"), F.col("replacement_count")))


def choose_layer(native: DataFrame, alternative: DataFrame, policy: str = "auto", tool_available: bool = True) -> DataFrame:
    """One row for each page with the chosen layer and its warnings.

    Both inputs have (manual_id, page_id, status, control_ratio, replacement_ratio), one row for each page; the join
    fails where a page of either has no counterpart. The alternative counts for a manual only if the policy or a native page of
    it (SUSPECT or UNUSABLE) calls for it.
    """
    if policy not in ("auto", "native", "poppler"):
        raise ValueError("policy must be auto, native or poppler")
    if policy == "poppler" and not tool_available:
        raise ValueError("policy poppler needs the tool")
    keys = ["manual_id", "page_id"]
    names = ["status", "control_ratio", "replacement_ratio"]
    left = native.select(*keys, *[F.col(c).alias(f"native_{c}") for c in names], F.lit(True).alias("own"))
    right = alternative.select(*keys, *[F.col(c).alias(f"alt_{c}") for c in names], F.lit(True).alias("paired"))
    poor = F.col("native_status").isin("SUSPECT", "UNUSABLE")
    trouble = left.groupBy("manual_id").agg(F.bool_or(poor).alias("trouble"))
    both = left.join(right, keys, "full").join(trouble, "manual_id", "left")
    both = both.where(F.coalesce(F.col("paired") & F.col("own"), F.raise_error(F.lit("page counts of the text layers differ")).cast("boolean")))
    better = (status_rank(F.col("alt_status")) > status_rank(F.col("native_status"))) | (
        poor & ((F.col("alt_replacement_ratio") < F.col("native_replacement_ratio")) | (F.col("alt_control_ratio") < F.col("native_control_ratio")))
    )
    take = {"native": F.lit(False), "poppler": F.lit(True), "auto": F.col("trouble") & F.lit(tool_available) & better}[policy]
    chosen = both.withColumn("take", take)
    backend = F.when(F.col("take"), "POPPLER_PDFTOTEXT").otherwise("PYMUPDF_NATIVE")
    status = F.when(F.col("take"), F.col("alt_status")).otherwise(F.col("native_status"))
    return chosen.select(*keys, backend.alias("backend"), status.alias("status"), page_warnings(status, backend, F.col("native_status"), tool_available).alias("warnings"))


def page_warnings(status: Column, backend: Column, native_status: Column, tool_available: bool) -> Column:
    """Warning codes of a page, in fixed order."""
    missing = (backend == "PYMUPDF_NATIVE") & native_status.isin("SUSPECT", "UNUSABLE") & F.lit(not tool_available)
    return F.array_compact(
        F.array(
            F.when(status == "EMPTY", "no_machine_readable_text"),
            F.when(status == "SUSPECT", "text_requires_visual_validation"),
            F.when(status == "UNUSABLE", "do_not_create_semantic_units_from_this_page"),
            F.when(missing, "poppler_fallback_unavailable"),
        )
    )


def status_counts(pages: DataFrame) -> DataFrame:
    """Counts by status and by backend in one pass: (dimension, value, pages)."""
    counted = pages.groupingSets([["page_quality"], ["backend"]], "page_quality", "backend").agg(F.grouping("page_quality").alias("g"), F.count("*").alias("pages"))
    return counted.select(F.when(F.col("g") == 0, "status").otherwise("backend").alias("dimension"), F.when(F.col("g") == 0, F.col("page_quality")).otherwise(F.col("backend")).alias("value"), "pages")


def overall_status(pages: DataFrame) -> DataFrame:
    """(manual_id, pages, overall_status, native_problem): the status of each manual by its pages."""
    status = F.coalesce(F.col("page_quality"), F.lit(""))
    return pages.groupBy("manual_id").agg(
        F.count("*").alias("pages"),
        F.when(F.bool_or(status == "UNUSABLE"), "FAILED").when(F.bool_or(status == "SUSPECT"), "USABLE_WITH_WARNINGS").otherwise("USABLE").alias("overall_status"),
        F.bool_or(status.isin("SUSPECT", "UNUSABLE")).alias("native_problem"),
    )
