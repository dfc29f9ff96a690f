"""Small manuals in the engine's line layout: each line is (text, y, height)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

QUERY = "Rezistența conductorului"
LINE = (
    "manual_id string, page_id string, pdf_page_number int, page_index int, block_id string, line_id string, block_index int, line_index int, text string, "
    "bbox array<double>, page_width double, page_height double, page_quality string, backend string, ingested_at timestamp"
)
#: A contents page and the sections it names, the asked one on page 3 and the next on page 4.
CIRCUITS = [
    [("Cuprins", 48, 16)] + [(t, 96 + 21 * n, 11) for n, t in enumerate([
        "2.1. Sarcina electrică ..... 2", "2.2. Rezistența conductorului ..... 3", "2.3. Puterea becului ..... 4", "3.1. Magneți permanenți ..... 6",
        "3.2. Busola ..... 7", "4.1. Lentile subțiri ..... 9", "4.2. Ochiul omenesc ..... 11", "5.1. Sunetul ..... 12",
    ])],
    [("2.1. Sarcina electrică", 58, 20), ("Baghetele frecate se atrag sau se resping.", 130, 11)],
    [("2.2. Rezistența conductorului", 62, 20), ("Un fir lung se opune curentului mai mult.", 128, 11), ("Rezistența conductoarelor depinde de material.", 400, 11)],
    [("2.3. Puterea becului", 60, 20), ("Becul luminează mai tare.", 130, 11)],
]
#: Nothing here is near the title that is asked for.
OPTICS = [[("4.1. Lentile subțiri", 66, 20), ("Raza trece prin centrul lentilei.", 130, 11)]]
#: No contents page; a stray number among the text is no heading.
WIRES = [
    [("6 Rezistența conductorului și firele lungi", 64, 20), ("Aflăm despre rezistența conductorului.", 600, 11)],
    [("Un tabel", 82, 16), ("8 ;", 310, 11), ("Firele se încălzesc.", 352, 11)],
    [("7 Legarea firelor în serie", 68, 20), ("Becurile luminează mai slab.", 130, 11)],
]
#: Not quite the title.
SCRAP = [[("rezistența conductor", 100, 14)]]


def line_rows(manual_id: str, pages: list[list[tuple[str, float, float]]]) -> list[tuple]:
    return [
        (manual_id, f"p{p:04d}", p, p - 1, "b0001", f"p{p:04d}-b0001-l{k:03d}", 0, k - 1, text, [50.0, float(y), 500.0, float(y + h)], 595.0, 842.0, "GOOD", "PYMUPDF_NATIVE", None)
        for p, page in enumerate(pages, 1)
        for k, (text, y, h) in enumerate(page, 1)
    ]


def lines_of(spark: SparkSession, **manuals: list) -> DataFrame:
    return spark.createDataFrame([r for m, pages in manuals.items() for r in line_rows(m, pages)], LINE)


def pages_of(spark: SparkSession, **manuals: list) -> DataFrame:
    return spark.createDataFrame([(m, f"p{p:04d}") for m, pages in manuals.items() for p in range(1, len(pages) + 1)], "manual_id string, page_id string")
