"""Title similarity: token overlap, token runs and sequence similarity."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from pagelode.functions.text import contains_run

LEAST_TITLE = 0.42


@pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching-block similarity of two strings in [0, 1]; the order of the arguments matters."""
    known: dict[tuple[str, str], float] = {}
    out = []
    for pair in zip(a, b):
        if pair not in known:
            known[pair] = SequenceMatcher(None, *pair).ratio()
        out.append(known[pair])
    return pd.Series(out, dtype="float64")


#: Else the optimizer pushes filters on a score below a distinct and evaluates the similarity twice.
sequence_ratio = sequence_ratio.asNondeterministic()


def _tokens(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda w: w != "")


def jaccard(a: Column, b: Column) -> Column:
    """Overlap of two token sets: 1 if both are empty, 0 if one is."""
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(both, F.lit(1)))


def lexical_scores(pairs: DataFrame, query: str = "query", title: str = "title") -> DataFrame:
    """Adds exact, jaccard, containment and the upper bound of the score; empty sides score 0 everywhere."""
    q, t = F.col(query), F.col(title)
    qt, tt = _tokens(q), _tokens(t)
    query_short = F.size(qt) <= F.size(tt)
    short, long = F.when(query_short, q).otherwise(t), F.when(query_short, t).otherwise(q)
    run = (F.least(F.size(qt), F.size(tt)) >= 2) & contains_run(long, short)
    filled = (q != "") & (t != "")
    la, lb = F.length(q), F.length(t)
    return pairs.withColumns(
        {
            "exact": filled & (q == t),
            "jaccard": F.when(filled, jaccard(qt, tt)).otherwise(0.0),
            "containment": F.when(filled & run, 0.75 + 0.25 * F.length(short) / F.greatest(F.length(long), F.lit(1))).otherwise(0.0),
            "ratio_bound": F.when(filled, 2 * F.least(la, lb) / F.greatest(la + lb, F.lit(1))).otherwise(0.0),
        }
    )


def title_scores(pairs: DataFrame, query: str = "query", title: str = "title", least: float = LEAST_TITLE) -> DataFrame:
    """Adds title_score and title_reasons, and keeps the pairs that score ``least`` and more.

    Exact pairs and pairs that cannot reach ``least`` never come to the Python similarity: sequence similarity is at
    most 2 min(la, lb) / (la + lb).
    """
    scored = lexical_scores(pairs, query, title)
    exact = scored.where("exact").withColumns({"title_score": F.lit(1.0), "title_reasons": F.array(F.lit("normalized_exact_title"))})
    open_ = scored.where(~F.col("exact") & ((F.col("containment") > 0) | (0.55 * F.col("jaccard") + 0.45 * F.col("ratio_bound") >= least)))
    rated = open_.withColumn("ratio", sequence_ratio(F.col(query), F.col(title)))
    score = F.least(F.lit(1.0), F.greatest(0.55 * F.col("jaccard") + 0.45 * F.col("ratio"), F.col("containment")))
    reasons = F.array_compact(
        F.array(
            F.when(F.col("containment") > 0, "normalized_token_containment"),
            F.when(F.col("jaccard") >= 0.8, "high_token_overlap"),
            F.when(F.col("ratio") >= 0.85, "high_sequence_similarity"),
        )
    )
    rated = rated.withColumns({"title_score": score, "title_reasons": reasons}).where(F.col("title_score") >= least).drop("ratio")
    return exact.unionByName(rated).drop("exact", "jaccard", "containment", "ratio_bound")
