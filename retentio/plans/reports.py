"""Checkable reports over fitted models: one row of counts and property flags that an SQL
engine can state without fitting anything (rows scored, probabilities in range, better than
chance)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentio.operators import metrics as MT

#: AUC that a fitted model must reach on rows it has not seen
AUC_FLOOR = 0.6


def scored_report(scored: DataFrame, id_col: str, label: str, prob: str) -> DataFrame:
    """n_rows, n_ids, n_out_of_range (NULL counts), beats_floor."""
    p = F.col(prob)
    auc = MT.roc_auc(scored.select(F.col(label).alias("label"), p.alias("prob"))).scalar()
    return scored.agg(F.count("*").alias("n_rows"), F.count_distinct(id_col).alias("n_ids"),
                      F.sum(F.when(p.between(0, 1), 0).otherwise(1)).alias("n_out_of_range")
                      ).select("*", (auc >= AUC_FLOOR).alias("beats_floor"))
