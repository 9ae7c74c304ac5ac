"""Vectors on a grid of whole numbers, as the operators on integer scores and codes take them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 1 << 26  # components beyond it are set to it, so that sums of products fit 64 bits


def grid_vectors(vectors: DataFrame, id_column: str, vector_column: str, label_column: str, scale: int = 256) -> DataFrame:
    """(id, label, vec) with vec[i] = floor(scale * x), for vectors that are not empty and hold finite numbers only."""
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"), F.col(label_column).alias("label"), F.col(vector_column).cast("array<double>").alias("vec")
    )
    odd = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fit = F.col("vec").isNotNull() & (F.size("vec") > 0) & ~F.coalesce(odd, F.lit(True))
    whole = F.transform("vec", lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(float(LIMIT))), F.lit(-float(LIMIT)))).cast("int"))
    return rows.where(fit).withColumn("vec", whole)
