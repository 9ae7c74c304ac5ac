"""Daily means and rolling features kept up to date as deliveries arrive.

Stored are the sums and counts of every delivery per machine and day, and the feature rows. A delivery adds its own sums; then only the days it touches,
and for the machines it touches the next ``window - 1`` rows, are worked out and written again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from windvane.operators.windows import add_rolling_features
from windvane.session import cut_lineage, path_exists


@dataclass(frozen=True)
class DailyTable:
    """A feature table under ``path``: keys, ``Date``, the mean of every column, and its mean and deviation over the last ``window`` rows."""

    path: str
    keys: tuple[str, ...]
    ts: str
    cols: tuple[str, ...]
    window: int = 10

    def _sums(self, spark: SparkSession) -> DataFrame:
        return spark.read.option("basePath", f"{self.path}/sums").parquet(f"{self.path}/sums")

    def read(self, spark: SparkSession) -> DataFrame:
        """The feature rows as of the last delivery."""
        return spark.read.parquet(f"{self.path}/features")

    def update(self, delivery: str, rows: DataFrame) -> None:
        """Take in a delivery. Its name identifies it: the same delivery again replaces itself and counts once.

        Rows without a key or a time belong to no history and are left out; nulls do not count for a mean.
        """
        spark, keys = rows.sparkSession, list(self.keys)
        known = F.col(self.ts).isNotNull()
        for k in keys:
            known = known & F.col(k).isNotNull()
        own = rows.filter(known).groupBy(*keys, F.to_date(self.ts).alias("Date")).agg(
            *[F.sum(F.col(c).cast("double")).alias(f"{c}__s") for c in self.cols], *[F.count(c).alias(f"{c}__n") for c in self.cols]
        )
        touched = cut_lineage(own)
        if not touched.limit(1).count():
            return
        _replace(touched.withColumn("delivery", F.lit(delivery)), f"{self.path}/sums", ["Date", "delivery"])

        first = touched.groupBy(*keys).agg(F.min("Date").alias("_first"))
        exists = path_exists(spark, f"{self.path}/features")
        since = first.agg(F.min("_first")).first()[0]
        if exists and self.window > 1:
            # the earliest of the window - 1 rows before a machine's first touched day; only keys and dates are read
            line = Window.partitionBy(*keys).orderBy(F.desc("Date"))
            before = self.read(spark).select(*keys, "Date").join(first, keys).filter("Date < _first")
            before = before.withColumn("_k", F.row_number().over(line)).filter(F.col("_k") < self.window).agg(F.min("Date")).first()[0]
            since = min(since, before) if before else since
        sums = self._sums(spark).filter(F.col("Date") >= F.lit(since)).join(first.select(*keys), keys, "left_semi")
        daily = sums.groupBy(*keys, "Date").agg(*[F.try_divide(F.sum(f"{c}__s"), F.sum(f"{c}__n")).alias(c) for c in self.cols])
        daily = daily.join(touched.select(*keys, "Date", F.lit(1).alias("_touched")), [*keys, "Date"], "left")
        back = Window.partitionBy(*keys).orderBy("Date").rowsBetween(1 - self.window, 0)
        rolled = add_rolling_features(daily.withColumn("_new", F.max("_touched").over(back)).drop("_touched"), list(self.cols), keys, ["Date"], self.window)
        new = cut_lineage(rolled.filter("_new = 1").drop("_new"))
        if exists:
            # days are written whole: rows of other machines on these days stay as they are
            days = new.select("Date").distinct()
            rest = self.read(spark).join(days, "Date", "left_semi").join(new.select(*keys, "Date"), [*keys, "Date"], "left_anti")
            new = cut_lineage(new.unionByName(rest.select(*new.columns)))
        _replace(new, f"{self.path}/features", ["Date"])


def _replace(df: DataFrame, path: str, by: list[str]) -> None:
    """Write the partitions that ``df`` has, and leave the others as they are."""
    df.repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
