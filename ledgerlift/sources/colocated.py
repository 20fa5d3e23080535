"""Tables dealt into the same buckets by the application they belong to, so that repairs need no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64


class Colocated:
    """Tables of a catalog, bucketed and sorted by one key each, in equally many buckets.

    Joins of two of them on these keys read bucket by bucket.  Rows without a key would all fall into
    one bucket; they are kept apart, unbucketed, and never join.  A key that a large part of the rows
    share makes its bucket as large: such tables are better repaired by a plain join, which AQE splits.
    """

    def __init__(self, spark: SparkSession, folder: str, prefix: str, buckets: int = BUCKETS):
        self.spark, self.folder, self.prefix, self.buckets = spark, folder.rstrip("/"), prefix, buckets
        self.keys: dict[str, str] = {}

    def put(self, name: str, df: DataFrame, key: str) -> None:
        """Store a table under its key; both parts replace what was there."""
        with_key = F.col(f"`{key}`").isNotNull()
        dealt = df.where(with_key).repartition(self.buckets, F.col(f"`{key}`"))
        kept = dealt.write.mode("overwrite").bucketBy(self.buckets, key).sortBy(key)
        kept.option("path", f"{self.folder}/{name}/keyed").saveAsTable(self._table(name))
        df.where(~with_key).write.mode("overwrite").parquet(f"{self.folder}/{name}/loose")
        self.keys[name] = key

    def keyed(self, name: str) -> DataFrame:
        return self.spark.table(self._table(name))

    def loose(self, name: str) -> DataFrame:
        """The rows without a key."""
        return self.spark.read.schema(self.keyed(name).schema).parquet(f"{self.folder}/{name}/loose")

    def read(self, name: str) -> DataFrame:
        return self.keyed(name).unionByName(self.loose(name))

    def drop(self) -> None:
        """Forget the tables; their files stay."""
        for name in self.keys:
            self.spark.sql(f"DROP TABLE IF EXISTS `{self._table(name)}`")
        self.keys.clear()

    def _table(self, name: str) -> str:
        return f"{self.prefix}_{name}"
