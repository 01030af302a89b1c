"""Named tables and SQL texts."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


class Tables:
    """Lazy access to a directory of parquet tables: ``Tables(spark, d).orders``."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory.rstrip("/")
        self._schemas: dict = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        path = f"{self.directory}/{name}.parquet"
        # The schema is read from the files once; later uses skip the footers.
        if name in self._schemas:
            return self.spark.read.schema(self._schemas[name]).parquet(path)
        df = self.spark.read.parquet(path)
        self._schemas[name] = df.schema
        return df


def register_views(spark: SparkSession, directory: str, names: list[str] | None = None) -> None:
    """Register every parquet table of ``directory`` as a temporary view."""
    tables = Tables(spark, directory)
    for name in names or TABLES:
        getattr(tables, name).createOrReplaceTempView(name)


def run_sql(spark: SparkSession, source: str, kind: str = "text", **args) -> DataFrame:
    """Run a SQL text (``kind='text'``) or ``.sql`` file (``kind='file'``).

    Keyword arguments are bound to the ``:name`` markers of the statement as
    typed values. Column names come back in lower case.
    """
    if kind not in ("text", "file"):
        raise ValueError(f"kind must be 'text' or 'file', not {kind!r}")
    text = Path(source).read_text() if kind == "file" else source
    out = spark.sql(text.strip().rstrip(";"), args=args or None)
    return out.toDF(*[c.lower() for c in out.columns])
