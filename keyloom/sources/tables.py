"""Table sinks, text output and ad-hoc SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Rows per insert statement, and rows that the record manager shows of an ad-hoc query; a caller may ask for them.
INSERT_BATCH = 200
QUERY_LIMIT = 256


def write_table(df: DataFrame, target: str, mode: str = "append", partition_by: list[str] | None = None, **jdbc) -> None:
    """Write to a Parquet folder, or over JDBC when ``target`` is a ``jdbc:`` address and ``dbtable`` is given."""
    if target.startswith("jdbc:"):
        options = {"url": target, "batchsize": str(INSERT_BATCH), **{k: str(v) for k, v in jdbc.items()}}
        df.write.format("jdbc").options(**options).mode(mode).save()
        return
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(target)


def row_text(df: DataFrame) -> Column:
    """A row's values joined by ``|``; null is empty."""
    return F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns])


def rows_as_text(df: DataFrame) -> DataFrame:
    return df.select(row_text(df).alias("row_text"))


def export_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with header: null is empty, values with quote, comma or newline are quoted, quotes doubled."""
    (
        df.write.mode(mode).option("header", "true").option("quote", '"').option("escape", '"')
        .option("nullValue", "").option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)
    )


class QueryText:
    """Runs SQL text over the session's tables; without text the last one runs again."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.last: str | None = None

    def set(self, sql: str) -> None:
        self.last = sql

    def run(self, sql: str | None = None, limit: int | None = None) -> DataFrame:
        self.last = sql or self.last
        if self.last is None:
            raise ValueError("no query text is set")
        rows = self.spark.sql(self.last)
        return rows_as_text(rows if limit is None else rows.limit(limit))


def query_text(spark: SparkSession, sql: str, limit: int | None = None) -> DataFrame:
    """The rows of an SQL text, all of them unless ``limit`` is given."""
    return QueryText(spark).run(sql, limit)
