"""Sinks: overwrite writers and view registration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activity_mart.sources.readers import text_csv
from activity_mart.sources.store import side_by_side


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None
) -> DataFrame:
    """Overwrite ``path`` and return a frame over what was written, with the types of ``df``.

    CSV files hold every column, so that they are not partitioned.
    """
    writer = df.write.mode("overwrite")
    if partition_by and fmt != "csv":
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        # Keep padding and print a true null as an empty cell.
        writer.csv(
            path,
            header=True,
            escape='"',
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )
        back = text_csv(df.sparkSession, path, df.columns)
        return back.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in df.schema])
    writer.format(fmt).save(path)
    return df.sparkSession.read.format(fmt).schema(df.schema).load(path).select(*df.columns)


def write_tables(
    frames: dict[str, DataFrame], root: str, fmt: str = "parquet"
) -> dict[str, DataFrame]:
    """Overwrite ``root/<name>`` for every frame; the frames do not depend on each other."""
    spark = next(iter(frames.values())).sparkSession
    return side_by_side(
        spark,
        {
            name: lambda name=name, df=df: write_table(df, f"{root}/{name}", fmt)
            for name, df in frames.items()
        },
    )


def register_views(frames: dict[str, DataFrame]) -> None:
    """Make frames visible to ``spark.sql``; an existing name is replaced."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
