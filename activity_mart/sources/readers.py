"""Readers for delivered extracts.

Nothing infers types: every CSV column arrives as text, so leading zeros and
broken numbers survive until an explicit cast decides about them.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from pathlib import Path

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activity_mart.contracts import NULL_TOKENS, STATE_REGIONS, ExtractSpec
from activity_mart.functions.text import snake_case


_QUOTING = {"sep": ",", "quote": '"', "escape": '"', "encoding": "UTF-8"}
_HEADERS_AT_ONCE = 16


def load_specs(path: str, spark: SparkSession | None = None) -> dict[str, ExtractSpec]:
    """Table specifications from a JSON file; a missing file is fatal.

    With ``spark`` the path may be in any store that Spark reads, else it is a file of the driver.
    """
    if spark is not None:
        text = spark.read.text(path, wholetext=True).first().value
    else:
        file = Path(path)
        if not file.exists():
            raise FileNotFoundError(f"table specification not found: {path}")
        text = file.read_text(encoding="utf-8")
    tables = json.loads(text)["tables"]
    return {
        name: ExtractSpec(name, table["sheet"], dict(table["columns"]), tuple(table["required_text"]))
        for name, table in tables.items()
    }


def text_csv(
    spark: SparkSession, files: str | list[str], names: Sequence[str], mode: str = "FAILFAST", quoted_line_breaks: bool = False
) -> DataFrame:
    """CSV files with one header as text columns ``names``; the header line itself is skipped."""
    text = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return spark.read.schema(text).csv(files, header=True, mode=mode, multiLine=quoted_line_breaks, **_QUOTING)


def files_by_header(spark: SparkSession, path: str, quoted_line_breaks: bool = False) -> dict[tuple[str, ...], list[str]]:
    """The files of a delivery, grouped by their header line.

    Listing reads no content. Spark takes the columns of many files from the first one, so each
    file is asked for its own: a job that reads its first lines, several at a time. Files without a byte have no header
    and are left out.
    """
    listed = spark.read.format("binaryFile").load(path).where("length > 0").select("path")
    # One entry a file, as any listing by Spark keeps on the driver.
    files = sorted(row.path for row in listed.collect())

    def header(file: str) -> tuple[str, ...]:
        return tuple(spark.read.csv(file, header=True, inferSchema=False, multiLine=quoted_line_breaks, **_QUOTING).columns)

    with ThreadPoolExecutor(max_workers=_HEADERS_AT_ONCE) as pool:
        headers = list(pool.map(inheritable_thread_target(spark)(header), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, names in zip(files, headers, strict=True):
        groups.setdefault(names, []).append(file)
    return groups


def read_by_header(
    spark: SparkSession,
    path: str,
    build: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    absent: Callable[[Sequence[str]], list[str]] = lambda names: [],
    mode: str = "FAILFAST",
    quoted_line_breaks: bool = False,
) -> DataFrame:
    """One frame over CSV files whose columns differ in order or number.

    Files with one header are one scan with that header's columns; ``build`` is applied to each
    scan, and the results are united by name, so a value can't reach another column's place.
    ``absent`` names the columns that a header lacks; any such file is an error.
    """
    groups = files_by_header(spark, path, quoted_line_breaks)
    lacking = {files[0]: gone for names, files in groups.items() if (gone := absent(names))}
    if lacking:
        raise ValueError("; ".join(f"{file} has no column {', '.join(gone)}" for file, gone in lacking.items()))
    if not groups:
        raise ValueError(f"{path} has no file with a header")
    parts = [build(text_csv(spark, files, names, mode, quoted_line_breaks)) for names, files in groups.items()]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)


def read_extract(
    spark: SparkSession, path: str, fmt: str = "csv", spec: ExtractSpec | None = None, quoted_line_breaks: bool = False
) -> DataFrame:
    """One delivered extract with its own headers, CSV columns all text; a broken row aborts.

    The files of a delivery may order their columns differently, and some may have columns that
    others lack: those are null there. With ``spec``, every file must have the columns it needs.
    ``quoted_line_breaks`` reads line breaks inside quotes as part of a value; a file is then one task.
    """
    if fmt != "csv":
        return spark.read.format(fmt).load(path)

    def absent(names: Sequence[str]) -> list[str]:
        if spec is None:
            return []
        there = {snake_case(spec.columns.get(name, name)) for name in names}
        return [name for name in spec.required if name not in there]

    return read_by_header(spark, path, absent=absent, quoted_line_breaks=quoted_line_breaks)


def read_extracts(
    spark: SparkSession, specs: dict[str, ExtractSpec], root: str, fmt: str = "csv", quoted_line_breaks: bool = False
) -> dict[str, DataFrame]:
    """Every configured extract from ``root/<section>``."""
    return {name: read_extract(spark, f"{root}/{spec.section}", fmt, spec, quoted_line_breaks) for name, spec in specs.items()}


def normalize_columns(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    """Apply the header map, then snake-case every name; clashes are an error."""
    names = [snake_case(renames.get(name, name)) for name in df.columns]
    clashes = sorted({name for name in names if names.count(name) > 1})
    if clashes:
        raise ValueError(f"columns share a name after renaming: {', '.join(clashes)}")
    return df.toDF(*names)


def load_csv(spark: SparkSession, path: str, schema: T.StructType, quoted_line_breaks: bool = False) -> DataFrame:
    """Bulk load with a fixed layout: blanks trimmed, null tokens to null, bad rows abort.

    Columns are taken by place and the header line is skipped, whatever it says. ``quoted_line_breaks``
    reads line breaks inside quotes as part of a value; a file is then one task.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    rows = spark.read.schema(text).csv(
        path, header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True, mode="FAILFAST", multiLine=quoted_line_breaks, **_QUOTING
    )
    return rows.select(
        *[
            F.when(~F.col(f.name).isin(*NULL_TOKENS), F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def typed_import(
    spark: SparkSession, path: str, schema: T.StructType, quoted_line_breaks: bool = False, strict: bool = False
) -> DataFrame:
    """CSV with a promoted header and typed columns; a value that does not convert is null.

    Columns are found by the header of each file, in any order; others are left out, and one that any
    file lacks is an error. A row with fewer values than its header has nulls at the end, one with more loses
    the surplus; ``strict`` aborts on either. ``quoted_line_breaks`` reads line breaks inside quotes as part of
    a value; a file is then read by one task, as it can't be split at line ends.
    """

    def typed(rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields])

    def absent(names: Sequence[str]) -> list[str]:
        return [f.name for f in schema.fields if f.name not in names]

    return read_by_header(spark, path, typed, absent, "FAILFAST" if strict else "PERMISSIVE", quoted_line_breaks)


def state_regions(spark: SparkSession) -> DataFrame:
    """The fixed state to region lookup."""
    return spark.createDataFrame(sorted(STATE_REGIONS.items()), "state string, region string")
