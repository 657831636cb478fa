"""Readers of raw CSV files. Every field is text; missing-value marks become NULL."""

from __future__ import annotations

import csv as csv_text
from collections import defaultdict
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tarmac.functions.parsing import missing_to_null
from tarmac.operators.ingest import RAW_FLIGHT_COLUMNS, SOURCE_COLUMNS
from tarmac.sources import files


CARRIER = "OP_UNIQUE_CARRIER"


def _header(line: str) -> list[str]:
    """Unique column names of a header line; blank and repeated names get a position."""
    names: list[str] = []
    for i, cell in enumerate(next(csv_text.reader([line.lstrip("﻿")]), [])):
        name = cell.strip()
        names.append(name if name and name not in names else f"{name}_unnamed_{i}")
    return names


def _scan(spark: SparkSession, paths: list[str], columns: Iterable[str], multi_line: bool) -> DataFrame:
    schema = ", ".join(f"`{c}` string" for c in columns)
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(paths)
    )


def flight_files(
    spark: SparkSession, folder: str, year: int | None = None, file: str | None = None
) -> list[str]:
    """An explicit file, else the files of a year, else all CSV files of the folder."""
    pattern = file or f"{folder}/{f'{year}_*.csv' if year else '*.csv'}"
    found = files.glob(spark, pattern)
    if not found:
        raise FileNotFoundError(pattern)
    return found


def _by_header(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files grouped by their columns in order; only header lines are read."""
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for path, line in files.first_lines(spark, paths).items():
        groups[tuple(_header(line))].append(path)
    return dict(groups)


def split_by_columns(
    spark: SparkSession, paths: list[str]
) -> tuple[dict[tuple[str, ...], list[str]], list[str]]:
    """Usable files grouped by header, and the files that lack a required column.

    Files of different years differ in column order, so one scan is planned per
    distinct header, however many files share it.
    """
    groups, unusable = {}, []
    for columns, group in _by_header(spark, paths).items():
        if set(RAW_FLIGHT_COLUMNS) <= set(columns):
            groups[columns] = group
        else:
            unusable += group
    return groups, unusable


def read_flights_csv(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The 17 required raw columns, plus where each row stands in its file.

    Only those columns are parsed. Files without all of them are left out; ask
    `split_by_columns` for their names. A row's place is stable across task retries:
    block offsets order the blocks, scan positions the rows within a block.
    """
    groups, _ = split_by_columns(spark, paths)
    if not groups:
        raise ValueError("no file has the required columns")
    scans = []
    for columns, group in groups.items():
        scan = _scan(spark, group, columns, multi_line=False)
        scans.append(
            scan.selectExpr(
                *[f"{missing_to_null(c)} AS {c}" for c in RAW_FLIGHT_COLUMNS],
                f"_metadata.file_name AS {SOURCE_COLUMNS[0]}",
                f"_metadata.file_block_start AS {SOURCE_COLUMNS[1]}",
                f"monotonically_increasing_id() AS {SOURCE_COLUMNS[2]}",
            )
        )
    return reduce(DataFrame.unionByName, scans)


def read_carriers_csv(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The carrier column of every file that has one, whatever else the file lacks."""
    scans = [
        _scan(spark, group, columns, multi_line=False).selectExpr(f"{missing_to_null(CARRIER)} AS {CARRIER}")
        for columns, group in _by_header(spark, paths).items()
        if CARRIER in columns
    ]
    if not scans:
        raise ValueError("no file has the carrier column")
    return reduce(DataFrame.unionByName, scans)


def read_airports_csv(spark: SparkSession, pattern: str) -> DataFrame:
    """All columns under lower-case names; quoted fields may hold line breaks."""
    paths = files.glob(spark, pattern)
    if not paths:
        raise FileNotFoundError(pattern)
    scans = []
    for columns, group in _by_header(spark, paths).items():
        names = [c.lower() for c in columns]
        scan = _scan(spark, group, names, multi_line=True)
        scans.append(scan.selectExpr(*[f"{missing_to_null(f'`{c}`')} AS `{c}`" for c in names]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
