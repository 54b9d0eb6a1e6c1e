"""SQL over CSV files and stored tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sources.csvfiles import read_text_csv, table_name


def _run(spark: SparkSession, statements: str | Iterable[str]) -> DataFrame:
    result = None
    for statement in [statements] if isinstance(statements, str) else statements:
        result = spark.sql(statement)
    if result is None:
        raise ValueError("no statement given")
    return result


def query_csv(
    spark: SparkSession, statements: str | Iterable[str], files: Iterable[str], ignore_case: bool = False
) -> DataFrame:
    """Run one or several statements over CSV files; return the last result.

    Each file is a table named after it, without folder and extension; every
    value is text. Files may be joined; two files of one name are an error.

    With ``ignore_case`` the columns have a collation that ignores case, so that LIKE
    finds a name in any case, as do =, IN, joins and groups. Numbers in text: compared
    with a number, a text is cast to it, and one that is none is an error; write
    ``try_cast`` to have NULL instead.

    The names live in a session of their own with the caller's settings, so views of
    the caller are neither replaced nor dropped.
    """
    files = list(files)
    paths = {table_name(path): path for path in files}
    if len(paths) < len(files):
        raise ValueError(f"files of equal names: {sorted(files)}")
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    for name, path in paths.items():
        rows = read_text_csv(own, path)
        if ignore_case:
            rows = rows.select(*(F.collate(F.col(f"`{c}`"), "UTF8_LCASE").alias(c) for c in rows.columns))
        rows.createOrReplaceTempView(f"`{name}`")
    return _run(own, statements)


def query_tables(spark: SparkSession, statements: str | Iterable[str]) -> DataFrame:
    """The same over tables already stored in the catalog."""
    return _run(spark, statements)
