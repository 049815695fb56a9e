"""Helpers of several operators: columns that clash, tables written once and read again."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from geoloom.session import scratch_path


def added_to(df: DataFrame, added: T.StructType) -> tuple[list[str], T.StructType]:
    """Columns of ``df`` that are not replaced by an added one of the same name, and the schema of the result."""
    names = {f.name.lower() for f in added}
    keep = [f for f in df.schema if f.name.lower() not in names]
    return [f.name for f in keep], T.StructType([*keep, *added])


def set_aside(df: DataFrame, names: Iterable[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with columns called like one of ``names`` renamed, and a function that gives them their names again."""
    taken = {n.lower() for n in names}
    moved = {c: f"_aside_{i}" for i, c in enumerate(df.columns) if c.lower() in taken}
    return df.withColumnsRenamed(moved), lambda out: out.withColumnsRenamed({v: k for k, v in moved.items()})


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, so that lost executors or a second use do not run it again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
