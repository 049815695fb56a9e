"""Registered queries and the SQL each of them must equal.

A fixture is a select list over one driver table, written so that Spark and the SQL oracle both accept it;
``$F2`` inside an oracle text stands for the fixture as a sub-query.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

FIXTURES: dict[str, tuple[str, list[str]]] = {
    # points
    "F1": (
        "customer",
        [
            "c_custkey as id",
            "cast(400000 + (c_custkey * 7919) % 100000 as double) as x",
            "cast(4430000 + (c_custkey * 10007) % 100000 as double) as y",
            "c_mktsegment as attr",
        ],
    ),
    # boxes, some without geometry
    "F2": (
        "orders",
        [
            "o_orderkey as id",
            "cast(400000 + (o_orderkey * 7919) % 100000 as double) as x0",
            "cast(4430000 + (o_orderkey * 10007) % 100000 as double) as y0",
            "cast(50 + o_orderkey % 200 as double) as w",
            "cast(50 + o_orderkey % 300 as double) as h",
            "case when o_orderkey % 17 = 0 then 'null' when o_orderkey % 19 = 0 then 'empty' else 'polygon' end"
            " as geom_state",
            "o_orderpriority as part_key",
            "o_totalprice as attr",
        ],
    ),
    # line vertices; a line is one user's vertices within one thousand consecutive events
    "F3": (
        "events",
        [
            "concat(cast(user_id as varchar(20)), '-', cast(cast(floor(event_id / 1000) as bigint) as varchar(20)))"
            " as line_id",
            "event_id as seq",
            "cast(400000 + (event_id * 7919) % 100000 as double) as x",
            "cast(4430000 + (event_id * 10007) % 100000 as double) as y",
        ],
    ),
    # manifest entries
    "F4": (
        "part",
        [
            "p_partkey as seq",
            "case when p_partkey % 10 = 0 then 'raster' when p_partkey % 3 = 0 then 'vector' else 'tabular' end"
            " as kind",
            "p_name as title",
            "p_brand as theme",
            "case when p_partkey % 10 = 0 then null else p_size end as n_rows",
            "concat('ws', cast(p_partkey % 5 as varchar(10)), ':', p_name) as name",
        ],
    ),
    # one resource of one package
    "F5": (
        "documents",
        [
            "doc_id as pkg_id",
            "source as publisher",
            "lang as grp",
            "case when doc_id % 50 = 0 then 'SHP' when doc_id % 7 = 0 then 'HTML' else 'CSV' end as format",
            "case when doc_id % 11 = 0 then null else"
            " concat('https://storage.googleapis.com/b/', cast(doc_id as varchar(20)), '.csv') end as url",
        ],
    ),
    # catalog records
    "F6": (
        "events",
        [
            "event_id as id",
            "case when event_id % 13 = 0 then 'bad-table' else concat('v3.t', cast(event_id as varchar(20))) end"
            " as iceberg_table",
            "case when event_type = 'error' then 'ftp' when event_type = 'view' then 'attach'"
            " else 'read_parquet' end as access",
            "case when event_id % 7 = 0 then '{\"source\":\"s\"}' when event_id % 5 = 0 then null"
            " else '{\"source\":\"s\",\"processing\":\"p\"}' end as provenance",
        ],
    ),
    # raster cells, 128 columns wide
    "F7": (
        "events",
        [
            "event_id % 128 as col",
            "cast(floor(event_id / 128) as bigint) as cell_row",
            "case event_type when 'click' then 0 when 'error' then 1 when 'purchase' then 2"
            " when 'signup' then 3 else 4 end as value",
        ],
    ),
    # conversion ledger
    "F8": (
        "orders",
        [
            "o_orderkey as id",
            "1 + o_orderkey % 1000 as want",
            "case when o_orderkey % 23 = 0 then null when o_orderkey % 31 = 0 then -1"
            " when o_orderkey % 29 = 0 then o_orderkey % 1000 else 1 + o_orderkey % 1000 end as got",
        ],
    ),
    # layers with feature counts over all size tiers
    "F9": (
        "supplier",
        [
            "s_suppkey as layer_id",
            "concat('ws', cast(s_nationkey as varchar(10))) as ws",
            "cast(abs(floor(s_acctbal * s_acctbal / 20)) as bigint) as n_features",
        ],
    ),
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def fixture(spark: SparkSession, sf: str, name: str) -> DataFrame:
    source, columns = FIXTURES[name]
    return table(spark, sf, source).selectExpr(*columns)


def fixture_sql(name: str) -> str:
    source, columns = FIXTURES[name]
    return f"(select {', '.join(columns)} from {source})"


def oracle(text: str) -> str:
    """Puts the fixtures into an oracle text."""
    return re.sub(r"\$(F\d)\b", lambda m: fixture_sql(m[1]), text)


def query(key: str, sql: str | None = None):
    """Registers a query function, with its oracle where SQL can state the result."""

    def add(fn):
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = oracle(sql)
        return fn

    return add
