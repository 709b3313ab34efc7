"""Where the query modules enter their queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str


QUERIES: dict[str, Query] = {}


def query(sql: str) -> Callable[[Run], Run]:
    """Register a function under its own name, next to the SQL it is checked against."""

    def register(run: Run) -> Run:
        QUERIES[run.__name__] = Query(run, " ".join(sql.split()))
        return run

    return register


# The wide entries, in SQL.
WIDE = """(
    select l_orderkey pid,
        cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey,
            l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
            l_linestatus, l_shipdate) - 1 as int) pos,
        l_suppkey track_key, s_name track_name, n_nationkey album_key, n_name album_name,
        r_regionkey artist_key, r_name artist_name
    from lineitem
    join supplier on l_suppkey = s_suppkey
    join nation on s_nationkey = n_nationkey
    join region on n_regionkey = r_regionkey)"""

# The last line item of each part within a slice, in SQL: rn = 1.
LAST_IN_SLICE = """(
    select l_orderkey // 1000 sl, l_partkey, l_suppkey, l_returnflag,
        row_number() over (partition by l_orderkey // 1000, l_partkey
            order by l_orderkey desc, l_linenumber desc, l_suppkey desc, l_quantity desc,
            l_extendedprice desc, l_discount desc, l_tax desc, l_returnflag desc,
            l_linestatus desc, l_shipdate desc) rn
    from lineitem)"""
