"""Constraints checked batch by batch."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flatloom.plans.delta_checks import BatchChecks, Rules
from flatloom.queries.registry import query
from flatloom.schemas import Reference
from flatloom.scratch import new_path
from flatloom.sources.star_schema import table

_BATCHES = 3
_RULES = Rules(
    {"lines": ("l_orderkey", "l_linenumber"), "parts": ("p_partkey",)},
    (Reference("lines", "l_partkey", "parts", "p_partkey"),),
    {"lines": ("l_suppkey", "flag")},
)
# Copies of a key come in different batches, a part often after its lines, every fifth part never.
_LINES = "l_suppkey % 3"
_PARTS = "case when p_partkey % 5 = 0 then 9 else p_partkey % 3 end"


def _after(batch: int) -> str:
    lines, parts = f"(select * from lineitem where {_LINES} <= {batch})", f"(select p_partkey from part where {_PARTS} <= {batch})"
    return f"""
        select {batch} batch, 'primary_key' kind, 'lines(l_orderkey, l_linenumber)' target, count(*) violations
        from (select 1 from {lines} group by l_orderkey, l_linenumber having count(*) > 1)
        union all select {batch}, 'primary_key', 'parts(p_partkey)', 0
        union all select {batch}, 'foreign_key', 'lines.l_partkey -> parts', count(*)
        from {lines} where l_partkey not in (select p_partkey from {parts})
        union all select {batch}, 'not_null', 'lines.l_suppkey', count(*) filter (l_suppkey is null) from {lines}
        union all select {batch}, 'not_null', 'lines.flag', count(*) filter (l_returnflag = 'R') from {lines}"""


@query(" union all ".join(_after(b) for b in range(_BATCHES)))
def delta_checks(spark, sf_dir):
    """After each of three batches, what is violated; the batch is compared with keys of what came before."""
    lines = table(spark, sf_dir, "lineitem").withColumn("flag", F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")))
    lines = lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "flag")
    parts = table(spark, sf_dir, "part").select("p_partkey")
    checks = BatchChecks(spark, new_path(spark, "findings"), _RULES)
    reports = []
    for batch in range(_BATCHES):
        new = {"lines": lines.filter(f"{_LINES} = {batch}"), "parts": parts.filter(f"{_PARTS} = {batch}")}
        old = {"lines": lines.filter(f"{_LINES} < {batch}"), "parts": parts.filter(f"{_PARTS} < {batch}")}
        reports.append(checks.check(batch, new, old).select(F.lit(batch).alias("batch"), "*"))
    return reduce(DataFrame.unionByName, reports)
