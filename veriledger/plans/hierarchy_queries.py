"""Hierarchies of credit lines as a whole, as queries with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veriledger.operators import hierarchy
from veriledger.plans.catalogue_queries import entities, violations_of
from veriledger.plans.catalogue_sql import union_of_rules, with_entities
from veriledger.specs.credit_line import CL_CHAINS

# Chains of twelve lines. Half of them continue below the first line of all, which so has very many children. Some first
# lines have themselves, the last of their chain or a line that does not exist as their parent; some rows state
# another root or level than they have.
_POSITION = "(o_orderkey % 12)"
_CHAIN = "floor(o_orderkey / 12)"
_MOVED = f"({_POSITION} > 5 and {_CHAIN} % 2 = 1)"
_FIRST = f"'L' || cast(cast({_CHAIN} * 12 as bigint) as string)"
_LINES = f"""
select 'L' || cast(o_orderkey as string) as credit_line_id,
  case when {_POSITION} = 0 and {_CHAIN} % 11 = 3 then 'L' || cast(o_orderkey + 11 as string)
    when {_POSITION} = 0 and {_CHAIN} % 13 = 5 then 'X' || cast(o_orderkey as string)
    when {_POSITION} = 0 and {_CHAIN} % 17 = 7 then 'L' || cast(o_orderkey as string)
    when {_POSITION} = 0 and {_CHAIN} % 2 = 0 then ' '
    when {_POSITION} = 0 then null
    when {_POSITION} = 6 and {_CHAIN} % 2 = 1 then 'L0'
    else 'L' || cast(o_orderkey - 1 as string) end as parent_credit_line_id,
  case when o_orderkey % 35 = 4 then 'L' || cast(o_orderkey - 1 as string) when {_MOVED} then 'L0'
    else {_FIRST} end as root_credit_line_id,
  cast(case when o_orderkey % 41 = 3 then null when o_orderkey % 43 = 5 then 40 when {_MOVED} then {_POSITION} - 5
    else {_POSITION} end as int) as level_number
from {{orders}}"""
DERIVED = {"DER_CL": _LINES}


def hierarchy_chains(spark: SparkSession, sf: str) -> DataFrame:
    """Root, level and state of every credit line."""
    lines = entities(spark, sf, ["DER_CL"], DERIVED)["DER_CL"]
    return hierarchy.resolved(lines, "credit_line_id", "parent_credit_line_id")


def rules_credit_line_chains(spark: SparkSession, sf: str) -> DataFrame:
    """Credit lines whose stated root or level is not that of their chain, or whose chain loops or leads nowhere."""
    return violations_of(spark, sf, CL_CHAINS, DERIVED)


QUERIES = {q.__name__: q for q in (hierarchy_chains, rules_credit_line_chains)}

# walks step by step; no chain has more than twelve lines, so twenty steps are a loop
_WALK = """chains as (
  with recursive up as (
    select credit_line_id as node, credit_line_id as at, 0 as steps from cl
    union all
    select node, c.parent_credit_line_id, steps + 1 from up join cl c on c.credit_line_id = up.at
    where trim(c.parent_credit_line_id) <> '' and steps < 20),
  last as (select node, max(steps) as steps from up group by node)
  select l.node, case when l.steps < 20 then u.at end as root, case when l.steps < 20 then l.steps end as depth,
    case when l.steps = 20 then 'loops' when exists (select 1 from cl c where c.credit_line_id = u.at) then 'ends'
      else 'missing' end as state
  from last l join up u on u.node = l.node and u.steps = l.steps)"""


def _with_chains(body: str) -> str:
    return with_entities({"cl": _LINES}, "").rstrip() + f",\n{_WALK}\n{body}"


HIERARCHY_SQL = {
    "hierarchy_chains": _with_chains("select node, root, depth, state from chains"),
    "rules_credit_line_chains": _with_chains(union_of_rules("cl join chains h on h.node = cl.credit_line_id", "credit_line_id", {
        "CHAIN_ROOT": "state = 'ends' and root_credit_line_id <> root",
        "CHAIN_LEVEL": "state = 'ends' and (level_number is null or level_number <> depth)",
        "CHAIN_LOOPS": "state = 'loops'",
        "CHAIN_PARENT": "state = 'missing'",
    })),
}
