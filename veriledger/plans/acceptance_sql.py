"""DuckDB text of the acceptance queries."""

ORACLE_SQL = {
    "stage_union_by_source": """
select o_orderkey, case o_orderstatus when 'O' then 'CMS' when 'F' then 'TFS' else 'TRS' end as src_stm, o_totalprice from orders
""",
    "clear_space_to_null": """
select o_orderkey, nullif(trim(case when o_orderpriority='4-NOT SPECIFIED' then '  ' else o_orderpriority end),'') as priority from orders
""",
    "constant_and_fill": """
select c_custkey, '20240131' as msr_prd_id, coalesce(case when c_custkey%7=0 then null else c_mktsegment end,'006') as org_id from customer
""",
    "projection_order": """
select l_orderkey as ac_id, l_linenumber as seq, l_extendedprice as amt from lineitem
""",
    "amount_cast": """
select l_orderkey, l_linenumber, l_partkey, try_cast(cast(l_extendedprice as varchar) as double) as amt from lineitem
""",
    "entity_id_mapping": """
select o.o_orderkey, coalesce(m.n_nationkey, -1) as ent_id from orders o left join (select c_custkey, n_nationkey from customer join nation on c_nationkey=n_nationkey where n_regionkey<3) m on o.o_custkey=m.c_custkey
""",
    "period_advance_daily": """
select distinct cast(o_orderdate as date) as d, cast(cast(o_orderdate as date) + interval 1 day as date) as next_d from orders
""",
    "period_advance_month_end": """
select distinct last_day(cast(o_orderdate as date)) as d, last_day(cast(last_day(cast(o_orderdate as date)) + interval 1 day as date)) as next_d from orders
""",
    "duplicate_skip": """
select l_orderkey, l_linenumber, l_partkey from lineitem l where not exists (select 1 from orders o where o.o_orderkey=l.l_orderkey and o.o_orderstatus='F')
""",
    "duplicate_report": """
select l_orderkey, l_linenumber, count(*) as n from lineitem group by l_orderkey, l_linenumber having count(*)>1
""",
    "record_count_control": """
select coalesce(a.src, b.src) as src, coalesce(a.n, 0) as n, coalesce(b.expected, 0) as expected, coalesce(a.n, 0)=coalesce(b.expected, 0) as ok from (select o_orderstatus as src, count(*) as n from orders group by 1) a full join (select l_linestatus as src, count(*) as expected from lineitem where l_linenumber=1 group by 1) b on a.src=b.src
""",
    "prevalidation_flags": """
select c_custkey, c_acctbal<0 as r1, c_mktsegment='MACHINERY' as r2 from customer
""",
    "prevalidation_share": """
select c_mktsegment, sum(case when c_acctbal<0 then 1 else 0 end) as bad, count(*) as n, sum(case when c_acctbal<0 then 1 else 0 end)/cast(count(*) as double) as share from customer group by c_mktsegment
""",
    "v1_required_if": """
select o_orderkey from orders where o_orderstatus='F' and nullif(case when o_orderpriority='4-NOT SPECIFIED' then '' else o_orderpriority end,'') is null
""",
    "v1_required_if_lookup": """
select l_orderkey, l_linenumber, l_partkey from lineitem join orders on l_orderkey=o_orderkey where o_orderstatus='P' and nullif(case when l_returnflag='N' then '' else l_returnflag end,'') is null
""",
    "v2_non_negative": """
select c_custkey, c_acctbal from customer where not (c_acctbal>=0)
""",
    "v2_between": """
select l_orderkey, l_linenumber, l_partkey, l_quantity from lineitem where not (l_quantity between 5 and 45)
""",
    "v3_date_order": """
select l_orderkey, l_linenumber, l_partkey, l_shipdate, o_orderdate from lineitem join orders on l_orderkey=o_orderkey where l_shipdate<o_orderdate
""",
    "v4_iff_blank": """
select o_orderkey from orders where (o_orderstatus='F') <> (case when o_orderpriority='4-NOT SPECIFIED' then false else true end)
""",
    "v5_either_present": """
select l_orderkey, l_linenumber, l_partkey from lineitem where nullif(l_returnflag,'N') is null and nullif(l_linestatus,'O') is null
""",
    "v6_ref_integrity": """
select o_orderkey, o_custkey from orders o where not exists (select 1 from customer c where c.c_custkey=o.o_custkey and c.c_mktsegment<>'MACHINERY')
""",
    "v7_conditional_ref": """
select event_id, user_id from events e where event_type='purchase' and not exists (select 1 from customer c where c.c_custkey=e.user_id and c.c_acctbal>=0)
""",
    "v8_either_parent": """
select e.event_id from events e where not exists (select 1 from (select c_custkey as k from customer where c_mktsegment='BUILDING' union select s_suppkey from supplier) p where p.k=e.user_id)
""",
    "v9_must_be_reported": """
select o_orderkey from orders o where not exists (select 1 from lineitem l where l.l_orderkey=o.o_orderkey)
""",
    "v10_must_not_be_reported": """
select l_orderkey, l_linenumber, l_partkey from lineitem l where exists (select 1 from orders o where o.o_orderkey=l.l_orderkey and o.o_orderstatus='P')
""",
    "v11_reconcile_ge": """
select a.o_orderkey, a.t, b.s, b.s>=a.t as ok from (select o_orderkey, cast(o_totalprice as decimal(18,2)) as t from orders) a join (select l_orderkey, sum(cast(l_extendedprice as decimal(18,2))) as s from lineitem group by 1) b on a.o_orderkey=b.l_orderkey
""",
    "v11_reconcile_equal_quarter": """
select l_returnflag, sum(cast(l_extendedprice as decimal(18,2)))-sum(cast(l_tax as decimal(18,2))) as net, sum(cast(l_extendedprice as decimal(18,2)))=sum(cast(l_tax as decimal(18,2))) as ok from lineitem where month(l_shipdate) in (3,6,9,12) group by l_returnflag
""",
    "v12_check_digit": """
with t as (select c_custkey, lpad(cast(c_custkey as varchar),13,'1') as id from customer) select c_custkey, (11-(13*cast(substr(id,1,1) as int)+12*cast(substr(id,2,1) as int)+11*cast(substr(id,3,1) as int)+10*cast(substr(id,4,1) as int)+9*cast(substr(id,5,1) as int)+8*cast(substr(id,6,1) as int)+7*cast(substr(id,7,1) as int)+6*cast(substr(id,8,1) as int)+5*cast(substr(id,9,1) as int)+4*cast(substr(id,10,1) as int)+3*cast(substr(id,11,1) as int)+2*cast(substr(id,12,1) as int))%11)%10=cast(substr(id,13,1) as int) as ok from t
""",
    "v13_typed_value": """
select event_id from events where event_type in ('error','view') and try_cast(case when event_id%5=0 then 'n/a' else cast(value as varchar) end as double) is null
""",
    "v14_sentinel_after_cutoff": """
select o_orderkey from orders where o_orderdate>=timestamp '2000-10-01' and o_orderpriority='4-NOT SPECIFIED'
""",
    "v15_code_list": """
select p_partkey, p_type from part p where not exists (select 1 from (values ('PROMO'),('SMALL'),('LARGE')) v(t) where v.t=p.p_type)
""",
    "v15_list_from_table": """
select p_partkey, p_brand || p_type as kind from part where p_size > 40 and p_brand || p_type not in (select p_brand || p_type from part where p_size < 10)
""",
    "v16_hierarchy": """
with h as (select c_custkey as id, case when c_custkey<10 then null when c_custkey%10=3 then -c_custkey else c_custkey//10 end as parent, case when c_custkey<5 then 0 when c_custkey%10=7 then null else 1 end as lvl from customer) select id from h where (parent is null and coalesce(lvl, -1)<>0) or (parent is not null and not exists (select 1 from h p where p.id=h.parent))
""",
    "v17_self_reference": """
select o_orderkey, o_custkey from orders where o_orderkey%1000=o_custkey%1000
""",
    "v18_other_described": """
select p_partkey from part where p_type='PROMO' and nullif(case when p_size<10 then '' else p_name end,'') is null
""",
    "violation_summary": """
select rule, count(*) as n from (select 'CN1' as rule from customer where c_acctbal<0 union all select 'RI1' from orders o where not exists (select 1 from lineitem l where l.l_orderkey=o.o_orderkey)) v group by rule
""",
    "gate": """
select sum(n)=0 as passed, sum(n) as violations from (select count(*) as n from customer where c_acctbal<0 union all select count(*) from orders where o_totalprice<0) v
""",
    "violation_by_source": """
select o_orderstatus as src_stm, 'CM1' as rule, count(*) as n from orders where o_orderpriority='4-NOT SPECIFIED' group by o_orderstatus
""",
    "period_export": """
select o_orderkey as account_id, c_custkey as counterparty_id, n_name as country, o_totalprice as amount from orders join customer on o_custkey=c_custkey join nation on c_nationkey=n_nationkey where last_day(cast(o_orderdate as date))=date '2001-06-30'
""",
    "counterparty_stack": """
select c_custkey as cntpr_id, c_name as name, c_acctbal as balance, c_mktsegment as segment, 'CMS' as src_stm from customer union all select s_suppkey, s_name, s_acctbal, null, 'TFS' from supplier
""",
    "prevalidation_failures": """
select 'r1' as rule, cast(c_custkey as varchar) as key from customer where c_acctbal<0 union all select 'r2', cast(c_custkey as varchar) from customer where c_mktsegment='MACHINERY'
""",
    "violation_list": """
select 'accounts' as entity, '20240131' as msr_prd_id, 'CN1' as rule, cast(c_custkey as varchar) as key from customer where c_acctbal<0 union all select 'accounts', '20240131', 'RI1', cast(o_orderkey as varchar) from orders o where not exists (select 1 from lineitem l where l.l_orderkey=o.o_orderkey)
""",
    "v11_reconcile_sources": """
with a as (select o_orderstatus, sum(cast(o_totalprice as decimal(18,2))) as l0, sum(case when o_totalprice>100000 then cast(o_totalprice as decimal(18,2)) else 0 end) as l1 from orders group by 1), b as (select case when l_linestatus='O' then 'O' else 'F' end as o_orderstatus, sum(cast(l_extendedprice as decimal(18,2))) as r0, sum(case when l_quantity>10 then cast(l_extendedprice as decimal(18,2)) else 0 end) as r1 from lineitem group by 1), j as (select o_orderstatus, coalesce(l0,0) as l0, coalesce(l1,0) as l1, coalesce(r0,0) as r0, coalesce(r1,0) as r1 from a full join b using (o_orderstatus)) select 'CM1' as rule, o_orderstatus, l0 as left_sum, r0 as right_sum, l0-r0 as difference, l0>=r0 as ok from j union all select 'CM2', o_orderstatus, l1, r1, l1-r1, l1=r1 from j
""",
    "totals_by_day": """
select cast(a.d as date) as ds_dt, a.org, a.total-b.shipped as difference, a.urgent from (select o_orderdate as d, o_orderstatus as org, sum(cast(o_totalprice as decimal(18,2))) as total, sum(case when o_orderpriority in ('1-URGENT','2-HIGH') then cast(o_totalprice as decimal(18,2)) end) as urgent from orders group by 1,2) a join (select l_shipdate as d, l_linestatus as org, sum(cast(l_extendedprice as decimal(18,2))) as shipped from lineitem group by 1,2) b on a.d=b.d and a.org=b.org
""",
}
