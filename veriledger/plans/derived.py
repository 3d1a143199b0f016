"""Report entities derived from the benchmark tables, in SQL that Spark and DuckDB both read.

Code columns hold the names of code lists (the sample codes), and some values are blanked, shifted or
sent to parents that do not exist, so that the rules of the catalogue have something to find.
"""

from __future__ import annotations

_CAC = """
select 'A' || cast(o_orderkey as string) as ac_id, 'E' || cast(o_custkey as string) as ent_id,
  case when o_orderkey % 3 = 0 then 'THB' else 'USD' end as ccy,
  case o_orderkey % 13 when 0 then 'contingent_loans' when 1 then 'bills_of_exchange'
    when 2 then 'baht_loans' when 3 then 'overdraft' when 4 then 'first_payment_loans'
    when 5 then 'onshore_lending' when 6 then 'foreign_bill_outward' when 7 then 'reverse_mortgage'
    when 8 then 'offshore_lending' when 9 then 'foreign_bill_inward' when 10 then 'overdraft_from_deposit'
    else 'loans' end as loan_type,
  case o_orderpriority when '1-URGENT' then 'fixed_term' when '2-HIGH' then 'fixed_term'
    when '4-NOT SPECIFIED' then ' ' else 'open_term' end as term_type,
  case o_orderstatus when 'F' then 'closed_status' when 'P' then 'inactive_or_closed_status' else 'open' end
    as account_status,
  case o_orderkey % 7 when 0 then '' when 1 then 'unknown_term_unit' else 'M' end
    as principal_freq_unit,
  case o_orderkey % 5 when 0 then null when 1 then 'unknown_term_unit' else 'M' end
    as interest_freq_unit,
  case o_orderkey % 6 when 0 then null when 1 then '  ' when 2 then 'Initial Data' else 'x' end
    as payment_freq_condition,
  case when o_orderkey % 4 = 0 then '' else '0' end as been_extended_flag,
  cast(cast(o_orderdate as date) + interval 24 year as date) as effective_date,
  cast(cast(o_orderdate as date) + interval 24 year - interval 1 day as date) as contract_date,
  case when o_orderkey % 13 = 0 then null
    when o_orderkey % 9 = 0 then cast(cast(o_orderdate as date) + interval 23 year as date)
    else cast(cast(o_orderdate as date) + interval 25 year as date) end as maturity_date,
  case when o_orderkey % 8 = 0 then cast(0 as decimal(18,2)) when o_orderkey % 8 = 1 then null
    else cast(o_totalprice as decimal(18,2)) end as share_lending_total_baht,
  cast(o_totalprice as decimal(18,2)) - 20000 as contract_amount_oc,
  cast(o_orderkey % 4 as int) as n_principal,
  case when o_orderkey % 10 = 0 then null else cast(o_orderkey % 10 - 2 as int) end
    as principal_freq,
  cast(o_orderkey % 3 as int) as n_interest,
  case when o_orderkey % 12 = 0 then null else cast(o_orderkey % 12 - 2 as int) end
    as interest_freq,
  case when o_orderkey % 9 = 0 then cast(0 as decimal(18,2)) when o_orderkey % 9 = 1 then null
    else cast(o_totalprice as decimal(18,2)) end as share_lending_total_oc,
  case o_orderkey % 5 when 0 then 'lead_manager_loans' when 1 then ' ' when 2 then null else 'participant' end
    as syndication_role,
  '20240131' as msr_prd_id
from {orders}
"""

_CACD = """
select case when l_partkey % 50 = 0 then 'none' else 'A' || cast(l_orderkey as string) end as ac_id,
  case when l_suppkey % 5 = 0 then ' ' else 'L' || cast(l_suppkey as string) end as credit_line_id,
  'F' || cast(l_partkey as string) as portfolio_id,
  case when l_linenumber = 1 then null else 'R' || cast(l_partkey % 30 as string) end
    as product_program_id,
  case l_returnflag when 'A' then 'commercial_purposes' when 'R' then 'consumption_purposes'
    else case when l_quantity > 45 then 'residential_purchase_purposes'
      when l_quantity > 40 then 'mortgage_purposes' when l_quantity > 35 then 'other_mortgage_purposes'
      when l_linenumber % 2 = 0 then 'other_purposes' end end as account_purpose,
  case when l_linestatus = 'O' then 'x' else '' end as lending_business_type,
  case when l_linenumber = 3 then null else '0' end as revolving_flag,
  case when l_linenumber = 4 then '' else '0' end as refinance_flag,
  '0' as employee_flag, '0' as related_lending_flag,
  case when l_linenumber = 1 then null else '0' end as interbank_flag,
  cast(case when l_quantity = 4 then null else l_quantity * 3 - 20 end as decimal(9,4)) as original_eir,
  case when l_linenumber = 5 then null else '0' end as digital_loan_flag,
  case when l_linenumber = 6 then null else '0' end as bridge_loan_flag,
  case when l_linenumber = 2 then 'unclassified' when l_linenumber = 7 then ' ' else 'TH' end
    as country_to_invest,
  case when l_quantity < 25 then 'x' end as regulated_product,
  case when l_quantity < 5 then null else 'x' end as factor,
  cast(cast(l_shipdate as date) + interval 24 year as date) as open_date,
  case when l_quantity < 3 then null else cast(l_quantity - 10 as decimal(18,2)) end as notional_oc,
  cast(l_extendedprice as decimal(18,2)) as notional_baht,
  case when l_quantity = 7 then cast('0.01' as decimal(18,2)) when l_quantity = 8 then null
    else cast(l_quantity - 9 as decimal(18,2)) end as frst_pymt_amt_in_orig_ccy,
  cast(l_quantity * 5 as decimal(9,4)) as total_rate
from {lineitem}
"""

_CPID = """
select 'P' || cast(c_custkey as string) as cntpr_id,
  case when c_custkey % 9 = 0 then null else 'N' || cast(c_custkey as string) end as application_id,
  case c_custkey % 7 when 0 then 'personal_id' when 1 then 'tax_id' when 2 then 'juristic_id'
    when 3 then 'cooperative_id' when 4 then 'offshore_branch_number' when 5 then 'exempt_id'
    else 'passport' end as id_type,
  case when c_custkey % 31 = 0 then null else lpad(cast(c_custkey * 7919 as string),
    case when c_custkey % 17 = 0 then 12 else 13 end, '1') end as id_no,
  case when c_custkey % 4 = 0 then 'unclassified' else 'TH' end as id_type_country,
  case when c_custkey % 3 = 0 then ' ' else 'B' || cast(c_nationkey as string) end
    as branch_fi_code
from {customer}
"""

_TXF = """
select 'T' || cast(event_id as string) as txn_id,
  'A' || cast(event_id % 20000 as string) as ac_id,
  case event_id % 7 when 0 then 'debt_instrument_purposes' when 1 then 'portfolio_purposes'
    when 2 then 'borrowing_purposes' when 3 then 'lending_purposes'
    when 4 then 'foreign_loan_purpose' else 'other' end as purpose,
  case when event_type = 'error' then 'decreasing_loan' else 'increasing_loan' end as mvmt_tp
from {events}
"""

_RLI = """
select case when event_id % 23 = 0 then 'none' when event_id % 10 = 0 then 'X' || cast(event_id as string)
    else 'T' || cast(event_id as string) end as txn_id,
  case when event_id % 2 = 0 then 'portfolio_investment' when event_id % 5 = 0 then '  ' end
    as investment_type,
  case when event_id % 3 = 0 then 'bond_instruments' end as instrument_type,
  case event_id % 4 when 0 then null when 1 then 'open_term_ranges' else 'y' end as term_range,
  case when event_id % 6 = 0 then 'x' end as repayment_due_ind,
  case when event_id % 8 = 0 then '' else 'x' end as loan_declaration_type,
  case when event_id % 9 = 0 then cast(ts as date) end as maturity_date
from {events}
"""

_RSK = """
select case event_id % 5 when 0 then 'A' || cast(event_id * 3 as string)
    when 1 then 'L' || cast(user_id as string) when 2 then 'P' || cast(user_id * 50 as string)
    else 'E' || cast(user_id as string) end as reference_id,
  case event_id % 5 when 0 then 'reference_account' when 1 then 'reference_credit_line'
    when 2 then 'reference_counterparty' when 3 then 'reference_entity' else 'other' end
    as reference_type,
  case event_id % 6 when 0 then 'DSR' when 1 then 'Internal Credit Rating'
    when 2 then 'Watch List Flag' when 3 then 'B-SCORE' when 4 then 'DSCR' else 'Grade' end
    as risk_measure,
  case when event_id % 4 = 1 then ' ' else 'm' end as model_reference,
  case when event_id % 3 = 0 then 'n/a' when event_id % 6 = 2 then cast(event_id % 4 as string)
    else cast(value as string) end as risk_value,
  cast(ts as date) as assessment_date, cast('2024-01-02' as date) as data_dt
from {events}
"""

_CL = """
select case when c_custkey % 11 = 0 then 'Z' else 'L' end || cast(c_custkey as string)
    as credit_line_id,
  case when c_custkey % 4 = 0 then 'L' || cast(c_custkey as string)
    else 'L' || cast(c_custkey - c_custkey % 4 as string) end as root_credit_line_id,
  case when c_custkey % 4 = 0 and c_custkey % 40 <> 0 then ' '
    when c_custkey % 9 = 0 then null else 'L' || cast(c_custkey - 1 as string) end
    as parent_credit_line_id,
  'E' || cast(c_custkey as string) as ent_id,
  case when c_custkey % 5 = 0 then 'N' || cast(c_custkey as string) end as application_id,
  cast('2024-01-02' as date) as approve_date,
  case when c_custkey % 6 = 0 then cast('2024-01-01' as date) else cast('2024-01-02' as date) end
    as effective_date,
  cast(c_acctbal as decimal(18,2)) as line_amount_oc, cast(c_custkey % 4 as int) as level_number
from {customer}
"""

_BLD = """
select 'C' || cast(p_partkey as string) as collateral_id,
  case when p_size % 2 = 0 then 'TH' else 'SG' end as country,
  case when p_size % 5 = 0 then ' ' else 'x' end as dopa_location,
  case when p_size % 3 = 0 then null else 'x' end as dol_location,
  case when p_type = 'PROMO' then 'project_developers' when p_type = 'SMALL' then ''
    else 'other' end as developer_type,
  case when p_size > 30 then p_name else ' ' end as project_name,
  case when p_type = 'LARGE' then 'condominium' else 'house' end as property_type,
  case when p_size > 20 then '1' end as floor_number,
  cast(p_size % 7 as int) as n_floors,
  case when p_size % 11 = 0 then null else cast(p_size as int) end as completion_year,
  cast(p_retailprice as decimal(9,4)) as area_utilization
from {part}
"""

# name -> SQL over the benchmark tables in braces
ENTITY_SQL = {
    "DER_CAC": _CAC,
    "DER_CACD": _CACD,
    "DER_CPID": _CPID,
    "DER_TXF": _TXF,
    "DER_RLI": _RLI,
    "DER_RSK": _RSK,
    "DER_CL": _CL,
    "DER_BLD": _BLD,
    "DER_CPEN": "select case when c_acctbal >= 0 then 'E' else 'N' end || cast(c_custkey as string) as ent_id, "
                "'P' || cast(c_custkey as string) as cntpr_id from {customer}",
    "DER_PRT": "select case when p_size > 5 then 'F' else 'N' end || cast(p_partkey as string) as portfolio_id from {part}",
    "DER_PPG": "select 'R' || cast(n_nationkey as string) as product_program_id from {nation}",
    "DER_JCP": "select 'P' || cast(c_custkey as string) as cntpr_id from {customer} "
               "where c_mktsegment = 'BUILDING'",
    "DER_OCP": "select 'P' || cast(c_custkey as string) as cntpr_id from {customer} "
               "where c_mktsegment = 'MACHINERY'",
    "REF_FI_CODE": "select case when n_regionkey < 3 then 'B' else 'N' end || cast(n_nationkey as string) as fi_code "
                   "from {nation}",
    "DER_APP": "select case when c_custkey % 10 = 0 then 'M' else 'N' end || cast(c_custkey as string) as "
               "application_id, case when c_nationkey < 12 "
               "then cast('2023-10-01' as date) else cast('2023-09-30' as date) end "
               "as application_date from {customer}",
    # one organisation has outstanding amounts alone, one positions alone
    "DER_OTDD": "select case when l_partkey % 53 = 0 then 'none' else 'A' || cast(l_orderkey as string) end "
                "as ac_id, cast('2024-01-31' as date) as "
                "data_dt, l_returnflag as org_id, cast(l_extendedprice as decimal(18,2)) - 20000 as "
                "otsnd_amt_in_orig_ccy from {lineitem}",
    "DS_FCP": "select cast('2024-01-31' as date) as data_dt, case l_returnflag when 'R' then 'X' else "
              "l_returnflag end as org_id, case l_linenumber "
              "when 1 then 'onshore_lending_positions' when 2 then 'bill_outward_positions' "
              "when 3 then 'overdraft_positions' when 4 then 'offshore_lending_positions' "
              "when 5 then 'bill_inward_positions' else 'none' end as position_item, "
              "cast(l_tax as decimal(18,2)) as fc_amount from {lineitem}",
    "DER_OTDM": "select case l_linenumber % 2 when 0 then 'TCB' else 'FCB' end as org_id, "
                "cast(l_shipdate as date) as data_dt, '200080000' || cast(l_linenumber as string) as "
                "ast_and_cntg_clss, cast(l_extendedprice as decimal(18,2)) as otsnd_amt_in_baht, "
                "case when l_quantity < 5 then null else cast(l_tax as decimal(18,2)) end as "
                "uern_rev_in_baht from {lineitem}",
    "DS_BLS": "select cast(o_orderdate as date) as ds_dt, case o_orderkey % 3 when 0 then '116002' "
              "when 1 then '116003' else '999999' end as fi_rpt_grp_id, case o_orderkey % 4 when 0 "
              "then '955010' when 1 then '955124' else '900000' end as bsh_itm_tp_id, "
              "cast(o_totalprice as decimal(18,2)) as bsh_amt from {orders}",
    "DS_PVS": "select cast(o_orderdate as date) as ds_dt, case o_orderkey % 3 when 0 then '116002' "
              "when 1 then '116008' else '116003' end as fi_rpt_grp_id, '02001' || "
              "cast(o_orderkey % 7 as string) as ast_cl_tp_id, case when o_orderkey % 5 = 0 then "
              "'960080' else '900000' end as prvn_smy_itm_tp_id, "
              "cast(o_totalprice as decimal(18,2)) as amt from {orders}",
    "DER_COL": "select case when p_size = 13 then 'N' else 'C' end || cast(p_partkey as string) as collateral_id, "
               "case when p_brand = 'Brand#2' then 'building_or_land_with_building' else 'other' end as collateral_type "
               "from {part}",
    "DER_CLP": "select 'L' || cast(s_suppkey as string) as credit_line_id, 'G' || "
               "cast(s_suppkey as string) as protection_id from {supplier}",
    "DER_PVG": "select 'G' || cast(l_suppkey as string) as pledge_id, 'V' || cast(l_partkey as string) "
               "as valuation_group_id from {lineitem}",
    "DER_CVG": "select 'V' || cast(p_partkey as string) as valuation_group_id, 'C' || "
               "cast(p_partkey as string) as collateral_id from {part}",
}

BASE_TABLES = ("nation", "customer", "supplier", "part", "orders", "lineitem", "events")
