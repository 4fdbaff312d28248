"""The claims model bound onto the driver's tables.

Every table keeps all rows of the table it is made from. Defects (missing payers, orphan keys,
padded names, invalid dates, ...) are values computed from the row's own key, so each audit finds
something at any scale. ``Tables`` builds them as DataFrames; ``ORACLE_TABLES`` says the same in
portable SQL for the oracle.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property
import re

from pyspark.sql import DataFrame, SparkSession, functions as F

AS_OF = date(2000, 6, 30)

CLAIM_COLUMNS = (
    "claim_id",
    "member_id",
    "provider_id",
    "payer_id",
    "service_date",
    "diagnosis_code",
    "procedure_code",
    "billed_amount",
    "allowed_amount",
    "paid_amount",
    "claim_status",
    "denial_reason",
    "load_timestamp",
)


class Tables:
    """Lazy DataFrames over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @staticmethod
    def claims_from(orders: DataFrame) -> DataFrame:
        return orders.selectExpr(
            "o_orderkey as claim_id",
            "o_custkey as member_id",
            "4 + o_orderkey % 104 as provider_id",
            "if(o_orderkey % 211 = 0, null, o_orderkey % 26) as payer_id",
            "cast(o_orderdate as date) as service_date",
            "concat('D', o_orderkey % 2010) as diagnosis_code",
            "concat('PX', o_orderkey % 40) as procedure_code",
            "cast(o_totalprice as decimal(10,2)) as billed_amount",
            "cast(o_totalprice * 0.6 as decimal(10,2)) as allowed_amount",
            "cast(o_totalprice * 0.4 as decimal(10,2)) as paid_amount",
            "case o_orderstatus when 'O' then 'Approved' when 'F' then 'Denied' else 'Pending' end as claim_status",
            "case when o_orderstatus = 'F' and o_orderkey % 499 <> 0 then o_orderpriority"
            " when o_orderstatus = 'O' and o_orderkey % 997 = 0 then 'Billed amount corrected' end as denial_reason",
            "cast(date_add(cast(o_orderdate as date), cast(o_orderkey % 30 as int)) as timestamp) as load_timestamp",
        )

    @cached_property
    def claims(self) -> DataFrame:
        return self.claims_from(self.raw("orders"))

    @cached_property
    def claims_redelivered(self) -> DataFrame:
        """Claims, pending claims sent twice, unexplained denials under a new id, later corrections."""
        claims = self.claims
        again = claims.filter("claim_status = 'Pending'")
        new_id = claims.filter("claim_status = 'Denied' and denial_reason is null").withColumn(
            "claim_id", F.col("claim_id") + 1_000_000_000
        )
        corrected = (
            claims.filter("claim_status = 'Approved' and denial_reason is not null")
            .withColumn("claim_status", F.lit("Denied"))
            .withColumn("load_timestamp", F.col("load_timestamp") + F.expr("interval 10 days"))
        )
        return claims.unionByName(again).unionByName(new_id).unionByName(corrected)

    @cached_property
    def members(self) -> DataFrame:
        return self.raw("customer").selectExpr(
            "c_custkey as member_id",
            "c_name as member_name",
            "case c_custkey % 3 when 0 then 'F' when 1 then 'M' else 'U' end as gender",
            "if(c_custkey % 97 = 0, null, c_mktsegment) as plan_type",
            "concat('S', c_nationkey) as state",
            "date_add(date'1995-01-01', cast(c_custkey % 2000 as int)) as enrollment_date",
        )

    @cached_property
    def providers(self) -> DataFrame:
        return self.raw("supplier").selectExpr(
            "s_suppkey as provider_id",
            "cast(1000000000 + s_suppkey as string) as npi",
            "case s_suppkey % 7 when 0 then concat(' ', s_name) when 1 then concat(s_name, ' ') else s_name end"
            " as provider_name",
            "concat('SPEC-', s_suppkey % 6) as specialty",
            "if(s_suppkey % 7 = 3, 'OUT', 'IN') as network_status",
            "concat('GRP-', s_nationkey) as group_name",
            "date'1994-01-01' as effective_date",
            "case s_suppkey % 11 when 5 then date'2000-12-31' when 6 then date'1999-12-31' end as term_date",
        )

    @cached_property
    def payer(self) -> DataFrame:
        return self.raw("nation").selectExpr("cast(n_nationkey as bigint) as payer_id", "n_name as payer_name")

    @cached_property
    def diagnosis(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "concat('D', p_partkey) as icd10_code", "p_name as description", "p_type as category"
        )

    @cached_property
    def contracts(self) -> DataFrame:
        """One contract per supplier row; some belong to a neighbour, who then has two."""
        return self.raw("supplier").selectExpr(
            "s_suppkey as contract_id",
            "case s_suppkey % 5 when 0 then s_suppkey + 1 when 4 then s_suppkey - 2 else s_suppkey end as provider_id",
            "case s_suppkey % 3 when 0 then 'FFS' when 1 then 'Capitated' else 'Value-Based' end as contract_type",
            "cast(0.80 + cast(s_suppkey % 10 as decimal(5,4)) * 0.02 as decimal(5,4)) as rate_modifier",
            "case when s_suppkey % 5 in (1, 2, 3) then date'1995-01-01'"
            " when s_suppkey % 4 = 1 then date'1999-06-01' else date'2000-01-01' end as start_date",
            "case when s_suppkey % 5 in (1, 2, 3) then if(s_suppkey % 4 <> 0, date'1999-12-31', null)"
            " when s_suppkey % 6 = 2 then date'2000-06-30' end as end_date",
        )

    @cached_property
    def authorizations(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "o_orderkey as auth_id",
            "o_custkey as member_id",
            "4 + o_orderkey % 104 as provider_id",
            "case o_orderkey % 3 when 0 then 'Inpatient' when 1 then 'Outpatient' else 'Specialist' end as auth_type",
            "cast(o_orderdate as date) as requested_date",
            "if(o_orderstatus <> 'P' or o_orderkey % 50 = 0,"
            " date_add(cast(o_orderdate as date), cast(1 + o_orderkey % 4 as int)), null) as decision_date",
            "case o_orderstatus when 'O' then 'Approved' when 'F' then 'Denied' else 'Pending' end as decision",
            "cast(1 + o_orderkey % 8 as int) as units_requested",
            "case o_orderstatus when 'O' then cast(1 + o_orderkey % 5 as int) when 'F' then 0 end as units_approved",
            "if(o_orderstatus = 'F', o_orderpriority, null) as denial_reason",
        )

    @cached_property
    def enrollment(self) -> DataFrame:
        return self.raw("customer").selectExpr(
            "if(c_custkey % 25 = 7, '', concat('M', 1000 + c_custkey)) as member_id",
            "concat('FIRST', c_custkey) as first_name",
            "c_name as last_name",
            "case c_custkey % 9 when 0 then 'Medicaid' when 1 then 'Medicare' when 2 then 'Marketplace'"
            " when 3 then 'Duals' when 4 then 'Medicaid' when 5 then 'Medicare' when 6 then 'Marketplace'"
            " when 7 then 'Duals' else 'Unspecified' end as line_of_business",
            "if(c_custkey % 13 = 4, '', c_mktsegment) as plan_code",
            "if(c_custkey % 17 = 5, '', concat('713555', 1000 + c_custkey % 9000)) as phone",
            "if(c_custkey % 19 = 6, '2026-13-45',"
            " cast(date_add(date'1999-01-01', cast(c_custkey % 400 as int)) as string)) as coverage_effective_date",
            "cast(date_add(date'1999-07-01', cast(c_custkey % 900 as int)) as string) as term_date",
        )

    @cached_property
    def inbound(self) -> DataFrame:
        """Claims as inbound text, with planted conversion errors and upper-case statuses."""
        return self.claims.selectExpr(
            "if(claim_id % 601 = 600, concat('C', claim_id), cast(claim_id as string)) as claim_id",
            "cast(member_id as string) as member_id",
            "cast(provider_id as string) as provider_id",
            "if(claim_id % 401 = 400, '2020-02-30', cast(service_date as string)) as service_date",
            "cast(null as string) as admit_date",
            "cast(null as string) as discharge_date",
            "if(claim_id % 701 = 700, concat(diagnosis_code, 'TOOLONGCODE'), diagnosis_code) as diagnosis_code",
            "procedure_code",
            "if(claim_id % 301 = 300, 'n/a', cast(billed_amount as string)) as billed_amount",
            "cast(allowed_amount as string) as allowed_amount",
            "cast(paid_amount as string) as paid_amount",
            "if(claim_status = 'Approved', 'PAID', upper(claim_status)) as claim_status",
            "denial_reason",
        )


# The same tables for the oracle.
ORACLE_TABLES = {
    "claims": """
select o_orderkey as claim_id, o_custkey as member_id, 4 + o_orderkey % 104 as provider_id,
       case when o_orderkey % 211 = 0 then null else o_orderkey % 26 end as payer_id,
       cast(o_orderdate as date) as service_date,
       concat('D', cast(o_orderkey % 2010 as varchar)) as diagnosis_code,
       concat('PX', cast(o_orderkey % 40 as varchar)) as procedure_code,
       cast(o_totalprice as decimal(10,2)) as billed_amount,
       cast(o_totalprice * 0.6 as decimal(10,2)) as allowed_amount,
       cast(o_totalprice * 0.4 as decimal(10,2)) as paid_amount,
       case o_orderstatus when 'O' then 'Approved' when 'F' then 'Denied' else 'Pending' end as claim_status,
       case when o_orderstatus = 'F' and o_orderkey % 499 <> 0 then o_orderpriority
            when o_orderstatus = 'O' and o_orderkey % 997 = 0 then 'Billed amount corrected' end as denial_reason,
       cast(cast(o_orderdate as date) + cast(o_orderkey % 30 as int) as timestamp) as load_timestamp
from orders""",
    "claims_redelivered": """
select * from claims
union all select * from claims where claim_status = 'Pending'
union all select * replace (claim_id + 1000000000 as claim_id) from claims
          where claim_status = 'Denied' and denial_reason is null
union all select * replace ('Denied' as claim_status, load_timestamp + interval 10 days as load_timestamp) from claims
          where claim_status = 'Approved' and denial_reason is not null""",
    "members": """
select c_custkey as member_id, c_name as member_name,
       case c_custkey % 3 when 0 then 'F' when 1 then 'M' else 'U' end as gender,
       case when c_custkey % 97 = 0 then null else c_mktsegment end as plan_type,
       concat('S', cast(c_nationkey as varchar)) as state,
       cast('1995-01-01' as date) + cast(c_custkey % 2000 as int) as enrollment_date
from customer""",
    "providers": """
select s_suppkey as provider_id, cast(1000000000 + s_suppkey as varchar) as npi,
       case when s_suppkey % 7 = 0 then concat(' ', s_name) when s_suppkey % 7 = 1 then concat(s_name, ' ')
            else s_name end as provider_name,
       concat('SPEC-', cast(s_suppkey % 6 as varchar)) as specialty,
       case when s_suppkey % 7 = 3 then 'OUT' else 'IN' end as network_status,
       concat('GRP-', cast(s_nationkey as varchar)) as group_name,
       cast('1994-01-01' as date) as effective_date,
       case when s_suppkey % 11 = 5 then cast('2000-12-31' as date)
            when s_suppkey % 11 = 6 then cast('1999-12-31' as date) end as term_date
from supplier""",
    "payer": "select cast(n_nationkey as bigint) as payer_id, n_name as payer_name from nation",
    "diagnosis": """
select concat('D', cast(p_partkey as varchar)) as icd10_code, p_name as description, p_type as category from part""",
    "network_contracts": """
select s_suppkey as contract_id,
       case s_suppkey % 5 when 0 then s_suppkey + 1 when 4 then s_suppkey - 2 else s_suppkey end as provider_id,
       case s_suppkey % 3 when 0 then 'FFS' when 1 then 'Capitated' else 'Value-Based' end as contract_type,
       cast(0.80 + cast(s_suppkey % 10 as decimal(5,4)) * 0.02 as decimal(5,4)) as rate_modifier,
       case when s_suppkey % 5 in (1, 2, 3) then cast('1995-01-01' as date)
            when s_suppkey % 4 = 1 then cast('1999-06-01' as date) else cast('2000-01-01' as date) end as start_date,
       case when s_suppkey % 5 in (1, 2, 3) then case when s_suppkey % 4 <> 0 then cast('1999-12-31' as date) end
            when s_suppkey % 6 = 2 then cast('2000-06-30' as date) end as end_date
from supplier""",
    "authorizations": """
select o_orderkey as auth_id, o_custkey as member_id, 4 + o_orderkey % 104 as provider_id,
       case o_orderkey % 3 when 0 then 'Inpatient' when 1 then 'Outpatient' else 'Specialist' end as auth_type,
       cast(o_orderdate as date) as requested_date,
       case when o_orderstatus <> 'P' or o_orderkey % 50 = 0
            then cast(o_orderdate as date) + cast(1 + o_orderkey % 4 as int) end as decision_date,
       case o_orderstatus when 'O' then 'Approved' when 'F' then 'Denied' else 'Pending' end as decision,
       cast(1 + o_orderkey % 8 as int) as units_requested,
       case o_orderstatus when 'O' then cast(1 + o_orderkey % 5 as int) when 'F' then 0 end as units_approved,
       case when o_orderstatus = 'F' then o_orderpriority end as denial_reason
from orders""",
    "enrollment": """
select case when c_custkey % 25 = 7 then '' else concat('M', cast(1000 + c_custkey as varchar)) end as member_id,
       concat('FIRST', cast(c_custkey as varchar)) as first_name, c_name as last_name,
       case c_custkey % 9 when 0 then 'Medicaid' when 1 then 'Medicare' when 2 then 'Marketplace' when 3 then 'Duals'
            when 4 then 'Medicaid' when 5 then 'Medicare' when 6 then 'Marketplace' when 7 then 'Duals'
            else 'Unspecified' end as line_of_business,
       case when c_custkey % 13 = 4 then '' else c_mktsegment end as plan_code,
       case when c_custkey % 17 = 5 then '' else concat('713555', cast(1000 + c_custkey % 9000 as varchar)) end as phone,
       case when c_custkey % 19 = 6 then '2026-13-45'
            else cast(cast('1999-01-01' as date) + cast(c_custkey % 400 as int) as varchar) end
         as coverage_effective_date,
       cast(cast('1999-07-01' as date) + cast(c_custkey % 900 as int) as varchar) as term_date
from customer""",
    "inbound": """
select case when claim_id % 601 = 600 then concat('C', cast(claim_id as varchar)) else cast(claim_id as varchar) end
         as claim_id,
       cast(member_id as varchar) as member_id, cast(provider_id as varchar) as provider_id,
       case when claim_id % 401 = 400 then '2020-02-30' else cast(service_date as varchar) end as service_date,
       cast(null as varchar) as admit_date, cast(null as varchar) as discharge_date,
       case when claim_id % 701 = 700 then concat(diagnosis_code, 'TOOLONGCODE') else diagnosis_code end
         as diagnosis_code,
       procedure_code,
       case when claim_id % 301 = 300 then 'n/a' else cast(billed_amount as varchar) end as billed_amount,
       cast(allowed_amount as varchar) as allowed_amount, cast(paid_amount as varchar) as paid_amount,
       case when claim_status = 'Approved' then 'PAID' else upper(claim_status) end as claim_status,
       denial_reason
from claims""",
}


def with_tables(sql: str) -> str:
    """Prefix a query with the bound tables it names, directly or through another table."""
    needed: dict[str, None] = {}

    def visit(text: str) -> None:
        for name in ORACLE_TABLES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(ORACLE_TABLES[name])
                needed[name] = None

    visit(sql)
    tables = [f"{name} as ({ORACLE_TABLES[name].strip()})" for name in needed]
    body = sql.strip()
    if body.lower().startswith("with "):
        return f"with {', '.join(tables)}, {body[5:]}" if tables else body
    return f"with {', '.join(tables)} {body}" if tables else body


def percent_sql(part: str, whole: str) -> str:
    """part / whole * 100 rounded half up to two places with integer arithmetic."""
    return (
        f"cast(case when ({whole}) = 0 then null else"
        f" cast((cast({part} as hugeint) * 20000 + ({whole})) // (2 * ({whole})) as double) / 100 end as decimal(5,2))"
    )


def cents_mean_sql(total: str, n: str) -> str:
    """total / n rounded half up to cents with integer arithmetic."""
    return (
        f"cast(case when ({n}) = 0 then null else"
        f" cast((cast(({total}) * 100 as hugeint) * 2 + ({n})) // (2 * ({n})) as double) / 100 end as decimal(18,2))"
    )


def mean_sql(col: str) -> str:
    return f"cast(sum({col}) as double) / count({col})"


def money_sql(expr: str) -> str:
    return f"cast({expr} as decimal(20,2))"
