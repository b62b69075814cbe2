"""Business records over the star-schema tables, stated once as SQL text that Spark and DuckDB both run.

The clean list S1 is the customers; S2 and S3 are the orders, split by status, each a noisy copy of its customer's record.
Every row of customer and orders becomes a record. The truth is the order's customer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import views

TRADE = """
  select c_custkey, p_name || ' ' || c_mktsegment as stem, 'No. ' || cast(p_size as varchar(10)) || ' ' || replace(p_brand, '#', ' ') as street, cast(10000 + c_custkey / 4 - (c_custkey % 4) * 0.25 as integer) as zip, n_name
  from customer join part on p_partkey = c_custkey join nation on n_nationkey = c_nationkey
"""
CLEAN = f"""
  select 'S1-' || cast(c_custkey as varchar(20)) as entity_id, stem || ' Corporation' as business_name, street || ' Road, ' || n_name || ' ' || cast(zip as varchar(10)) as business_address, n_name as country from ({TRADE}) t
"""
NOISY = f"""
  select case when o_orderstatus = 'F' then 'S3-' else 'S2-' end || cast(o_orderkey as varchar(20)) as entity_id,
    case when o_orderstatus = 'F' then 'S3' else 'S2' end as source,
    case o_orderpriority when '1-URGENT' then stem || ' Corporation' when '2-HIGH' then upper(stem) || ', Corp.' when '3-MEDIUM' then replace(stem, 'e', 'é') || ' Co'
      when '4-NOT SPECIFIED' then stem || ' & Sons Limited' else replace(replace(stem, 'i', ''), 'E', '3') end as business_name,
    case when o_orderstatus = 'O' then street || ' Road, ' || n_name || ' ' || cast(zip as varchar(10)) when o_orderstatus = 'P' then upper(street) || ' Rd ' || cast(zip as varchar(10)) when o_orderpriority = '5-LOW' then null else street || ', ' || n_name end as business_address,
    case when o_orderpriority = '4-NOT SPECIFIED' and o_orderstatus = 'F' then null else n_name end as country
  from orders join ({TRADE}) t on o_custkey = c_custkey
"""
TRUTH = """
  select 'S1-' || cast(o_custkey as varchar(20)) as s1_id, case when o_orderstatus = 'F' then 'S3-' else 'S2-' end || cast(o_orderkey as varchar(20)) as entity_id from orders join customer on o_custkey = c_custkey
"""


def trade(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(s1, candidates, truth)."""
    views(spark, sf_dir, "customer", "part", "nation", "orders")
    return spark.sql(CLEAN), spark.sql(NOISY), spark.sql(TRUTH)


# A second, smaller pair of lists for the richer engine, whose gram retrieval meets most of a list on so small a vocabulary: suppliers are the
# clean list, customers the noisy ones. Every row of supplier and customer becomes a record; the truth is an equal key.
DIRECTORY_CLEAN = """
  select 'S1-' || cast(s_suppkey as varchar(20)) as entity_id, p_name || ' ' || p_type || ' Corporation' as business_name,
    'No. ' || cast(p_size as varchar(10)) || ' ' || replace(p_brand, '#', ' ') || ' Road, ' || p_type || ' ' || cast(10000 + p_size as varchar(10)) as business_address, n_name as country
  from supplier join part on p_partkey = s_suppkey join nation on n_nationkey = s_nationkey
"""
DIRECTORY_NOISY = """
  select case when c_acctbal < 3000 then 'S3-' else 'S2-' end || cast(c_custkey as varchar(20)) as entity_id, case when c_acctbal < 3000 then 'S3' else 'S2' end as source,
    case c_mktsegment when 'BUILDING' then p_name || ' ' || p_type || ' Corporation' when 'AUTOMOBILE' then upper(p_name || ' ' || p_type) || ', Corp.' when 'MACHINERY' then replace(p_name, 'e', 'é') || ' ' || p_type || ' International Holdings'
      when 'HOUSEHOLD' then p_name || ' & ' || p_type || ' Private Limited' else replace(replace(p_name, 'i', ''), 'e', '3') || ' ' || p_type || ' ' || p_type || ' Pvt. Ltd.' end as business_name,
    case c_mktsegment when 'BUILDING' then 'No. ' || cast(p_size as varchar(10)) || ' ' || replace(p_brand, '#', ' ') || ' Road, ' || p_type || ' ' || cast(10000 + p_size as varchar(10))
      when 'AUTOMOBILE' then '00' || cast(p_size as varchar(10)) || ' ' || replace(p_brand, '#', ' ') || ' Road, ' || n_name || ' ' || cast(10000 + c_custkey as varchar(10)) when 'MACHINERY' then null
      else cast(p_size as varchar(10)) || ' North ' || upper(replace(p_brand, '#', ' ')) || ' Street ' || n_name || ' ' || cast(1000000 + c_custkey as varchar(10)) || '-' || cast(10000 + c_custkey as varchar(10)) end as business_address,
    case when c_acctbal < 0 then null else n_name end as country
  from customer join part on p_partkey = c_custkey join nation on n_nationkey = c_nationkey
"""
DIRECTORY_TRUTH = """
  select 'S1-' || cast(s_suppkey as varchar(20)) as s1_id, case when c_acctbal < 3000 then 'S3-' else 'S2-' end || cast(c_custkey as varchar(20)) as entity_id from supplier join customer on c_custkey = s_suppkey
"""


def directory(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(s1, candidates, truth)."""
    views(spark, sf_dir, "customer", "supplier", "part", "nation")
    return spark.sql(DIRECTORY_CLEAN), spark.sql(DIRECTORY_NOISY), spark.sql(DIRECTORY_TRUTH)
