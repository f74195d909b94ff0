"""Views that shape the supplied tables like governance tables, in SQL for both engines.

``{customer}`` and so on stand for the tables: DataFrames in Spark, plain names elsewhere.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

CUSTOMER_NATION = "{customer} join {nation} on c_nationkey = n_nationkey"
SUPPLIER_NATION = "{supplier} join {nation} on s_nationkey = n_nationkey"
ORDER_CUSTOMER = "{orders} join {customer} on o_custkey = c_custkey"
VOLUME_SCHEMA = "concat('s', cast(s_suppkey % 5 as string))"
USER = "concat('user_', cast(user_id as string))"

VIEWS = {
    "fx_catalogs": """
        select n_name as catalog_name, r_name as catalog_owner
        from {nation} join {region} on n_regionkey = r_regionkey""",
    "fx_schemata": f"""
        select distinct n_name as catalog_name, c_mktsegment as schema_name,
               concat('owner_', c_mktsegment) as schema_owner
        from {CUSTOMER_NATION}""",
    "fx_tables": f"""
        select n_name as table_catalog, c_mktsegment as table_schema, c_name as table_name,
               case when c_acctbal < 0 then 'EXTERNAL' else 'MANAGED' end as table_type
        from {CUSTOMER_NATION}""",
    "fx_columns": f"""
        select n_name as table_catalog, c_mktsegment as table_schema, c_name as table_name,
               o_orderpriority as column_name, max(o_orderstatus) as data_type
        from {ORDER_CUSTOMER} join {{nation}} on c_nationkey = n_nationkey
        group by n_name, c_mktsegment, c_name, o_orderpriority""",
    "fx_catalog_tags": """
        select n_name as catalog_name, 'residency' as tag_name, r_name as tag_value
        from {nation} join {region} on n_regionkey = r_regionkey where n_regionkey < 2""",
    "fx_schema_tags": f"""
        select distinct n_name as catalog_name, c_mktsegment as schema_name,
               'domain' as tag_name, lower(c_mktsegment) as tag_value
        from {CUSTOMER_NATION} where c_nationkey % 2 = 0""",
    "fx_table_tags": f"""
        select n_name as catalog_name, c_mktsegment as schema_name, c_name as table_name,
               'risk' as tag_name, 'overdrawn' as tag_value
        from {CUSTOMER_NATION} where c_acctbal < 0""",
    "fx_column_tags": f"""
        select distinct n_name as catalog_name, c_mktsegment as schema_name,
               c_name as table_name, o_orderpriority as column_name,
               'pii' as tag_name, concat('high_', cast(c_custkey % 3 as string)) as tag_value
        from {ORDER_CUSTOMER} join {{nation}} on c_nationkey = n_nationkey
        where o_orderpriority like '1%' and c_custkey % 10 = 0""",
    "fx_catalog_privileges": f"""
        select distinct n_name as catalog_name,
               concat('group_', cast(cast(floor(user_id / 25) as bigint) % 2 as string)) as grantee,
               'USE_CATALOG' as privilege_type
        from {{events}} join {{nation}} on user_id % 25 = n_nationkey
        where event_type = 'purchase'""",
    "fx_schema_privileges": f"""
        select distinct n_name as catalog_name, c_mktsegment as schema_name,
               {USER} as grantee, 'USE_SCHEMA' as privilege_type
        from {{events}} join {{customer}} on user_id = c_custkey
        join {{nation}} on c_nationkey = n_nationkey where event_type = 'signup'""",
    "fx_table_privileges": f"""
        select distinct n_name as table_catalog, c_mktsegment as table_schema,
               c_name as table_name, {USER} as grantee, 'SELECT' as privilege_type
        from {{events}} join {{customer}} on user_id = c_custkey
        join {{nation}} on c_nationkey = n_nationkey where event_type = 'error'""",
    "fx_volumes": f"""
        select n_name as volume_catalog, {VOLUME_SCHEMA} as volume_schema,
               s_name as volume_name,
               case when s_acctbal < 0 then 'EXTERNAL' else 'MANAGED' end as volume_type
        from {SUPPLIER_NATION}""",
    "fx_volume_tags": f"""
        select n_name as catalog_name, {VOLUME_SCHEMA} as schema_name,
               s_name as volume_name, 'risk' as tag_name, 'overdrawn' as tag_value
        from {SUPPLIER_NATION} where s_acctbal < 0""",
    "fx_volume_privileges": f"""
        select distinct n_name as volume_catalog, {VOLUME_SCHEMA} as volume_schema,
               s_name as volume_name, {USER} as grantee, 'READ_VOLUME' as privilege_type
        from {{events}} join {{supplier}} on user_id = s_suppkey
        join {{nation}} on s_nationkey = n_nationkey where event_type = 'view'""",
    "fx_workspaces": """
        select cast(c_nationkey as string) as account_id, c_custkey as workspace_id,
               lower(c_name) as deployment_name, c_name as workspace_name,
               1700000000000 + c_custkey * 1001 as creation_time
        from {customer}""",
    "fx_usage": f"""
        select cast(c_nationkey as string) as account_id, c_custkey as workspace_id,
               case when c_mktsegment in ('BUILDING', 'MACHINERY') then 'AZURE'
                    when c_mktsegment = 'HOUSEHOLD' then 'GCP' else 'AWS' end as cloud,
               o_orderdate as usage_date
        from {ORDER_CUSTOMER}""",
    "fx_clusters": """
        select distinct concat('cl_', cast(event_id % 400 as string)) as cluster_id,
               user_id as workspace_id
        from {events}""",
    "fx_cluster_payload": """
        select concat('cl_', cast(p_partkey as string)) as cluster_id,
               p_name as cluster_name, p_type as node_type_id,
               cast(p_size as string) as num_workers,
               case when p_partkey % 3 = 0 then concat('po_', cast(p_size as string)) end
                   as policy_id
        from {part} where p_brand <> 'Brand#7'""",
    "fx_policy_payload": """
        select distinct concat('po_', cast(p_size as string)) as policy_id,
               concat('policy ', cast(p_size as string)) as name,
               case when p_size > 25 then 'true' else 'false' end as is_default
        from {part} where p_size % 2 = 0""",
    "fx_table_props": """
        select 'main' as catalog_name, p_type as schema_name,
               concat('t_', cast(p_partkey as string)) as table_name,
               'brand' as key, p_brand as value
        from {part}
        union all
        select 'main', p_type, concat('t_', cast(p_partkey as string)), 'size',
               case when p_size > 40 then null else cast(p_size as string) end
        from {part} where p_size > 25""",
    "fx_registry": f"""
        select concat(lower(n_name), case n_regionkey when 1 then '_coe_system'
                      when 3 then '_land' else '_system' end) as catalog,
               c_mktsegment as schema, o_orderpriority as table,
               cast(null as string) as path, 'parquet' as format,
               case when n_regionkey = 2 then 'share' else 'local' end as origin
        from {ORDER_CUSTOMER} join {{nation}} on c_nationkey = n_nationkey
        group by n_name, n_regionkey, c_mktsegment, o_orderpriority""",
    "fx_users": """
        select cast(c_custkey as string) as id, c_name as user_name,
               lower(c_name) as display_name, c_acctbal >= 0 as active,
               c_mktsegment as segment,
               case c_mktsegment when 'BUILDING' then 0 when 'MACHINERY' then 1 else 2 end
                   as n_roles,
               case when c_acctbal < 0 then 3 when c_acctbal < 5000 then 1 else 0 end
                   as n_emails
        from {customer}""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tables_in(sql: str) -> list[str]:
    return sorted({name for _, name, _, _ in string.Formatter().parse(sql) if name})


def spark_sql(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run SQL in which ``{name}`` is a supplied table or one of the views."""
    inputs = {
        name: view(spark, sf_dir, name) if name in VIEWS else table(spark, sf_dir, name)
        for name in _tables_in(sql)
    }
    return spark.sql(sql, **inputs)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark_sql(spark, sf_dir, VIEWS[name])


def portable(sql: str) -> str:
    """The same SQL with the views it uses written out as a WITH list and plain names."""
    names = _tables_in(sql)
    used = [n for n in names if n in VIEWS]
    bodies = [f"{n} as ({VIEWS[n].format_map(_Plain())})" for n in used]
    text = sql.format_map(_Plain())
    return f"with {', '.join(bodies)} {text}" if bodies else text


class _Plain(dict):
    def __missing__(self, name: str) -> str:
        return name
