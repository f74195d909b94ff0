"""The registered queries, each with the SQL that gives the same rows.

Every query runs an operator over whole supplied tables. Those that land, append or
consolidate write their tables to the shared scratch folder and return what is in them.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tallybook.checks.views import TABLES, VIEWS, portable, spark_sql, table, view
from tallybook.functions import quoted, row_fingerprint
from tallybook.operators.aggregates import distinct_values_csv, source_counts
from tallybook.operators.chains import in_page_order, page_faults
from tallybook.operators.filters import apply_exclusions, exclude_by_table, user_assets
from tallybook.operators.reshape import (
    map_entries_long,
    map_key_set,
    map_to_columns,
    prefix_columns,
    select_available,
)
from tallybook.operators.rows import new_rows, union_sources
from tallybook.operators.variants import variant_columns
from tallybook.plans.assets import (
    ASSET_COLUMNS,
    GRANT_FIELDS,
    TAG_FIELDS,
    VOLUME_COLUMNS,
    asset_grants,
    asset_metadata,
    asset_tags,
    volume_assets,
)
from tallybook.plans.compute import compute_policy, payload_map
from tallybook.plans.consolidation import consolidate_all, consolidate_table
from tallybook.plans.landing import append_new, land_catalog, land_table
from tallybook.plans.inventory import InventorySources, save_inventory
from tallybook.plans.kept_stats import kept_table_stats
from tallybook.plans.models import model_versions
from tallybook.plans.reconcile import reconcile, reconcile_content
from tallybook.plans.stats import (
    asset_properties,
    asset_stats,
    properties_map,
    table_properties,
    table_stats,
)
from tallybook.plans.workspaces import (
    source_profile,
    user_inventory,
    workspace_inventory,
    workspace_status,
)
from tallybook.session import scratch_path
from tallybook.sources import registry as reg
from tallybook.sources.keys import KeyIndex
from tallybook.sources.payloads import (
    DETAIL_SCHEMA,
    USER_SCHEMA,
    WORKSPACE_SCHEMA,
    landed_pages,
    read_page_chain,
    read_pages,
    read_payload,
    read_variant_payload,
)
from tallybook.sources.tables import TableRef, append_table, load_view, read_table, replace_table
from tallybook.streaming.distinct import keep_distinct
from tallybook.streaming.landing import stream_table

HOSTS = {"AZURE": ".azure.example.net", "AWS": ".aws.example.com"}


@dataclass(frozen=True)
class Inputs:
    """The supplied tables and the views over them."""

    spark: SparkSession
    sf_dir: str

    def __call__(self, name: str) -> DataFrame:
        read = view if name in VIEWS else table
        return read(self.spark, self.sf_dir, name)

    def sql(self, text: str) -> DataFrame:
        return spark_sql(self.spark, self.sf_dir, text)

    def file(self, name: str, catalog: str = "main", schema: str = "sales") -> TableRef:
        return TableRef(catalog, schema, name, f"{self.sf_dir}/{name}.parquet")

    def landed(self, df: DataFrame, name: str, catalog: str = "main") -> TableRef:
        """``df`` written as a plain parquet table in the scratch folder."""
        ref = TableRef(catalog, "landed", name, scratch_path(self.spark, name))
        replace_table(df, ref)
        return ref

    def json(self, df: DataFrame, name: str) -> str:
        path = scratch_path(self.spark, name)
        df.write.json(path)
        return path

    def ledger(self, name: str) -> TableRef:
        return TableRef.under(scratch_path(self.spark, "ledger"), "land", "sales", name)

    def statuses(self, rows: list[Row]) -> DataFrame:
        numbered = [(i + 1, r["action"], r["row_count"]) for i, r in enumerate(rows)]
        return self.spark.createDataFrame(numbered, "run int, action string, row_count long")


QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _as_text(df: DataFrame, prefix: str) -> DataFrame:
    """Columns that may be NULL as text, so both engines hand them over alike."""
    names = [c for c in df.columns if c.startswith(prefix)]
    return df.withColumns({c: F.col(c).cast("string") for c in names})


def query(sql: str | None = None):
    def register(build: Callable[[Inputs], DataFrame]):
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = portable(sql)
        return build

    return register


# --- rows: fingerprints, new rows, union -------------------------------------------------


@query(
    """select s.* from {orders} s where not exists (
         select 1 from {orders} t
         where t.o_orderdate < timestamp '1998-01-01' and t.o_orderkey = s.o_orderkey)"""
)
def new_rows_orders(src: Inputs) -> DataFrame:
    return new_rows(src("orders"), src("orders").filter("o_orderdate < '1998-01-01'"))


@query(
    """select * from {orders} where o_orderdate >= timestamp '1998-01-01'"""
)
def new_rows_orders_compat(src: Inputs) -> DataFrame:
    known = src("orders").filter("o_orderdate < '1998-01-01'")
    return new_rows(src("orders"), known, mode="compat")


@query(
    """select * from {lineitem} where l_shipdate >= timestamp '1998-01-01'
       union all
       select * from {lineitem}
       where l_shipdate >= timestamp '1998-01-01' and l_returnflag = 'R'"""
)
def new_rows_with_copies(src: Inputs) -> DataFrame:
    """A third of the source is there twice; every copy of an unseen row comes through."""
    rows = src("lineitem")
    doubled = rows.unionAll(rows.filter("l_returnflag = 'R'"))
    return new_rows(doubled, rows.filter("l_shipdate < '1998-01-01'"))


@query("select * from {events} where event_type <> 'click'")
def new_rows_pruned(src: Inputs) -> DataFrame:
    known = src("events").filter("event_type = 'click'")
    return new_rows(src("events"), known, prune_on="ts")


@query(
    """select n_nationkey, sha256(concat_ws('|', cast(n_nationkey as string), n_name,
              cast(n_regionkey as string))) as fingerprint
       from {nation}"""
)
def fingerprint_nation(src: Inputs) -> DataFrame:
    rows = src("nation")
    return rows.select("n_nationkey", row_fingerprint(rows.schema, "compat").alias("fingerprint"))


@query(
    """select o_orderkey, sha256(concat_ws('|', cast(o_orderkey as string),
              cast(o_custkey as string), o_orderstatus, cast(o_totalprice as string),
              cast(o_orderdate as string), o_orderpriority)) as fingerprint
       from {orders}"""
)
def fingerprint_orders(src: Inputs) -> DataFrame:
    rows = src("orders")
    return rows.select("o_orderkey", row_fingerprint(rows.schema, "compat").alias("fingerprint"))


@query(
    """select l_returnflag, count(*) as row_count, count(distinct row_text) as identities
       from (select l_returnflag, cast(row(l_orderkey, l_partkey, l_suppkey, l_linenumber,
                    l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
                    l_linestatus, l_shipdate) as varchar) as row_text from {lineitem})
       group by l_returnflag"""
)
def strict_identities(src: Inputs) -> DataFrame:
    """As many strict fingerprints as there are different rows."""
    rows = src("lineitem")
    keyed = rows.select("l_returnflag", row_fingerprint(rows.schema).alias("fingerprint"))
    per_row = keyed.groupBy("l_returnflag", "fingerprint").agg(F.count(F.lit(1)).alias("copies"))
    return per_row.groupBy("l_returnflag").agg(
        F.sum("copies").alias("row_count"), F.count(F.lit(1)).alias("identities")
    )


PARTIES = """
    select c_custkey as party_key, c_name as party_name, c_acctbal as balance,
           c_mktsegment as segment from {customer}
    union all by name
    select s_suppkey as party_key, s_name as party_name, s_acctbal as balance from {supplier}"""


def _customers(src: Inputs) -> DataFrame:
    return src.sql(
        """select c_custkey as party_key, c_name as party_name, c_acctbal as balance,
                  c_mktsegment as segment from {customer}"""
    )


def _suppliers(src: Inputs) -> DataFrame:
    return src.sql(
        """select s_suppkey as party_key, s_name as party_name, s_acctbal as balance
           from {supplier}"""
    )


@query(PARTIES)
def consolidated_parties(src: Inputs) -> DataFrame:
    return union_sources([_customers(src), None, _suppliers(src)])


@query(
    """select c_custkey, c_name from {customer}"""
)
def projected_by_availability(src: Inputs) -> DataFrame:
    return select_available(src("customer"), ["missing", "c_custkey", "c_name"])


# --- landing and consolidation -----------------------------------------------------------


@query(
    """select 1 as run, 'created' as action, count(*) as row_count
         from {orders} where o_orderdate < timestamp '1998-01-01'
       union all select 2, 'appended', count(*)
         from {orders} where o_orderdate >= timestamp '1998-01-01'
       union all select 3, 'unchanged', 0"""
)
def land_replay(src: Inputs) -> DataFrame:
    """First batch, whole table, whole table again."""
    goal = src.ledger("orders")
    first = append_new(src("orders").filter("o_orderdate < '1998-01-01'"), goal)
    later = [land_table(src.spark, src.file("orders"), goal) for _ in range(2)]
    return src.statuses([first, *later])


@query("select * from {orders}")
def landed_orders(src: Inputs) -> DataFrame:
    goal = src.ledger("orders")
    append_new(src("orders").filter("o_orderdate < '1998-01-01'"), goal)
    land_table(src.spark, src.file("orders"), goal, prune_on="o_orderdate")
    return read_table(src.spark, goal)


@query("select distinct * from {lineitem}")
def landed_without_copies(src: Inputs) -> DataFrame:
    goal = src.ledger("lineitem")
    append_new(src("lineitem").filter("l_shipdate < '1998-01-01'"), goal, dedupe=True)
    land_table(src.spark, src.file("lineitem"), goal, dedupe=True)
    return read_table(src.spark, goal)


@query("select doc_id, text, lang, source, n_chars from {documents}")
def landed_documents(src: Inputs) -> DataFrame:
    goal = src.ledger("documents")
    append_new(src("documents").filter("lang = 'en'"), goal)
    land_table(src.spark, src.file("documents"), goal)
    return read_table(src.spark, goal)


@query(
    """select c_custkey, c_name, c_nationkey, c_acctbal, cast(null as string) as c_mktsegment
         from {customer} where c_acctbal < 0
       union all
       select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from {customer}"""
)
def evolve_append(src: Inputs) -> DataFrame:
    """The second batch brings one more column; rows that gained a value are new rows."""
    goal = src.ledger("customer")
    append_new(src("customer").filter("c_acctbal < 0").drop("c_mktsegment"), goal)
    append_new(src("customer"), goal)
    return read_table(src.spark, goal)


NARROW_ORDERS = """
    select cast(o_orderkey as int) as o_orderkey, cast(o_totalprice as decimal(12, 2)) as o_totalprice,
           cast(o_orderdate as date) as o_orderdate
    from {orders} where o_orderdate < timestamp '1995-01-01'"""
MIDDLE_ORDERS = """
    select o_orderkey, cast(o_totalprice as decimal(16, 4)) as o_totalprice,
           cast(o_orderdate as date) as o_orderdate
    from {orders} where o_orderdate < timestamp '1997-01-01'"""
WIDE_ORDERS = "select o_orderkey, o_totalprice, o_orderdate from {orders}"


def _widening_runs(src: Inputs, goal: TableRef) -> list[Row]:
    """Batches of ever wider types, then all of them again."""
    batches = [src.sql(text) for text in (NARROW_ORDERS, MIDDLE_ORDERS, WIDE_ORDERS)]
    return [append_new(df, goal) for df in (*batches, *batches)]


@query(WIDE_ORDERS)
def landed_widened_types(src: Inputs) -> DataFrame:
    """Keys become long, decimals wider and then double, dates timestamps, and no order is there twice."""
    goal = src.ledger("orders")
    _widening_runs(src, goal)
    return read_table(src.spark, goal)


@query(
    """select 1 as run, 'created' as action, count(*) as row_count
         from {orders} where o_orderdate < timestamp '1995-01-01'
       union all select 2, 'appended', count(*) from {orders}
         where o_orderdate >= timestamp '1995-01-01' and o_orderdate < timestamp '1997-01-01'
       union all select 3, 'appended', count(*) from {orders} where o_orderdate >= timestamp '1997-01-01'
       union all select 4, 'unchanged', 0 union all select 5, 'unchanged', 0
       union all select 6, 'unchanged', 0"""
)
def landed_widened_replay(src: Inputs) -> DataFrame:
    return src.statuses(_widening_runs(src, src.ledger("orders")))


@query(
    """select cast(c_custkey as bigint) as party_key, cast(c_acctbal as double) as balance,
              c_mktsegment as code from {customer}
       union all
       select s_suppkey, s_acctbal, cast(s_nationkey as string) from {supplier}"""
)
def consolidated_mixed_types(src: Inputs) -> DataFrame:
    """int beside long, decimal beside double, and a code that only text can hold for both; read twice."""
    goal = src.ledger("parties")
    customers = src.landed(
        src.sql(
            """select cast(c_custkey as int) as party_key, cast(c_acctbal as decimal(12, 2)) as balance,
                      c_mktsegment as code from {customer}"""
        ),
        "customer",
    )
    suppliers = src.landed(
        src.sql("select s_suppkey as party_key, s_acctbal as balance, s_nationkey as code from {supplier}"), "supplier"
    )
    for refs in ([customers], [suppliers, customers], [customers, suppliers], [suppliers]):
        consolidate_table(src.spark, refs, goal, as_text=True)
    return read_table(src.spark, goal)


@query(PARTIES)
def consolidate_increment(src: Inputs) -> DataFrame:
    """The target starts with the suppliers and some customers, then takes in the rest."""
    goal = src.ledger("parties")
    some = src.landed(_customers(src).filter("balance < 0"), "customer")
    every = src.landed(_customers(src), "customer")
    suppliers = src.landed(_suppliers(src), "supplier")
    absent = TableRef("gone", "landed", "customer", scratch_path(src.spark, "gone"))
    consolidate_table(src.spark, [suppliers, absent, some], goal)
    consolidate_table(src.spark, [every, absent, suppliers], goal)
    return read_table(src.spark, goal)


@query(
    """select 1 as run, 'created' as action, count(*) as row_count
         from (select 1 from {supplier} union all select 1 from {customer} where c_acctbal < 0)
       union all select 2, 'appended', count(*) from {customer} where c_acctbal >= 0
       union all select 3, 'unchanged', 0"""
)
def consolidate_replay(src: Inputs) -> DataFrame:
    """The widening union must not bring back rows of the narrower source."""
    goal = src.ledger("parties")
    suppliers = src.landed(_suppliers(src), "supplier")
    some = src.landed(_customers(src).filter("balance < 0"), "customer")
    every = src.landed(_customers(src), "customer")
    rows = [
        consolidate_table(src.spark, refs, goal)
        for refs in ([suppliers, some], [suppliers, every], [every, suppliers])
    ]
    return src.statuses(rows)


def _counts_sql(tables, name="'land.sales.' || "):
    return " union all ".join(
        f"select {name}'{t}' as \"table\", 'created' as action, count(*) as row_count from {{{t}}}"
        for t in tables
    )


@query(_counts_sql([t for t in TABLES if t != "labels"]))
def land_catalog_statuses(src: Inputs) -> DataFrame:
    registry = reg.registry_of(src.spark, [src.file(t) for t in TABLES])
    root = scratch_path(src.spark, "catalogs")
    done = land_catalog(
        src.spark, registry, "main", "land", root, exclude_tables=["labels"], fail_fast=True
    )
    return done.select("table", "action", "row_count")


@query(
    """select 1 as run, 'hub.sales.nation' as "table", 'created' as action,
              2 * count(*) as row_count from {nation}
       union all select 1, 'hub.sales.customer', 'created', count(*) from {customer}
       union all select 1, 'hub.sales.supplier', 'created', count(*) from {supplier}
       union all select 2, 'hub.sales.nation', 'unchanged', 0
       union all select 2, 'hub.sales.customer', 'unchanged', 0
       union all select 2, 'hub.sales.supplier', 'unchanged', 0"""
)
def consolidate_all_statuses(src: Inputs) -> DataFrame:
    refs = [
        src.file("nation", "east_system"),
        src.file("nation", "west_system"),
        src.file("customer", "east_system"),
        src.file("supplier", "west_system"),
        src.file("orders", "coe_system"),
        src.file("orders", "elsewhere"),
        src.file("events", "east_system", schema="ai"),
    ]
    registry = reg.registry_of(src.spark, refs)
    root = scratch_path(src.spark, "hub")
    runs = [
        consolidate_all(src.spark, registry, "hub", root, fail_fast=True).select(
            F.lit(n).alias("run"), "table", "action", "row_count"
        )
        for n in (1, 2)
    ]
    return union_sources(runs)


@query(
    """select 'customer' as "table", 2 * count(*) as source_rows, count(*) as target_rows,
              false as ok from {customer}
       union all
       select 'nation', 2 * count(*), 2 * count(*), true from {nation}"""
)
def reconcile_sources(src: Inputs) -> DataFrame:
    """One target holds both sources, the other has lost one."""
    nation, customer = src("nation"), src("customer")
    goal = src.ledger("nation")
    append_new(union_sources([nation, nation]), goal)
    sources = {t: {"east": df, "west": df} for t, df in (("nation", nation), ("customer", customer))}
    return reconcile(sources, {"nation": read_table(src.spark, goal), "customer": customer})


@query(
    """select c_custkey, c_name, 2 as source_rows,
              case when c_custkey % 50 = 3 then 1 when c_custkey % 50 = 7 then 0 else 3 end as target_rows
       from {customer} where c_custkey % 50 in (3, 7, 11)
       union all
       select s_suppkey, s_name, 0, 1 from {supplier}"""
)
def reconciled_content(src: Inputs) -> DataFrame:
    """Both catalogs hold every customer; the target lost some copies, has others too often, and rows of no source.

    The rows lost and those too many are as many, so that counts alone show less than what is wrong.
    """
    customer = src.sql("select c_custkey, c_name from {customer}")
    goal = src.ledger("customer")
    copies = F.expr("case c_custkey % 50 when 3 then 1 when 7 then 0 when 11 then 3 else 2 end")
    written = customer.withColumn("_", F.explode(F.sequence(F.lit(0), copies))).filter("_ > 0").drop("_")
    stray = src.sql("select s_suppkey as c_custkey, s_name as c_name from {supplier}")
    append_new(union_sources([written, stray]), goal)
    found = reconcile_content({"east": customer, "west": customer}, read_table(src.spark, goal, with_key=True))
    return found.select("c_custkey", "c_name", F.col("source_rows").cast("int"), F.col("target_rows").cast("int"))


@query(
    " union all ".join(
        f"select '{t}' as source, count(*) as row_count from {{{t}}}" for t in TABLES
    )
)
def counted_sources(src: Inputs) -> DataFrame:
    return source_counts({t: src(t) for t in TABLES})


# --- discovery and exclusions ------------------------------------------------------------


@query(
    """select distinct catalog from {fx_registry}
       where catalog like '%system%' and catalog not like '%coe%'
         and catalog <> 'nation_0_system'"""
)
def discovered_sources(src: Inputs) -> DataFrame:
    return reg.discover_sources(src("fx_registry"), targets=["nation_0_system"])


@query(
    """select distinct schema from {fx_registry}
       where catalog = 'nation_0_system' and schema <> 'BUILDING'"""
)
def listed_schemas(src: Inputs) -> DataFrame:
    return reg.list_schemas(src("fx_registry"), "nation_0_system", exclude=["BUILDING"])


@query(
    """select distinct "table" from {fx_registry}
       where catalog = 'nation_0_system' and schema = 'MACHINERY' and "table" <> '5-LOW'"""
)
def listed_tables(src: Inputs) -> DataFrame:
    return reg.list_tables(src("fx_registry"), "nation_0_system", "MACHINERY", exclude=["5-LOW"])


@query(
    """select schema, "table", string_agg(catalog, ',' order by catalog) as catalogs
       from (select distinct catalog, schema, "table" from {fx_registry})
       group by schema, "table" """
)
def tables_by_schema(src: Inputs) -> DataFrame:
    listed = reg.tables_by_schema(src("fx_registry"))
    return listed.withColumn("catalogs", F.array_join("catalogs", ","))


@query("select distinct catalog from {fx_registry} where origin = 'share'")
def shared_catalogs(src: Inputs) -> DataFrame:
    return reg.shared_catalogs(src("fx_registry"))


ASSETS = (
    "select table_catalog as catalog_name, table_schema as schema_name, table_name, column_name"
    " from {fx_columns}"
)


@query(
    """select t.table_catalog as catalog, t.table_schema as schema, t.table_name as "table"
       from {fx_tables} t where exists (
         select 1 from {fx_columns} c where c.table_catalog = t.table_catalog
           and c.table_schema = t.table_schema and c.table_name = t.table_name)"""
)
def existing_tables(src: Inputs) -> DataFrame:
    names = {"table_catalog": "catalog", "table_schema": "schema", "table_name": "table"}
    candidates = src("fx_tables").withColumnsRenamed(names).select(*names.values())
    return reg.existing_tables(candidates, src("fx_columns").withColumnsRenamed(names))


EXCLUDED = dict(schemas=["BUILDING"], tables=["Customer#000000001"], catalogs=["NATION_3", "NATION_7"])


@query(
    f"""select * from ({ASSETS}) a
        where schema_name not in ('BUILDING') and table_name not in ('Customer#000000001')
          and catalog_name not in ('NATION_3', 'NATION_7')"""
)
def excluded_assets(src: Inputs) -> DataFrame:
    return apply_exclusions(src.sql(ASSETS), **EXCLUDED)


NULL_NAMES = """
    select o_orderkey, case when o_orderkey % 9 <> 0 then concat('s', cast(o_custkey % 11 as string)) end as name
    from {orders}"""
SHARES = """
    select concat('s', cast(n_nationkey as string)) as share from {nation} where n_nationkey % 3 = 0"""
NULL_SHARES = SHARES + " union all select cast(null as string) from {region}"
NO_SHARES = SHARES + " and n_nationkey < 0"


@query(
    f"""select 'as not in' as rule, * from ({NULL_NAMES}) a where name not in ({SHARES})
        union all
        select 'null among names', * from ({NULL_NAMES}) b where name not in ({NULL_SHARES})
        union all
        select 'no names', * from ({NULL_NAMES}) c
        union all
        select 'nulls kept', * from ({NULL_NAMES}) d where name is null or name not in ({SHARES})
        union all
        select 'nulls kept, null among names', * from ({NULL_NAMES}) e
        where name is null or name not in ({SHARES})"""
)
def excluded_by_table(src: Inputs) -> DataFrame:
    """The rule for NULLs on either side, with and without ``keep_nulls``; the names stay a table."""
    assets = src.sql(NULL_NAMES)
    cases = [
        ("as not in", SHARES, False),
        ("null among names", NULL_SHARES, False),
        ("no names", NO_SHARES, False),
        ("nulls kept", SHARES, True),
        ("nulls kept, null among names", NULL_SHARES, True),
    ]
    found = [
        exclude_by_table(assets, "name", src.sql(names), keep).select(F.lit(rule).alias("rule"), "*")
        for rule, names, keep in cases
    ]
    return union_sources(found)


@query(
    """select distinct catalog, schema, "table" from {fx_registry} r
       where catalog not in (select catalog from {fx_registry} where origin = 'share') and schema <> 'BUILDING'"""
)
def excluded_shared_catalogs(src: Inputs) -> DataFrame:
    """Catalogs that come from a share leave the inventory without being collected."""
    registry = src("fx_registry")
    kept = apply_exclusions(
        registry,
        schemas=["BUILDING"],
        catalogs=reg.shared_catalogs(registry),
        schema_col="schema",
        table_col="table",
        catalog_col="catalog",
    )
    return kept.select("catalog", "schema", "table").distinct()


@query(
    f"""select distinct catalog_name, schema_name, table_name from ({ASSETS}) a
        where schema_name <> 'information_schema' and catalog_name not in ('NATION_0')
          and not starts_with(catalog_name, 'NATION_2')"""
)
def user_tables(src: Inputs) -> DataFrame:
    return user_assets(src.sql(ASSETS), ["NATION_0"], internal_prefix="NATION_2")


@query(
    """select c_custkey as customer_c_custkey, c_name as customer_c_name,
              c_nationkey as customer_c_nationkey, c_acctbal as customer_c_acctbal,
              c_mktsegment as customer_c_mktsegment
       from {customer}"""
)
def prefixed_view(src: Inputs) -> DataFrame:
    return prefix_columns(src("customer"), "customer")


@query("select r_regionkey as region_r_regionkey, r_name as region_r_name from {region}")
def loaded_view(src: Inputs) -> DataFrame:
    missing = load_view(src.spark, TableRef("a", "b", "c", scratch_path(src.spark, "gone")))
    assert missing is None
    return load_view(src.spark, src.file("region"), prefix="region")


# --- accounts, workspaces, users ---------------------------------------------------------


@query(
    """select 'account_id' as attribute, account_id as value from {fx_workspaces}
       union select 'cloud', cloud from {fx_usage}"""
)
def profiled_source(src: Inputs) -> DataFrame:
    return source_profile(src("fx_workspaces"), src("fx_usage"))


@query(
    """select string_agg(cloud, ',' order by cloud) as "values"
       from (select distinct cloud from {fx_usage})"""
)
def distinct_clouds(src: Inputs) -> DataFrame:
    return distinct_values_csv(src("fx_usage"), "cloud")


def _workspaces(src: Inputs) -> DataFrame:
    path = src.json(src("fx_workspaces"), "workspaces")
    return workspace_status(read_payload(src.spark, path, WORKSPACE_SCHEMA))


WORKSPACE_FIELDS = """w.account_id, w.workspace_id, w.deployment_name, w.workspace_name,
       make_timestamp(w.creation_time * 1000) as creation_time"""


@query(f"select {WORKSPACE_FIELDS} from {{fx_workspaces}} w")
def workspaces_status(src: Inputs) -> DataFrame:
    return _workspaces(src).select(
        "account_id", "workspace_id", "deployment_name", "workspace_name", "creation_time"
    )


@query(
    f"""select {WORKSPACE_FIELDS}, u.cloud, case u.cloud
          when 'AZURE' then 'https://' || w.deployment_name || '.azure.example.net'
          when 'AWS' then 'https://' || w.deployment_name || '.aws.example.com' end
          as deployment_url
        from {{fx_workspaces}} w
        join (select distinct account_id, workspace_id, cloud from {{fx_usage}}) u
          on w.account_id = u.account_id and w.workspace_id = u.workspace_id"""
)
def running_workspaces(src: Inputs) -> DataFrame:
    running = workspace_inventory(_workspaces(src), src("fx_usage"), HOSTS)
    return running.select(
        "account_id", "workspace_id", "deployment_name", "workspace_name", "creation_time",
        "cloud", "deployment_url",
    )


def _users(src: Inputs) -> DataFrame:
    """Users as the service lists them, with 0 to 2 roles and 0 to 3 e-mail addresses."""
    rows = src("fx_users")

    def listed(count: str, item: Callable) -> F.Column:
        positions = F.sequence(F.lit(1), F.greatest(F.col(count), F.lit(1)))
        return F.when(F.col(count) > 0, F.transform(positions, item))

    number = lambda i: i.cast("string")
    payload = rows.select(
        "id",
        F.col("user_name").alias("userName"),
        F.col("display_name").alias("displayName"),
        "active",
        listed("n_roles", lambda i: F.struct(
            F.concat(F.lit("t"), number(i)).alias("type"),
            F.concat(F.col("segment"), F.lit("_"), number(i)).alias("value"),
        )).alias("roles"),
        listed("n_emails", lambda i: F.struct(
            F.concat(F.lit("m"), number(i)).alias("type"),
            F.concat(F.col("id"), F.lit("@"), number(i)).alias("value"),
            (i == 1).alias("primary"),
        )).alias("emails"),
    )
    return read_payload(src.spark, src.json(payload, "users"), USER_SCHEMA)


_EMAILS = ", ".join(
    f"""case when n_emails >= {i} and n_emails > 1 then 'm{i}' end as email_type_{i},
        case when n_emails >= {i} and n_emails > 1 then id || '@{i}' end as email_value_{i},
        case when n_emails >= {i} and n_emails > 1 then '{str(i == 1).lower()}' end
            as email_primary_{i}"""
    for i in (1, 2, 3)
)


@query(
    f"""select id as user_id, user_name as "userName", display_name as "displayName", active,
          case when n_roles = 1 then 't1' end as role_type,
          case when n_roles = 1 then segment || '_1' end as role_value,
          case when n_roles = 2 then 't1' end as role_type_1,
          case when n_roles = 2 then segment || '_1' end as role_value_1,
          case when n_roles = 2 then 't2' end as role_type_2,
          case when n_roles = 2 then segment || '_2' end as role_value_2,
          case when n_emails = 1 then 'm1' end as email_type,
          case when n_emails = 1 then id || '@1' end as email_value,
          case when n_emails = 1 then 'true' end as email_primary, {_EMAILS}
        from {{fx_users}}"""
)
def users_wide(src: Inputs) -> DataFrame:
    return _as_text(user_inventory(_users(src)), "email_primary")


@query(
    """select id as user_id, user_name as "userName", display_name as "displayName", active,
              'role' as kind, p as position, 't' || p as type, segment || '_' || p as value,
              cast(null as boolean) as "primary"
       from {fx_users}, (values (1), (2)) v(p) where p <= n_roles
       union all
       select id, user_name, display_name, active, 'email', p, 'm' || p, id || '@' || p, p = 1
       from {fx_users}, (values (1), (2), (3)) v(p) where p <= n_emails
       union all
       select id, user_name, display_name, active, null, null, null, null, null
       from {fx_users} where n_roles = 0 and n_emails = 0"""
)
def users_long(src: Inputs) -> DataFrame:
    return user_inventory(_users(src), style="long")


# --- assets ------------------------------------------------------------------------------

ASSET_VIEWS = """catalogs schemata tables columns catalog_tags schema_tags table_tags
    column_tags catalog_privileges schema_privileges table_privileges""".split()

ASSET_VALUES = {
    "catalog_name": "ca.catalog_name",
    "catalogs_catalog_owner": "ca.catalog_owner",
    "schema_name": "sc.schema_name",
    "schemata_schema_owner": "sc.schema_owner",
    "table_name": "ta.table_name",
    "tables_table_type": "ta.table_type",
    "column_name": "co.column_name",
    "columns_data_type": "co.data_type",
    "catalog_tags_tag_name": "cat.tag_name",
    "catalog_tags_tag_value": "cat.tag_value",
    "schema_tags_tag_name": "st.tag_name",
    "schema_tags_tag_value": "st.tag_value",
    "table_tags_tag_name": "tt.tag_name",
    "table_tags_tag_value": "tt.tag_value",
    "column_tags_tag_name": "ct.tag_name",
    "column_tags_tag_value": "ct.tag_value",
    "catalog_privileges_grantee": "cp.grantee",
    "catalog_privileges_privilege_type": "cp.privilege_type",
    "schema_privileges_grantee": "sp.grantee",
    "schema_privileges_privilege_type": "sp.privilege_type",
    "table_privileges_grantee": "tp.grantee",
    "table_privileges_privilege_type": "tp.privilege_type",
}


def _valued(columns: list[str], values: dict[str, str]) -> str:
    return ", ".join(f"{values.get(c, 'cast(null as string)')} as {c}" for c in columns)


def _asset_sql(match: str, catalogs="{fx_catalogs}", schemata="{fx_schemata}", tables="{fx_tables}"):
    full = match == "full"
    column = "and co.table_name = ct.table_name and co.table_schema = ct.schema_name and co.table_catalog = ct.catalog_name"
    tab = "and ta.table_schema = tt.schema_name and ta.table_catalog = tt.catalog_name"
    return f"""
        select distinct {_valued(ASSET_COLUMNS, ASSET_VALUES)}
        from {{fx_columns}} co
        left join {{fx_column_tags}} ct on co.column_name = ct.column_name {column if full else ''}
        left join {tables} ta on co.table_name = ta.table_name
          and co.table_schema = ta.table_schema and co.table_catalog = ta.table_catalog
        left join {{fx_table_tags}} tt on ta.table_name = tt.table_name {tab if full else ''}
        left join {schemata} sc on co.table_schema = sc.schema_name
          and co.table_catalog = sc.catalog_name
        left join {{fx_schema_tags}} st on sc.schema_name = st.schema_name
          {'and sc.catalog_name = st.catalog_name' if full else ''}
        left join {catalogs} ca on co.table_catalog = ca.catalog_name
        left join {{fx_catalog_tags}} cat on ca.catalog_name = cat.catalog_name
        left join {{fx_table_privileges}} tp on ta.table_name = tp.table_name
          and ta.table_schema = tp.table_schema and ca.catalog_name = tp.table_catalog
        left join {{fx_schema_privileges}} sp on sc.schema_name = sp.schema_name
          and ca.catalog_name = sp.catalog_name
        left join {{fx_catalog_privileges}} cp on ca.catalog_name = cp.catalog_name"""


def _asset_views(src: Inputs) -> dict[str, DataFrame]:
    return {name: src(f"fx_{name}") for name in ASSET_VIEWS}


@query(_asset_sql("full"))
def assets_metadata(src: Inputs) -> DataFrame:
    return asset_metadata(_asset_views(src))


@query(_asset_sql("name"))
def assets_metadata_by_name(src: Inputs) -> DataFrame:
    return asset_metadata(_asset_views(src), match="name")


@query(
    _asset_sql(
        "full",
        catalogs="(select * from {fx_catalogs} where catalog_name <> 'NATION_4')",
        schemata="(select * from {fx_schemata} where schema_name <> 'BUILDING')",
        tables="(select * from {fx_tables} where table_type <> 'EXTERNAL')",
    )
)
def assets_metadata_with_gaps(src: Inputs) -> DataFrame:
    """Some catalogs, schemas and tables have no row of their own."""
    views = _asset_views(src)
    views["catalogs"] = views["catalogs"].filter("catalog_name <> 'NATION_4'")
    views["schemata"] = views["schemata"].filter("schema_name <> 'BUILDING'")
    views["tables"] = views["tables"].filter("table_type <> 'EXTERNAL'")
    return asset_metadata(views)


_NO_TAGS = ("{fx_table_tags}", "{fx_schema_tags}", "{fx_column_tags}", "{fx_schema_privileges}")


@query(functools.reduce(lambda q, v: q.replace(v, f"(select * from {v} where 1 = 0)"), _NO_TAGS, _asset_sql("full")))
def assets_metadata_few_views(src: Inputs) -> DataFrame:
    """Optional views that are not there at all."""
    views: dict[str, DataFrame | None] = _asset_views(src)
    for name in _NO_TAGS:
        views[name[4:-1]] = None
    return asset_metadata(views)


LEVEL_KEYS = {
    "catalog": ["catalog_name"],
    "schema": ["catalog_name", "schema_name"],
    "table": ["table_catalog", "table_schema", "table_name"],
    "column": ["table_catalog", "table_schema", "table_name", "column_name"],
}
LEVEL_VIEWS = {"catalog": "catalogs", "schema": "schemata", "table": "tables", "column": "columns"}


def _long_sql(kind: str, levels: list[str], fields: list[str], given: list[str]) -> str:
    names = ["catalog_name", "schema_name", "table_name", "column_name"]
    parts = []
    for level in levels:
        own = LEVEL_KEYS[level]
        keys = names[: len(own)] if kind == "tags" else own
        shown = [f"t.{k} as {n}" for k, n in zip(keys, names, strict=False)]
        shown += [f"cast(null as string) as {n}" for n in names[len(keys) :]]
        shown += [f"t.{f}" if f in given else f"cast(null as string) as {f}" for f in fields]
        match = " and ".join(f"e.{a} = t.{b}" for a, b in zip(own, keys, strict=True))
        parts.append(
            f"""select distinct '{level}' as level, {', '.join(shown)} from {{fx_{level}_{kind}}} t
                where exists (select 1 from {{fx_{LEVEL_VIEWS[level]}}} e where {match})"""
        )
    return " union all ".join(parts)


@query(_long_sql("tags", ["catalog", "schema", "table", "column"], TAG_FIELDS, TAG_FIELDS))
def assets_tags(src: Inputs) -> DataFrame:
    return asset_tags(_asset_views(src))


@query(_long_sql("privileges", ["catalog", "schema", "table"], GRANT_FIELDS, ["grantee", "privilege_type"]))
def assets_grants(src: Inputs) -> DataFrame:
    return asset_grants(_asset_views(src))


VOLUME_VALUES = {
    "volumes_volume_catalog": "v.volume_catalog",
    "volumes_volume_schema": "v.volume_schema",
    "volumes_volume_name": "v.volume_name",
    "volumes_volume_type": "v.volume_type",
    "volume_tags_tag_name": "t.tag_name",
    "volume_tags_tag_value": "t.tag_value",
    "volume_privileges_grantee": "p.grantee",
    "volume_privileges_privilege_type": "p.privilege_type",
}


@query(
    f"""select {_valued(VOLUME_COLUMNS, VOLUME_VALUES)} from {{fx_volumes}} v
        left join {{fx_volume_tags}} t on v.volume_name = t.volume_name
          and v.volume_schema = t.schema_name and v.volume_catalog = t.catalog_name
        left join {{fx_volume_privileges}} p on v.volume_name = p.volume_name
          and v.volume_schema = p.volume_schema and v.volume_catalog = p.volume_catalog"""
)
def volumes_assets(src: Inputs) -> DataFrame:
    return volume_assets(src("fx_volumes"), src("fx_volume_tags"), src("fx_volume_privileges"))


# --- statistics and properties -----------------------------------------------------------


def _table_stats(src: Inputs) -> DataFrame:
    return table_stats(src.spark, reg.registry_of(src.spark, [src.file(t) for t in TABLES]))


@query(
    " union all ".join(
        f"""select 'main' as catalog_name, 'sales' as schema_name, '{t}' as table_name,
                   count(*) as row_count, true as has_bytes, true as units_agree from {{{t}}}"""
        for t in TABLES
    )
)
def table_sizes(src: Inputs) -> DataFrame:
    """Bytes are nothing SQL can see (a test compares them with the files); what follows from them is."""
    size = F.col("size_in_bytes")
    agree = (F.col("size_in_gb") == F.round(size / 1024**3, 3)) & (
        F.col("size_in_mb") == F.round(size / 1024**2, 3)
    )
    return _table_stats(src).select(
        "catalog_name", "schema_name", "table_name", "row_count",
        (size > 0).alias("has_bytes"), agree.alias("units_agree"),
    )


@query(" union all ".join(f"select '{t}' as table_name, count(*) as row_count from {{{t}}}" for t in TABLES))
def table_row_counts(src: Inputs) -> DataFrame:
    return _table_stats(src).select("table_name", "row_count")


@query(
    """select catalog_name, schema_name, table_name,
              string_agg(key, ',' order by key) as property_keys,
              string_agg(coalesce(value, 'NULL'), ',' order by key) as property_values
       from {fx_table_props} group by catalog_name, schema_name, table_name"""
)
def properties_of_tables(src: Inputs) -> DataFrame:
    arrays = table_properties(properties_map(src("fx_table_props")))
    return arrays.withColumns(
        {c: F.array_join(c, ",", "NULL") for c in ("property_keys", "property_values")}
    )


STATS = """select n_name as catalog_name, c_mktsegment as schema_name, c_name as table_name,
                  count(*) as row_count
           from {orders} join {customer} on o_custkey = c_custkey
           join {nation} on c_nationkey = n_nationkey
           where o_orderstatus = 'F' group by n_name, c_mktsegment, c_name"""
PROPERTIES = """select n_name as catalog_name, c_mktsegment as schema_name,
                       c_name as table_name, 'owner' as key, upper(c_name) as value
                from {customer} join {nation} on c_nationkey = n_nationkey
                where c_acctbal >= 0"""


@query(
    f"""select a.catalog_name, a.schema_name, a.table_name,
               cast(s.row_count as string) as row_count,
               p.key as property_keys, p.value as property_values
        from (select distinct catalog_name, schema_name, table_name from ({ASSETS}) x
              where catalog_name <> 'NATION_0') a
        left join ({STATS}) s on a.catalog_name = s.catalog_name
          and a.schema_name = s.schema_name and a.table_name = s.table_name
        left join ({PROPERTIES}) p on a.catalog_name = p.catalog_name
          and a.schema_name = p.schema_name and a.table_name = p.table_name"""
)
def assets_with_properties(src: Inputs) -> DataFrame:
    stats = asset_stats(src.sql(ASSETS), src.sql(STATS), internal_catalogs=["NATION_0"])
    arrays = table_properties(properties_map(src.sql(PROPERTIES)))
    joined = _as_text(asset_properties(stats, arrays), "row_count")
    return joined.withColumns(
        {c: F.array_join(c, ",") for c in ("property_keys", "property_values")}
    )


# --- maps, payloads, compute, models -----------------------------------------------------


@query(
    """select distinct regexp_extract(props, '"([a-z]+)":', 1) as key from {events}"""
)
def map_keys_seen(src: Inputs) -> DataFrame:
    parsed = src("events").select(F.from_json("props", "map<string,string>").alias("props"))
    return map_key_set(parsed, "props")


@query(
    """select p_partkey, p_brand as brand, cast(null as string) as policy_id,
              case when p_size > 25 then cast(p_size as string) end as size, p_type as type
       from {part}"""
)
def map_as_columns(src: Inputs) -> DataFrame:
    pairs = F.create_map(
        F.lit("brand"), "p_brand", F.lit("type"), "p_type", F.lit("size"),
        F.when(F.col("p_size") > 25, F.col("p_size").cast("string")),
    )
    filled = F.map_filter(pairs, lambda _, v: v.isNotNull())
    rows = src("part").select("p_partkey", filled.alias("info"))
    return map_to_columns(rows, "info", ["brand", "policy_id", "size", "type"]).drop("info")


@query(
    """select p_partkey, 'brand' as key, p_brand as value from {part}
       union all select p_partkey, 'type', p_type from {part}
       union all select p_partkey, 'size', cast(p_size as string) from {part} where p_size > 25"""
)
def map_as_rows(src: Inputs) -> DataFrame:
    pairs = F.create_map(
        F.lit("brand"), "p_brand", F.lit("type"), "p_type", F.lit("size"),
        F.when(F.col("p_size") > 25, F.col("p_size").cast("string")),
    )
    filled = F.map_filter(pairs, lambda _, v: v.isNotNull())
    return map_entries_long(src("part").select("p_partkey", filled.alias("info")), "info")


@query(
    """select p_brand, cast(null as string) as missing, p_name, p_partkey from {part}"""
)
def available_columns(src: Inputs) -> DataFrame:
    return select_available(
        src("part"), ["p_brand", "missing", "p_name", "p_partkey"], fill_missing=True
    )


POLICY_ROWS = """
    from (select distinct cluster_id, workspace_id from {fx_clusters}) c
    join (select distinct w.workspace_id, u.cloud, case u.cloud
            when 'AZURE' then 'https://' || w.deployment_name || '.azure.example.net'
            when 'AWS' then 'https://' || w.deployment_name || '.aws.example.com' end
            as deployment_url
          from {fx_workspaces} w join {fx_usage} u
            on w.account_id = u.account_id and w.workspace_id = u.workspace_id) i
      on c.workspace_id = i.workspace_id
    left join {fx_cluster_payload} d on c.cluster_id = d.cluster_id
    left join {fx_policy_payload} p on d.policy_id = p.policy_id"""


def _policy(src: Inputs, form: str) -> DataFrame:
    status = workspace_status(src("fx_workspaces"))
    return compute_policy(
        src("fx_clusters"),
        workspace_inventory(status, src("fx_usage"), HOSTS),
        src("fx_cluster_payload"),
        src("fx_policy_payload"),
        form,
    )


@query(
    f"""select c.workspace_id, i.deployment_url, c.cluster_id, d.cluster_name, d.node_type_id,
               d.num_workers, d.policy_id, p.name as policy_name, p.is_default
        {POLICY_ROWS} where d.cluster_id is not null"""
)
def compute_policies(src: Inputs) -> DataFrame:
    return _policy(src, "wide").select(
        "workspace_id", "deployment_url", "cluster_id", "cluster_name", "node_type_id",
        "num_workers", "policy_id", "policy_name", "is_default",
    )


@query(
    f"""select cast(c.workspace_id as string) as workspace_id, i.deployment_url, c.cluster_id,
               d.cluster_name, d.node_type_id, d.policy_id, p.name as policy_name,
               p.is_default as is_default,
               cast(null as string) as spark_version
        {POLICY_ROWS}"""
)
def compute_policies_narrow(src: Inputs) -> DataFrame:
    return _as_text(_policy(src, "narrow"), "is_default").select(
        "workspace_id", "deployment_url", "cluster_id", "cluster_name", "node_type_id",
        "policy_id", "policy_name", "is_default", "spark_version",
    )


MODEL_PAGE = 50
VERSION_PAGE = 100


def _model_pages(src: Inputs) -> tuple[str, str, str]:
    """Models are customers, versions their orders; a page holds at most as many items as
    the service would send, and open orders have no detail."""
    url = F.concat(F.lit("https://w"), (F.col("c_nationkey") % 3).cast("string"))
    full_name = F.concat(F.lit("models.m."), F.lower("c_name"))
    models = src("customer").withColumns({"workspace_url": url, "full_name": full_name})
    model_pages = models.groupBy(
        "workspace_url", F.floor(F.col("c_custkey") / MODEL_PAGE).alias("page")
    ).agg(F.collect_list(F.struct("full_name")).alias("registered_models"))

    keyed = src("orders").join(models, F.col("o_custkey") == F.col("c_custkey"))
    version_pages = keyed.groupBy(
        "workspace_url", "full_name", F.floor(F.col("o_orderkey") / VERSION_PAGE).alias("page")
    ).agg(
        F.collect_list(F.struct(F.col("o_orderkey").cast("int").alias("version"))).alias(
            "model_versions"
        )
    )

    table_name = F.struct(F.col("o_orderpriority").alias("table_full_name"))
    function_name = F.struct(F.col("o_orderstatus").alias("function_full_name"))
    absent_table = F.lit(None).cast("struct<table_full_name:string>")
    absent_function = F.lit(None).cast("struct<function_full_name:string>")
    dependencies = F.array(
        F.struct(table_name.alias("table"), absent_function.alias("function")),
        F.struct(absent_table.alias("table"), absent_function.alias("function")),
        F.struct(absent_table.alias("table"), function_name.alias("function")),
    )
    details = keyed.filter("o_orderstatus <> 'O'").select(
        "full_name",
        "workspace_url",
        F.lower("c_name").alias("model_name"),
        F.lit("models").alias("catalog_name"),
        F.col("c_mktsegment").alias("schema_name"),
        F.when(F.col("o_orderstatus") == "F", F.lit("run")).alias("source"),
        F.col("o_custkey").alias("run_workspace_id"),
        F.lit("READY").alias("status"),
        F.col("o_orderkey").cast("int").alias("version"),
        F.col("o_orderkey").cast("string").alias("id"),
        F.struct(dependencies.alias("dependencies")).alias("model_version_dependencies"),
        F.array(
            F.struct(F.lit("champion").alias("alias_name"), F.col("o_orderkey").alias("version_num"))
        ).alias("aliases"),
    )
    return (
        src.json(model_pages.drop("page"), "models"),
        src.json(version_pages.drop("page"), "versions"),
        src.json(details, "details"),
    )


def _model_tables(src: Inputs) -> tuple[DataFrame, DataFrame, DataFrame]:
    models, versions, details = _model_pages(src)
    page = "workspace_url string"
    return (
        read_pages(src.spark, models, "registered_models", "full_name string", page),
        read_pages(src.spark, versions, "model_versions", "version int", f"{page}, full_name string"),
        read_payload(src.spark, details, DETAIL_SCHEMA),
    )


@query(
    """select 'https://w' || cast(c_nationkey % 3 as string) as workspace_url,
              'models.m.' || lower(c_name) as full_name
       from {customer}"""
)
def paged_models(src: Inputs) -> DataFrame:
    return _model_tables(src)[0].select("workspace_url", "full_name")


@query(
    """select 'https://w' || cast(c_nationkey % 3 as string) as workspace_url,
              lower(c_name) as model_name, 'models' as catalog_name,
              c_mktsegment as schema_name,
              case when o_orderstatus = 'F' then 'run' else '' end as source, '' as comment,
              cast(null as string) as run_id, o_custkey as run_workspace_id,
              'READY' as status, cast(o_orderkey as int) as version,
              cast(o_orderkey as string) as id,
              'table:' || o_orderpriority || ',function:' || o_orderstatus as dependencies,
              'champion:' || cast(o_orderkey as string) as aliases
       from {orders} join {customer} on o_custkey = c_custkey
       where o_orderstatus <> 'O' and c_mktsegment <> 'BUILDING'"""
)
def versions_of_models(src: Inputs) -> DataFrame:
    listed = model_versions(*_model_tables(src), exclude_schemas=["BUILDING"])

    def text(column: str, first: str, second: str):
        pair = F.transform(quoted(column), lambda m: F.concat_ws(":", m[first], m[second]))
        return F.array_join(pair, ",")

    return listed.select(
        "workspace_url", "model_name", "catalog_name", "schema_name", "source", "comment",
        "run_id", "run_workspace_id", "status", "version", "id",
        text("dependencies", "type", "name").alias("dependencies"),
        text("aliases", "alias_name", "version_num").alias("aliases"),
    )


@query(
    """select 'cl_' || cast(p_partkey as string) as cluster_id,
              '[' || cast(p_size as string) || ',' || cast(p_size + 1 as string) || ']' as sizes,
              '{{"brand":"' || p_brand || '"}}' as label, cast(null as string) as absent
       from {part}"""
)
def nested_payload_texts(src: Inputs) -> DataFrame:
    """Lists and structs of a payload become JSON text in its map."""
    payload = src("part").select(
        F.concat(F.lit("cl_"), F.col("p_partkey").cast("string")).alias("cluster_id"),
        F.array("p_size", F.col("p_size") + 1).alias("sizes"),
        F.struct(F.col("p_brand").alias("brand")).alias("label"),
        F.lit(None).cast("string").alias("absent"),
    )
    texts = payload_map(payload, ["cluster_id"], "info")
    return map_to_columns(texts, "info", ["sizes", "label", "absent"]).drop("info")


@query(
    """select id as user_id, user_name as "userName", active, n_roles, n_emails from {fx_users}"""
)
def users_inferred(src: Inputs) -> DataFrame:
    """Users read without a schema: fields that only some objects have are NULL in the others."""
    found = read_payload(src.spark, src.json(_users(src), "users"))
    count = lambda name: F.coalesce(F.size(name), F.lit(0))
    return found.select(
        F.col("id").alias("user_id"), "userName", "active", count("roles").alias("n_roles"), count("emails").alias("n_emails")
    )


# --- the whole inventory -----------------------------------------------------------------

SAVED = {
    "workspaces_status": "workspaces_status",
    "running_workspace_details": "running_workspaces",
    "users": "users_wide",
    "asset_metadata": "assets_metadata",
    "table_size_and_properties": None,
    "compute_policy": "compute_policies",
    "volume_assets": "volumes_assets",
    "model_versions": "versions_of_models",
}
_SAVED_STATS = portable(
    """select distinct table_catalog, table_schema, table_name from {fx_columns}
       where table_catalog <> 'NATION_0'"""
)


@query()
def inventory_saved(src: Inputs) -> DataFrame:
    """Rows of every table that an inventory run wrote, counted on reading them back."""
    models, versions, details = _model_tables(src)
    sources = InventorySources(
        workspaces=read_payload(src.spark, src.json(src("fx_workspaces"), "workspaces"), WORKSPACE_SCHEMA),
        usage=src("fx_usage"),
        users=_users(src),
        views=_asset_views(src),
        stats=src.sql(STATS),
        properties=properties_map(src.sql(PROPERTIES)),
        clusters=src("fx_clusters"),
        cluster_payload=src("fx_cluster_payload"),
        policy_payload=src("fx_policy_payload"),
        volumes=src("fx_volumes"),
        volume_tags=src("fx_volume_tags"),
        volume_privileges=src("fx_volume_privileges"),
        models=models,
        versions=versions,
        details=details,
        host_suffixes=HOSTS,
        exclude_schemas=["BUILDING"],
        exclude_catalogs=["NATION_0"],
    )
    root = scratch_path(src.spark, "inventory")

    def target(name: str) -> TableRef:
        return TableRef("hub", "inventory", name, f"{root}/{name}")

    save_inventory(src.spark, sources, target, fail_fast=True)
    counts = [
        read_table(src.spark, target(name)).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for name in SAVED
    ]
    return functools.reduce(DataFrame.unionAll, counts)


ORACLES["inventory_saved"] = " union all ".join(
    f"select '{name}' as table_name, count(*) as row_count from ({ORACLES[of] if of else _SAVED_STATS}) x"
    for name, of in SAVED.items()
)


# --- landing into catalog tables ---------------------------------------------------------


@query(
    """select 1 as run, 'created' as action, count(*) as row_count from {orders} where o_orderdate < '2000-12-01'
       union all select 2, 'appended', count(*) from {orders} where o_orderdate >= '2000-12-01'
       union all select 3, 'unchanged', 0
       union all select 4, 'read', count(*) from {orders}"""
)
def land_replay_catalog(src: Inputs) -> DataFrame:
    """Orders landed in a new schema of the session's catalog three times; then its rows, key column and all."""
    schema = "tallybook_" + scratch_path(src.spark, "x").rsplit("-", 1)[1][:12]
    goal = TableRef("spark_catalog", schema, "orders")
    orders = src("orders")
    try:
        done = [append_new(orders.filter("o_orderdate < '2000-12-01'"), goal), append_new(orders, goal), append_new(orders, goal)]
        rows = [(i + 1, r["action"], r["row_count"]) for i, r in enumerate(done)]
        landed = read_table(src.spark, goal)
        assert landed.columns == orders.columns
        rows.append((4, "read", landed.count()))
    finally:
        src.spark.sql(f"DROP SCHEMA IF EXISTS spark_catalog.{schema} CASCADE")
    return src.spark.createDataFrame(rows, "run int, action string, row_count long")


# --- chains of pages ---------------------------------------------------------------------

# One order a page, in 40 chains. Of every five chains one has lost a page, one was served some pages twice, and
# one leads from its last page back to the fourth.
CHAINED_ORDERS = """
    select chain_id, o_orderkey, p, n, case when p > 0 then concat('t', cast(p as string)) end as page_token,
           case when p < n - 1 then concat('t', cast(p + 1 as string))
                when chain_id % 5 = 3 then 't3' end as next_page_token,
           case when chain_id % 5 = 2 and p % 7 = 0 then 2 else 1 end as copies
    from (select o_custkey % 40 as chain_id, o_orderkey,
                 row_number() over (partition by o_custkey % 40 order by o_orderkey) - 1 as p,
                 count(*) over (partition by o_custkey % 40) as n
          from {orders}) numbered
    where not (chain_id % 5 = 1 and p = 20)"""
PAGE_FIELDS = ("items", "o_orderkey bigint", "chain_id bigint", "page_token", "next_page_token")


def _chained_orders(src: Inputs) -> str:
    pages = src.sql(CHAINED_ORDERS).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    items = F.array(F.struct("o_orderkey")).alias("items")
    return src.json(pages.select("chain_id", "page_token", "next_page_token", items), "chained")


@query(
    f"""select chain_id, o_orderkey,
               cast(case when chain_id % 5 = 1 and p > 20 then null else p end as string) as page_position
        from ({CHAINED_ORDERS}) c"""
)
def chained_pages(src: Inputs) -> DataFrame:
    found = read_page_chain(src.spark, _chained_orders(src), *PAGE_FIELDS)
    return found.withColumn("page_position", F.col("page_position").cast("string"))


@query(
    f"""select chain_id, 'repeated' as kind, coalesce(page_token, '') as token, 2 as n
          from ({CHAINED_ORDERS}) a where copies = 2
        union all
        select distinct chain_id, 'lost', 't20', 1 from ({CHAINED_ORDERS}) b where chain_id % 5 = 1 and n > 20
        union all
        select chain_id, 'unreached', page_token, 1 from ({CHAINED_ORDERS}) c where chain_id % 5 = 1 and p > 20
        union all
        select chain_id, 'loop', 't3', 1 from ({CHAINED_ORDERS}) d where chain_id % 5 = 3 and p = n - 1"""
)
def page_chain_faults(src: Inputs) -> DataFrame:
    _, _, _, *tokens = PAGE_FIELDS
    pages = landed_pages(src.spark, _chained_orders(src), *PAGE_FIELDS)
    return page_faults(pages, ["chain_id"], *tokens).withColumn("n", F.col("n").cast("int"))


# --- landing against bucketed keys -------------------------------------------------------


@query(
    """select 1 as run, 'created' as action, count(*) as row_count from {lineitem} where l_shipdate < '1998-01-01'
       union all select 2, 'appended', count(*) from {lineitem} where l_shipdate >= '1998-01-01'
       union all select 3, 'unchanged', 0
       union all select 4, 'read', count(*) from {lineitem}"""
)
def land_replay_bucketed(src: Inputs) -> DataFrame:
    """Lineitem landed three times, its known keys looked up bucket by bucket."""
    goal = src.ledger("lineitem")
    schema = "tallybook_" + scratch_path(src.spark, "x").rsplit("-", 1)[1][:12]
    index, rows = KeyIndex(schema, "lineitem_keys", buckets=16), src("lineitem")
    try:
        runs = (rows.filter("l_shipdate < '1998-01-01'"), rows, rows)
        done = [append_new(df, goal, index=index) for df in runs]
        found = [(i + 1, r["action"], r["row_count"]) for i, r in enumerate(done)]
        found.append((4, "read", read_table(src.spark, goal).count()))
    finally:
        src.spark.sql(f"DROP SCHEMA IF EXISTS spark_catalog.{schema} CASCADE")
    return src.spark.createDataFrame(found, "run int, action string, row_count long")


# --- payloads whose keys are found ------------------------------------------------------


@query(
    """select p_partkey, p_brand as brand, cast(null as string) as policy_id,
              case when p_size > 25 then cast(p_size as string) end as size, p_type as type
       from {part}"""
)
def map_keys_to_columns(src: Inputs) -> DataFrame:
    """As ``map_as_columns``, but the keys are those that the maps have."""
    big = F.when(F.col("p_size") > 25, F.create_map(F.lit("size"), F.col("p_size").cast("string")))
    always = F.create_map(F.lit("type"), "p_type", F.lit("brand"), "p_brand")
    info = F.coalesce(F.map_concat(always, big), always).alias("info")
    rows = src("part").select("p_partkey", info)
    return map_to_columns(rows, "info", required=["policy_id"]).drop("info")


@query(
    """select id, user_name as "userName", active, cast(n_roles as string) as n_roles,
              case when n_roles > 0 then segment || '_1' end as first_role,
              case when n_emails > 1 then 'm2' end as second_type
       from {fx_users}"""
)
def users_as_variant(src: Inputs) -> DataFrame:
    """Users read without a schema, keys and types found; roles and addresses stay values."""
    users = read_variant_payload(src.spark, src.json(_users(src), "users"))
    found = variant_columns(users, "payload", required=["roles", "emails"])
    roles = F.coalesce(F.size(F.variant_get("roles", "$", "array<variant>")), F.lit(0))
    return found.select(
        "id", "userName", "active", roles.cast("string").alias("n_roles"),
        F.variant_get("roles", "$[0].value", "string").alias("first_role"),
        F.variant_get("emails", "$[1].type", "string").alias("second_type"),
    )


# --- statistics kept between runs --------------------------------------------------------


@query(
    """select 1 as run, 'orders' as table_name, count(*) as row_count, true as counted
         from {orders} where o_orderdate < '1997-01-01'
       union all select 1, 'customer', count(*), true from {customer}
       union all select 2, 'orders', count(*), true from {orders}
       union all select 2, 'customer', count(*), true from {customer}
       union all select 3, 'orders', count(*), false from {orders}
       union all select 3, 'customer', count(*), false from {customer}"""
)
def kept_row_counts(src: Inputs) -> DataFrame:
    """Statistics run before and after a table grows, and once more; ``counted``: whether a file was opened."""
    orders = src.landed(src("orders").filter("o_orderdate < '1997-01-01'"), "orders")
    registry = reg.registry_of(src.spark, [orders, src.file("customer")])
    kept = TableRef("main", "hub", "file_stats", scratch_path(src.spark, "file_stats"))
    found = []

    def run(number: int) -> None:
        stats, opened = kept_table_stats(src.spark, registry, kept)
        counts = stats.select("table_name", "row_count").collect()
        found.extend((number, r["table_name"], r["row_count"], opened > 0) for r in counts)

    run(1)
    append_table(src("orders").filter("o_orderdate >= '1997-01-01'"), orders)
    run(2)
    run(3)
    return src.spark.createDataFrame(found, "run int, table_name string, row_count long, counted boolean")


# --- distinct values kept between runs ---------------------------------------------------


@query(ORACLES["running_workspaces"])
def running_workspaces_kept(src: Inputs) -> DataFrame:
    """Running workspaces from triples that two runs over a growing usage log have kept."""
    usage, triple = src("fx_usage"), ["account_id", "workspace_id", "cloud"]
    log, checkpoint = scratch_path(src.spark, "usage"), scratch_path(src.spark, "usage-checkpoint")
    kept = src.ledger("running")
    early = F.pmod(F.xxhash64(*triple), F.lit(2)) == 0
    for day, rows in enumerate((usage.filter(early), usage)):
        rows.write.parquet(f"{log}/day={day}")
        stream = stream_table(src.spark, log, usage.schema)
        keep_distinct(stream, triple, kept, checkpoint).awaitTermination()
    running = workspace_inventory(_workspaces(src), read_table(src.spark, kept), HOSTS)
    return running.select(
        "account_id", "workspace_id", "deployment_name", "workspace_name", "creation_time",
        "cloud", "deployment_url",
    )
