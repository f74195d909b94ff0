"""Times the headline operators at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Inputs are landed as parquet first, outside the clock, so the numbers are those of the
operators. Each operator runs whole and its result is computed in full. Prints one JSON
line; ``jobs`` are the Spark jobs each operator ran, ``rows`` the rows it gave.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, Observation  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tallybook.checks.registered import (  # noqa: E402
    HOSTS,
    QUERIES,
    Inputs,
    _asset_sql,
    _asset_views,
    _model_tables,
    _users,
)
from tallybook.checks.views import TABLES, VIEWS  # noqa: E402
from tallybook.functions import KEY, row_key  # noqa: E402
from tallybook.operators.rows import new_rows  # noqa: E402
from tallybook.plans.assets import asset_grants, asset_metadata, asset_tags, volume_assets  # noqa: E402
from tallybook.plans.compute import compute_policy  # noqa: E402
from tallybook.plans.consolidation import consolidate_table  # noqa: E402
from tallybook.plans.landing import append_new, land_catalog, land_table  # noqa: E402
from tallybook.plans.models import model_versions  # noqa: E402
from tallybook.plans.reconcile import reconcile  # noqa: E402
from tallybook.plans.stats import properties_map, table_properties, table_stats  # noqa: E402
from tallybook.plans.workspaces import user_inventory, workspace_inventory, workspace_status  # noqa: E402
from tallybook.session import local_session, scratch_path  # noqa: E402
from tallybook.sources.registry import registry_of  # noqa: E402
from tallybook.sources.tables import TableRef, read_table, replace_table  # noqa: E402


class Landed(Inputs):
    """The views as tables on disk, written once."""

    def __call__(self, name: str) -> DataFrame:
        if name not in VIEWS:
            return super().__call__(name)
        path = f"{_LANDED}/{name}"
        if name not in _WRITTEN:
            super().__call__(name).write.parquet(path)
            _WRITTEN.add(name)
        return self.spark.read.parquet(path)


_LANDED = ""
_WRITTEN: set[str] = set()


def whole(df: DataFrame) -> int:
    """Compute every row and column and throw them away; the count rides along."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
    return seen.get["rows"]


def main() -> None:
    global _LANDED
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="tallybook-bench-")
    settings = {"spark.sql.shuffle.partitions": cpus, "spark.checkpoint.dir": scratch}
    spark = local_session(cpus, memory="16g", **settings)
    _LANDED = scratch_path(spark, "bench")
    src = Landed(spark, sf_dir)
    for name in VIEWS:
        src(name)
    orders, lineitem = src("orders"), src("lineitem")
    src.landed(orders, "warm-up")

    goal = src.ledger("orders")
    ninety = src.landed(orders.filter("o_orderdate < '2000-12-01'"), "orders-most")
    whole_orders = src.landed(orders, "orders")
    wide_goal = src.ledger("lineitem")
    append_new(lineitem.filter("l_shipdate < '2000-12-01'"), wide_goal)
    parties_goal = src.ledger("parties")
    east = src.landed(orders.drop("o_orderpriority"), "east")
    west = src.landed(orders, "west")
    users = _users(src)
    status = src.landed(workspace_status(src("fx_workspaces")), "status")
    inventory = src.landed(
        workspace_inventory(read_table(spark, status), src("fx_usage"), HOSTS), "inventory"
    )
    props = src.landed(properties_map(src("fx_table_props")), "properties")
    views = _asset_views(src)
    model_tables = _model_tables(src)
    registry = registry_of(spark, [src.file(t) for t in TABLES])

    def landed(row) -> int:
        return row["row_count"]

    def read(ref: TableRef) -> DataFrame:
        return read_table(spark, ref)

    plain_goal = TableRef("plain", "s", "lineitem", scratch_path(spark, "plain-lineitem"))
    replace_table(lineitem.filter("l_shipdate < '2000-12-01'"), plain_goal)

    def plain_append() -> int:
        """The obvious way: hash both sides whole, anti join, count, then write."""
        target = read(plain_goal)
        keyed = lineitem.withColumn(KEY, row_key(lineitem.schema))
        known = target.withColumn(KEY, row_key(target.schema)).select(KEY)
        new = keyed.join(known, KEY, "left_anti").drop(KEY)
        count = new.count()
        new.write.mode("append").parquet(plain_goal.path)
        return count

    def plain_counts() -> int:
        """A job per table."""
        return len([src(t).count() for t in TABLES])

    def plain_assets() -> int:
        """One statement with a distinct over the widened result."""
        return whole(src.sql(_asset_sql("full")).distinct())

    work = {
        "land_table_first": lambda: landed(land_table(spark, ninety, goal)),
        "land_table_10pct_new": lambda: landed(land_table(spark, whole_orders, goal)),
        "land_table_no_new": lambda: landed(land_table(spark, whole_orders, goal)),
        "land_lineitem_10pct_new": lambda: landed(append_new(lineitem, wide_goal)),
        "plain_lineitem_10pct_new": plain_append,
        "land_catalog_14_tables": lambda: land_catalog(
            spark, registry, "main", "land", scratch_path(spark, "catalog"), fail_fast=True
        ).count(),
        "new_rows": lambda: whole(new_rows(orders, orders.filter("o_orderdate < '1998-01-01'"))),
        "new_rows_compat": lambda: whole(
            new_rows(orders, orders.filter("o_orderdate < '1998-01-01'"), mode="compat")
        ),
        "consolidate_first": lambda: landed(consolidate_table(spark, [east, west], parties_goal)),
        "consolidate_again": lambda: landed(consolidate_table(spark, [east, west], parties_goal)),
        "reconcile": lambda: whole(
            reconcile(
                {"orders": {"east": read(east), "west": read(west)}},
                {"orders": read(parties_goal)},
            )
        ),
        "asset_metadata": lambda: whole(asset_metadata(views)),
        "plain_asset_metadata": plain_assets,
        "asset_tags": lambda: whole(asset_tags(views)),
        "asset_grants": lambda: whole(asset_grants(views)),
        "asset_metadata_by_name": lambda: whole(asset_metadata(views, match="name")),
        "volume_assets": lambda: whole(
            volume_assets(src("fx_volumes"), src("fx_volume_tags"), src("fx_volume_privileges"))
        ),
        "workspace_inventory": lambda: whole(
            workspace_inventory(read(status), src("fx_usage"), HOSTS)
        ),
        "users_wide": lambda: whole(user_inventory(users)),
        "table_stats_14_tables": lambda: whole(table_stats(spark, registry)),
        "plain_counts_14_tables": plain_counts,
        "table_properties": lambda: whole(table_properties(read(props))),
        "compute_policy": lambda: whole(
            compute_policy(
                src("fx_clusters"), read(inventory), src("fx_cluster_payload"), src("fx_policy_payload")
            )
        ),
        "model_versions": lambda: whole(model_versions(*model_tables, exclude_schemas=["BUILDING"])),
        "tables_by_schema": lambda: whole(QUERIES["tables_by_schema"](src)),
        "excluded_assets": lambda: whole(QUERIES["excluded_assets"](src)),
    }
    only = sys.argv[1:]
    seconds, jobs, rows = {}, {}, {}
    for name, run in work.items():
        if only and name not in only:
            continue
        spark.sparkContext.setJobGroup(name, name)
        start = time.perf_counter()
        rows[name] = run()
        seconds[name] = round(time.perf_counter() - start, 3)
        jobs[name] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
        print(f"{name:28s} {seconds[name]:8.3f}s {jobs[name]:4d} jobs {rows[name]:9d} rows", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": int(cpus),
                "jobs": jobs,
                "rows": rows,
            }
        )
    )


if __name__ == "__main__":
    main()
