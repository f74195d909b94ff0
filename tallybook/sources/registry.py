"""The set of tables as a DataFrame: one row per table.

Discovery, exclusion, existence and statistics are then ordinary filters and joins over
all tables at once.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.operators.filters import exclude_names
from tallybook.sources.paths import list_folders
from tallybook.sources.tables import LEDGER, TableRef

REGISTRY_SCHEMA = "catalog string, schema string, table string, path string, format string, origin string"
NAME = ["catalog", "schema", "table"]

# The schemas and tables left out by default, the name part a source catalog
# must have and the one it must not have.
EXCLUDED_SCHEMAS = ("information_schema", "ai")
EXCLUDED_TABLES = ("_sqldf", "__internal_logging")
SOURCE_INCLUDE = "system"
SOURCE_EXCLUDE = "coe"


def registry_of(spark: SparkSession, refs: Iterable[TableRef], origin: str = "local") -> DataFrame:
    rows = [(r.catalog, r.schema, r.table, r.path, r.format, origin) for r in refs]
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def registry_from_root(
    spark: SparkSession, root: str, format: str = LEDGER, origin: str = "local"
) -> DataFrame:
    """Tables found as ``root/catalog/schema/table`` folders."""
    refs = [
        TableRef.under(root, catalog, schema, table, format)
        for catalog in list_folders(spark, root)
        for schema in list_folders(spark, f"{root}/{catalog}")
        for table in list_folders(spark, f"{root}/{catalog}/{schema}")
    ]
    return registry_of(spark, refs, origin)


def registry_from_catalogs(
    spark: SparkSession, catalogs: Iterable[str], shared: Iterable[str] = ()
) -> DataFrame:
    """Tables that the session's catalogs list; path stays NULL and reads go by name.

    Catalogs named in ``shared`` come from a share and are marked so.
    """
    refs, shared = [], set(shared)
    for catalog in catalogs:
        for row in spark.sql(f"SHOW SCHEMAS IN `{catalog}`").collect():
            for table in spark.sql(f"SHOW TABLES IN `{catalog}`.`{row[0]}`").collect():
                if not table["isTemporary"]:
                    refs.append(TableRef(catalog, row[0], table["tableName"]))
    own = registry_of(spark, [r for r in refs if r.catalog not in shared])
    return own.unionByName(registry_of(spark, [r for r in refs if r.catalog in shared], "share"))


def discover_sources(
    registry: DataFrame,
    include: str = SOURCE_INCLUDE,
    exclude: str = SOURCE_EXCLUDE,
    targets: Iterable[str] = (),
) -> DataFrame:
    """Catalogs whose name holds ``include`` and not ``exclude``; a target is never a source."""
    name = F.col("catalog")
    kept = registry.filter(name.contains(include) & ~name.contains(exclude))
    return exclude_names(kept, "catalog", targets).select("catalog").distinct()


def list_schemas(
    registry: DataFrame, catalog: str, exclude: Iterable[str] = EXCLUDED_SCHEMAS
) -> DataFrame:
    of_catalog = registry.filter(F.col("catalog") == catalog)
    return exclude_names(of_catalog, "schema", exclude).select("schema").distinct()


def list_tables(
    registry: DataFrame, catalog: str, schema: str, exclude: Iterable[str] = EXCLUDED_TABLES
) -> DataFrame:
    of_schema = registry.filter((F.col("catalog") == catalog) & (F.col("schema") == schema))
    return exclude_names(of_schema, "table", exclude).select("table").distinct()


def tables_by_schema(registry: DataFrame) -> DataFrame:
    """Each (schema, table) with the sorted list of catalogs that hold it.

    Duplicates go before the grouping, so a list is at most as long as there are catalogs.
    """
    return (
        registry.select(*NAME)
        .distinct()
        .groupBy("schema", "table")
        .agg(F.sort_array(F.collect_set("catalog")).alias("catalogs"))
    )


def apply_name_exclusions(
    registry: DataFrame, schemas: Iterable[str], tables: Iterable[str]
) -> DataFrame:
    return exclude_names(exclude_names(registry, "schema", schemas), "table", tables)


def existing_tables(candidates: DataFrame, registry: DataFrame) -> DataFrame:
    """Candidates (catalog, schema, table, …) that the registry knows."""
    return candidates.join(registry.select(*NAME), NAME, "left_semi")


def shared_catalogs(registry: DataFrame) -> DataFrame:
    """Catalogs that come from a share, to be excluded from the inventory."""
    return registry.filter(F.col("origin") == "share").select("catalog").distinct()


def to_refs(registry: DataFrame) -> list[TableRef]:
    """Registry rows on the driver: names and paths of tables, never their data."""
    rows = registry.select(*NAME, "path", "format").distinct().orderBy(*NAME).collect()
    return [TableRef(r["catalog"], r["schema"], r["table"], r["path"], r["format"]) for r in rows]
