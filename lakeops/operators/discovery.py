"""Objects to migrate, from metadata tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The system schema of a warehouse, and the defaults of a procedure.
WAREHOUSE_SYSTEM_SCHEMAS = ("INFORMATION_SCHEMA",)
DEFAULT_SIGNATURE = "()"
DEFAULT_LANGUAGE = "SQL"


def in_system_schema(schema: Column, skip_schemas: Iterable[str], ignore_case: bool) -> Column:
    if ignore_case:
        return F.lower(schema).isin([s.lower() for s in skip_schemas])
    return schema.isin(list(skip_schemas))


def in_mapping(metadata: DataFrame, mapping: DataFrame) -> DataFrame:
    """Metadata of the mapped databases, with the pair it belongs to.

    Database names match in any case, as unquoted names do at the source; the
    spelling of the mapping is kept.
    """
    pairs = mapping.select(
        F.col("source_database").alias("_source"),
        F.col("destination_catalog").alias("dst_cat"),
        F.upper("source_database").alias("_db"),
    )
    joined = metadata.withColumn("_db", F.upper("src_db")).drop("src_db").join(pairs, "_db", "inner").drop("_db")
    return joined.withColumnRenamed("_source", "src_db")


def procedure_language(language: Column) -> Column:
    return F.coalesce(F.upper(F.nullif(language, F.lit(""))), F.lit(DEFAULT_LANGUAGE))


def argument_signature(signature: Column) -> Column:
    return F.coalesce(F.nullif(signature, F.lit("")), F.lit(DEFAULT_SIGNATURE))


def discover_objects(
    mapping: DataFrame,
    tables: DataFrame,
    procedures: DataFrame | None = None,
    skip_schemas: Iterable[str] = WAREHOUSE_SYSTEM_SCHEMAS,
    ignore_case: bool = False,
    *,
    ordered: bool = True,
) -> DataFrame:
    """Tables, views and procedures of the mapped databases in one list.

    Everything whose type is not a plain view counts as a table. Sorted by
    schema and name unless ``ordered`` is false.
    """
    found = in_mapping(tables.filter(~in_system_schema(F.col("table_schema"), skip_schemas, ignore_case)), mapping)
    objects = found.select(
        F.when(F.upper("table_type") == "VIEW", "view").otherwise("table").alias("kind"),
        "src_db",
        "dst_cat",
        F.col("table_schema").alias("schema"),
        F.col("table_name").alias("name"),
    )
    if procedures is not None:
        kept = procedures.filter(~in_system_schema(F.col("procedure_schema"), skip_schemas, ignore_case))
        procs = in_mapping(kept, mapping).select(
            F.lit("procedure").alias("kind"),
            "src_db",
            "dst_cat",
            F.col("procedure_schema").alias("schema"),
            F.col("procedure_name").alias("name"),
            argument_signature(F.col("argument_signature")).alias("arg_sig"),
            "return_type",
            procedure_language(F.col("procedure_language")).alias("language"),
            F.col("procedure_definition").alias("body"),
            "comment",
        )
        objects = objects.unionByName(procs, allowMissingColumns=True)
    return objects.orderBy("schema", "name", "src_db") if ordered else objects


def object_counts(objects: DataFrame) -> DataFrame:
    """Objects per source database and kind."""
    return objects.groupBy("src_db", "kind").agg(F.count(F.lit(1)).alias("n_objects"))


def join_metadata(objects: DataFrame, metadata: DataFrame) -> DataFrame:
    """Left join on (src_db, schema, name), the database in any case."""
    keyed = metadata.withColumn("_db", F.upper("src_db")).drop("src_db")
    return objects.withColumn("_db", F.upper("src_db")).join(keyed, ["_db", "schema", "name"], "left").drop("_db")


def attach_definitions(objects: DataFrame, definitions: DataFrame) -> DataFrame:
    """Definition text of each object, null where the source has none."""
    texts = definitions.select(
        "src_db", F.col("table_schema").alias("schema"), F.col("table_name").alias("name"), "view_definition"
    )
    return join_metadata(objects, texts)
