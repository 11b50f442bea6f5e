"""Columns of the tables that the engine keeps, as schemas; a later version adds to the one before it."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

#: Changes of each version: table -> columns that it adds, as DDL.
VERSIONS: list[dict[str, str]] = [
    {
        "dealerships": "id bigint, brand_slug string, name string, address string, suburb string, state string, postcode string, phone string, website_url string, scrape_state string",
        "contacts": "id bigint, dealership_id bigint, full_name string, first_name string, last_name string, role_raw string, role_normalised string, email string, email_domain string, email_pattern string, phone string, confidence string, source string",
    },
    {"dealerships": "api_email string", "contacts": "cm_status string, suppressed boolean, suppress_reason string"},
    {"contacts": "source_detail string, source_date date, export_batch int, disposition string, ruled_out_stage string, proximity_tier string, verify_status string, verify_mx string, sent_at date, ooo_at date"},
    {"active_subscribers": "email string, first_name string, last_name string, name_key string"},
    {
        "dealerships": "dealer_group_id bigint, team_page_url string, team_page_html string, discovered_at timestamp, scraped_at timestamp",
        "contacts": "exported_at timestamp, created_at timestamp, company string, details string, ruled_out_reason string, send_group string, verify_provider string, verify_catchall boolean, verify_detail string, verify_checked_at timestamp",
        "active_subscribers": "captured_at timestamp",
        "send_events": "id bigint, contact_id bigint, email string, campaign string, event string, bounce_type string, occurred_at timestamp, detail string, created_at timestamp",
        "ooo_domain_formats": "domain string, pattern string, sample_email string, sender_count int, pattern_count int, first_seen_at timestamp, updated_at timestamp",
    },
]


def schema(table: str, version: int | None = None) -> StructType:
    """A table's columns as of a version (1 is the first; by default the last)."""
    parts = [v[table] for v in VERSIONS[:version] if table in v]
    if not parts:
        raise KeyError(table)
    return StructType.fromDDL(", ".join(parts))


def migrated(rows: DataFrame, table: str, version: int | None = None) -> DataFrame:
    """Rows in a table's columns: those it lacks are null, others go."""
    return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema(table, version)])


def _checked(rows: DataFrame, name: str, kind: DataType) -> Column:
    """A column in another type; a value that is none of it is an error, not a null."""
    value = F.col(f"`{name}`").try_cast(kind)
    wrong = F.raise_error(F.concat(F.lit(f"{name}: no {kind.simpleString()}: "), F.col(f"`{name}`").cast("string")))
    return F.when(F.col(f"`{name}`").isNotNull() & value.isNull(), wrong).otherwise(value)


def version_of(rows: DataFrame, table: str) -> int:
    """The first version of a table that has all the columns of some rows."""
    for v in range(1, len(VERSIONS) + 1):
        if any(table in older for older in VERSIONS[:v]) and set(rows.columns) <= set(schema(table, v).names):
            return v
    raise ValueError(f"{table}: no version has {sorted(set(rows.columns) - set(schema(table).names))}")


def stored(spark: SparkSession, paths: list[str], table: str, version: int | None = None) -> DataFrame:
    """Files of any earlier versions of a table as rows of one version: columns that came later are null, those of other
    types are cast, value by value. A folder with a column that no version knows, or knows only later, is an error.

    Each folder is read by its own columns; nothing is written. `version` of the rows is that of their folder.
    """
    parts, names = [], schema(table, version)
    for path in paths:
        rows = spark.read.parquet(path)
        own = version_of(rows, table)
        if version is not None and own > version:
            raise ValueError(f"{path} is of version {own}, later than {version}")
        kept = [(_checked(rows, f.name, f.dataType) if rows.schema[f.name].dataType != f.dataType else F.col(f"`{f.name}`")) if f.name in rows.columns else F.lit(None).cast(f.dataType) for f in names]
        parts.append(rows.select(*[c.alias(f.name) for c, f in zip(kept, names, strict=True)], F.lit(own).alias("version")))
    return functools.reduce(DataFrame.unionByName, parts)
