"""Classification tags and the governed views built from them."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marmita.functions.masks import hidden, initial_only, last_four_strict, pseudonym

# Classification of tables and columns.  Bronze and menu items
# are ours; without them raw bodies full of personal data would be untagged.
TABLE_TAGS = {
    "bronze_eventhub_capture_raw": {"layer": "bronze", "classification": "restricted", "contains_pii": "true", "domain": "ingestion"},
    "bronze_delivery_batches": {"layer": "bronze", "classification": "restricted", "contains_pii": "true", "domain": "ingestion"},
    "silver_clientes": {"layer": "silver", "classification": "restricted", "contains_pii": "true", "domain": "customer"},
    "silver_restaurantes": {"layer": "silver", "classification": "confidential", "contains_pii": "true", "domain": "restaurant"},
    "silver_drivers": {"layer": "silver", "classification": "restricted", "contains_pii": "true", "domain": "driver"},
    "silver_items": {"layer": "silver", "classification": "internal", "contains_financial": "true", "domain": "menu"},
    "silver_orders": {"layer": "silver", "classification": "internal", "contains_financial": "true", "domain": "order"},
    "silver_order_items": {"layer": "silver", "classification": "internal", "contains_financial": "true", "domain": "order"},
    "gold_daily_delivery_kpis": {"layer": "gold", "classification": "business", "contains_pii": "false", "domain": "analytics"},
    "gold_restaurant_performance": {"layer": "gold", "classification": "business", "contains_pii": "false", "domain": "analytics"},
    "gold_item_category_metrics": {"layer": "gold", "classification": "business", "contains_pii": "false", "domain": "analytics"},
}
COLUMN_TAGS = {
    "bronze_eventhub_capture_raw": {"body_json": "PII_HIGH"},
    "bronze_delivery_batches": {"body_json": "PII_HIGH", "tables": "PII_HIGH"},
    "silver_clientes": {"nome": "PII", "endereco": "PII", "cpf": "PII_HIGH"},
    "silver_restaurantes": {"endereco": "PII", "cnpj": "SENSITIVE_ID"},
    "silver_drivers": {"nome": "PII", "endereco": "PII", "placa": "SENSITIVE_ID"},
    "silver_items": {"preco": "FINANCIAL"},
    "silver_orders": {"valor_total": "FINANCIAL", "client_id": "BUSINESS_KEY", "driver_id": "BUSINESS_KEY"},
    "silver_order_items": {"preco": "FINANCIAL", "valor_total_item": "FINANCIAL"},
}

# Properties of the schema that holds the governed views.
SCHEMA_TAGS = {"layer": "governance", "domain": "delivery", "contains_masked_views": "true"}

Masks = Mapping[str, Callable[[Column], Column] | None]
COMMENT = "classification: "


def analyst_masks(secret: str | None = None) -> Masks:
    """What an analyst sees of each class.  Financial values stay readable; business keys become pseudonyms, or
    are hidden without a ``secret``."""
    return {
        "PII": initial_only,
        "PII_HIGH": last_four_strict,
        "SENSITIVE_ID": last_four_strict,
        "BUSINESS_KEY": partial(pseudonym, secret=secret) if secret else hidden,
        "FINANCIAL": None,
    }


# What the governed views show.  view -> (table, {column: SQL expression})
_INITIAL = "substr(nome, 1, 1) || '***'"
VIEWS = {
    "vw_clientes_analyst": ("silver_clientes", {
        "client_id": "client_id", "nome": _INITIAL, "cpf_mascarado": "'***' || substr(cpf, -4)",
        "tipo_pagamento": "tipo_pagamento", "created_at": "created_at",
    }),
    "vw_drivers_analyst": ("silver_drivers", {
        "driver_id": "driver_id", "nome": _INITIAL, "veiculo": "veiculo",
        "placa_mascarada": "'***-' || substr(placa, -4)", "created_at": "created_at",
    }),
    "vw_orders_analytics": ("silver_orders", {name: name for name in (
        "order_id", "restaurant_id", "quantidade_total", "valor_total", "tipo_pagamento", "order_date",
        "order_year", "order_month", "order_day", "order_hour", "amount_category",
    )}),
    "vw_gold_delivery_dashboard": ("gold_daily_delivery_kpis", {}),
}


def _projection(view: str) -> list[str]:
    columns = VIEWS[view][1]
    return [f"{expression} AS {name}" for name, expression in columns.items()] or ["*"]


def governed(view: str, table: DataFrame) -> DataFrame:
    """What ``view`` shows of a DataFrame holding its table."""
    return table.selectExpr(*_projection(view))


def create_views(spark: SparkSession, schema: str, governance_schema: str) -> list[str]:
    """Stored views over the catalog tables of ``schema``."""
    for view, (table, _) in VIEWS.items():
        spark.sql(
            f"CREATE OR REPLACE VIEW {governance_schema}.{view} AS "
            f"SELECT {', '.join(_projection(view))} FROM {schema}.{table}")
    return list(VIEWS)


def tag_columns(df: DataFrame, table: str, tags: Mapping[str, Mapping[str, str]] = COLUMN_TAGS) -> DataFrame:
    """Classification as column metadata, which survives parquet and saveAsTable."""
    for column, classification in tags.get(table, {}).items():
        if column in df.columns:
            df = df.withMetadata(column, df.schema[column].metadata | {"classification": classification})
    return df


def _listed(tags: Mapping[str, str]) -> str:
    return ", ".join(f"'{key}' = '{value}'" for key, value in tags.items())


def tag_schema(spark: SparkSession, schema: str) -> None:
    spark.sql(f"ALTER SCHEMA {schema} SET DBPROPERTIES ({_listed(SCHEMA_TAGS)})")


def tag_table(spark: SparkSession, qualified_name: str, table: str) -> None:
    """Table tags as table properties, column tags as comments: both are kept by the catalog and come back with a read."""
    spark.sql(f"ALTER TABLE {qualified_name} SET TBLPROPERTIES ({_listed(TABLE_TAGS[table])})")
    for column, classification in COLUMN_TAGS.get(table, {}).items():
        spark.sql(f"ALTER TABLE {qualified_name} ALTER COLUMN {column} COMMENT '{COMMENT}{classification}'")


def classification_of(df: DataFrame) -> dict[str, str]:
    """Classes of the tagged columns, from their metadata or, in a catalog table, their comments."""
    found = {}
    for f in df.schema:
        comment = f.metadata.get("comment") or ""
        if "classification" in f.metadata:
            found[f.name] = f.metadata["classification"]
        elif comment.startswith(COMMENT):
            found[f.name] = comment.removeprefix(COMMENT)
    return found


def mask_table(spark: SparkSession, qualified_name: str, secret: str | None = None) -> DataFrame:
    """A catalog table as an analyst may see it.

    A table whose tags say that it holds personal or financial data, or that has no tags at all, is refused unless its columns
    are classified: nothing is shown because a tag got lost.
    """
    table = qualified_name.split(".")[-1].strip("`")
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {qualified_name}").collect()}
    df = spark.table(qualified_name)
    missing = set(COLUMN_TAGS.get(table, {})) - set(classification_of(df))
    if "classification" not in properties or missing:
        raise ValueError(f"{qualified_name} has no classification for {sorted(missing) or 'the table'}; tag it first")
    if not classification_of(df) and properties.get("contains_pii") != "false":
        raise ValueError(f"no column of {qualified_name} is classified")
    return mask_by_tag(df, analyst_masks(secret)) if classification_of(df) else df


def mask_by_tag(df: DataFrame, masks: Masks | None = None) -> DataFrame:
    """Mask every column by its classification tag; a class without a mask is hidden, a frame without tags refused."""
    classes = classification_of(df)
    if not classes:
        raise ValueError("no column is classified: tag the columns first")
    masks = analyst_masks() if masks is None else masks

    def shown(name: str) -> Column:
        column = F.col(name)
        if name not in classes:
            return column
        if df.schema[name].dataType.simpleString() != "string" and classes[name] not in ("FINANCIAL",):
            return F.lit(None).cast("string").alias(name)
        mask = masks.get(classes[name], hidden)
        return column if mask is None else mask(column).alias(name)

    return df.select(*(shown(name) for name in df.columns))
