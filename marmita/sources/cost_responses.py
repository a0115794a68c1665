"""Saved replies of the cloud-cost service, and the given line items in that form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marmita.schemas import COST_RESPONSE_DDL

# Service column -> our column, in the order of our table.
COST_COLUMNS = {
    "UsageDate": "usage_date",
    "PreTaxCost": "pretax_cost",
    "ResourceId": "resource_id",
    "ResourceType": "resource_type",
    "ResourceGroupName": "resource_group",
    "ServiceName": "service_name",
    "MeterCategory": "meter_category",
    "MeterSubcategory": "meter_subcategory",
    "Currency": "currency",
}


def _cleaned(columns: dict[str, Column]) -> list[Column]:
    """A missing or null cost is ``0``; the date goes from ``yyyyMMdd`` to ISO, a malformed one to null."""
    columns = columns | {
        "usage_date": F.try_to_date(columns["usage_date"], "yyyyMMdd").cast("string"),
        "pretax_cost": F.coalesce(columns["pretax_cost"], F.lit("0")),
    }
    return [column.alias(name) for name, column in columns.items()]


def reshape_responses(responses: DataFrame, body: str = "body_json") -> DataFrame:
    """Column list plus row arrays -> one all-text row per cost line.

    A column the reply does not carry is null.
    """
    lines = (
        responses.select(F.from_json(body, COST_RESPONSE_DDL).alias("reply"))
        .select(
            F.transform("reply.properties.columns", lambda c: c["name"]).alias("names"),
            F.explode("reply.properties.rows").alias("line"),
        )
    )

    def value(name: str) -> Column:
        return F.get("line", (F.array_position("names", F.lit(name)) - 1).cast("int"))

    return lines.select(*_cleaned({ours: value(theirs) for theirs, ours in COST_COLUMNS.items()}))


# The given line items as raw usage, all text: per line one resource and two charges (base, tax).
# On purpose some dates are malformed, some costs missing or not a number.
_RESOURCE = {
    "UsageDate": "if(l_orderkey % 83 = 0, '199x0231', date_format(l_shipdate, 'yyyyMMdd'))",
    "ResourceId": "'res-' || cast(l_partkey as string)",
    "ResourceType": "'type-' || cast(l_partkey % 6 as string)",
    "ResourceGroupName": "'rg-' || cast(l_suppkey % 20 as string)",
    "ServiceName": "'svc-' || cast(l_suppkey % 5 as string)",
    "MeterCategory": "l_returnflag",
    "Currency": "'BRL'",
}
_CHARGES = {
    "base": "l_extendedprice",
    "tax": "cast(round(l_extendedprice * l_tax * 100) as bigint) / 100D",
}
_NO_COST_COLUMN = "l_orderkey % 194 = 0"


def _charges() -> Column:
    def charge(meter: str, amount: str) -> Column:
        cost = (
            "case when l_orderkey % 97 = 0 then null when l_orderkey % 89 = 0 then 'n/a' "
            f"else cast(cast({amount} as decimal(18,6)) as string) end"
        )
        return F.struct(
            F.expr(cost).alias("PreTaxCost"),
            F.concat(F.col("l_linestatus"), F.lit(f"-{meter}")).alias("MeterSubcategory"),
        )

    return F.array(*(charge(meter, amount) for meter, amount in _CHARGES.items()))


def usage_rows(lineitem: DataFrame) -> DataFrame:
    """Raw usage as one all-text row per charge, under our column names.

    Unnesting comes first: the narrow line items are doubled, not the text made of them.
    """
    charged = lineitem.select("*", F.inline(_charges()))
    theirs = {name: F.expr(expression) for name, expression in _RESOURCE.items()}
    theirs |= {name: F.col(name) for name in ("PreTaxCost", "MeterSubcategory")}
    return charged.select(*_cleaned({ours: theirs[name] for name, ours in COST_COLUMNS.items()}))


def saved_responses(lineitem: DataFrame) -> DataFrame:
    """Raw usage as one reply document per line item; some replies carry no cost column at all."""
    resource = {name: F.expr(expression) for name, expression in _RESOURCE.items()}

    def reply(names: list[str]) -> Column:
        def line(charge: Column) -> Column:
            return F.array(*(F.col(n) if n in resource else charge[n] for n in names))

        return F.to_json(F.struct(F.struct(
            F.array(*(F.struct(F.lit(n).alias("name"), F.lit("any").alias("type")) for n in names)).alias("columns"),
            F.transform("charges", line).alias("rows"),
        ).alias("properties")))

    names = list(COST_COLUMNS)
    without_cost = [n for n in names if n != "PreTaxCost"]
    return lineitem.select(
        *(column.alias(name) for name, column in resource.items()),
        _charges().alias("charges"), F.expr(_NO_COST_COLUMN).alias("cost_left_out"),
    ).select(
        F.when(F.col("cost_left_out"), reply(without_cost)).otherwise(reply(names)).alias("body_json")
    )
