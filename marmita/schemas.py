"""Shapes of the archived envelope and of the JSON document inside it.

The payload schema can be narrowed to some entities, and to some fields of an
entity.  The same narrowing serves the JSON parser (which then skips the other
sub-documents) and the parquet reader of the parsed table (which then does not
fetch the other leaf columns).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

# Field names and types of the delivery payload.
ITEM_FIELDS = {
    "ItemID": "STRING",
    "nome": "STRING",
    "categoria": "STRING",
    "preco": "DOUBLE",
    "MerchantID": "STRING",
    "quantidade": "DOUBLE",
    "valor_total_item": "DOUBLE",
    "created_at": "STRING",
}
ENTITY_FIELDS = {
    "clientes": {
        "ClientID": "STRING",
        "nome": "STRING",
        "endereco": "STRING",
        "CPF": "STRING",
        "tipo_pagamento": "STRING",
        "created_at": "STRING",
    },
    "restaurantes": {
        "MerchantID": "STRING",
        "nome": "STRING",
        "endereco": "STRING",
        "CNPJ": "STRING",
        "created_at": "STRING",
    },
    "items": ITEM_FIELDS,
    "drivers": {
        "DriversID": "STRING",
        "nome": "STRING",
        "endereco": "STRING",
        "veiculo": "STRING",
        "placa": "STRING",
        "created_at": "STRING",
    },
    "orders": {
        "PedidoID": "STRING",
        "ClientID": "STRING",
        "MerchantID": "STRING",
        "DriversID": "STRING",
        "Produtos": "ITEM_ARRAY",
        "quantidade_total": "DOUBLE",
        "valor_total": "DOUBLE",
        "tipo_pagamento": "STRING",
        "created_at": "STRING",
    },
}
HEADER_FIELDS = ("batch_id", "ingestion_ts", "source_system", "schema_version")

# The capture envelope, one row per event.
ENVELOPE_DDL = (
    "SequenceNumber BIGINT, Offset STRING, EnqueuedTimeUtc STRING, "
    "SystemProperties MAP<STRING, STRING>, Properties MAP<STRING, STRING>, Body BINARY"
)

# One saved reply of the cost service.  Rows hold mixed scalars;
# reading each as text keeps them all.
COST_RESPONSE_DDL = (
    "properties STRUCT<columns: ARRAY<STRUCT<name: STRING>>, rows: ARRAY<ARRAY<STRING>>>"
)

Keep = Mapping[str, Sequence[str] | None]


def _struct(fields: Mapping[str, str]) -> str:
    return "STRUCT<" + ", ".join(f"`{name}`: {kind}" for name, kind in fields.items()) + ">"


def tables_ddl(keep: Keep | None = None) -> str:
    """Type of the payload's ``tables`` struct, narrowed to ``keep``.

    ``keep`` maps an entity to the fields wanted of it, ``None`` meaning all.
    """
    keep = dict.fromkeys(ENTITY_FIELDS) if keep is None else keep
    entities = {}
    for entity, known in ENTITY_FIELDS.items():
        if entity not in keep:
            continue
        wanted = known if keep[entity] is None else keep[entity]
        fields = {
            name: f"ARRAY<{_struct(ITEM_FIELDS)}>" if kind == "ITEM_ARRAY" else kind
            for name, kind in known.items()
            if name in wanted
        }
        entities[entity] = f"ARRAY<{_struct(fields)}>"
    return _struct(entities)


def payload_ddl(keep: Keep | None = None) -> str:
    """Schema for parsing one JSON document."""
    header = ", ".join(f"`{name}` STRING" for name in HEADER_FIELDS)
    if keep is not None and not keep:
        return header
    return f"{header}, `tables` {tables_ddl(keep)}"


def batches_ddl(keep: Keep | None = None) -> str:
    """Read schema of the parsed batch table: what silver needs of it."""
    return f"sequence_number BIGINT, enqueued_time_utc TIMESTAMP, batch_id STRING, tables {tables_ddl(keep)}"
