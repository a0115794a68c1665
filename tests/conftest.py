from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "scripts"))

from marmita.schemas import ENVELOPE_DDL  # noqa: E402
from marmita.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("spark")
    session = build_session("marmita-tests", "local[*]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "6g",
        "spark.sql.warehouse.dir": str(scratch / "warehouse"),
        "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


STAMP = "2024-05-01T12:00:00+00:00"


def client(id="C1", **changes):
    return {"ClientID": id, "nome": "Ana", "endereco": "Rua 1", "CPF": "12345678901",
            "tipo_pagamento": "PIX", "created_at": STAMP} | changes


def restaurant(id="R1", **changes):
    return {"MerchantID": id, "nome": "Cantina", "endereco": "Rua 2", "CNPJ": "12345678901234",
            "created_at": STAMP} | changes


def driver(id="D1", **changes):
    return {"DriversID": id, "nome": "Davi", "endereco": "Rua 3", "veiculo": "moto",
            "placa": "ABC-1234", "created_at": STAMP} | changes


def item(id="I1", **changes):
    return {"ItemID": id, "nome": "Clássica", "categoria": "Pizza", "preco": 30.5, "MerchantID": "R1",
            "created_at": STAMP} | changes


def line(id="I1", **changes):
    return item(id, quantidade=2, valor_total_item=61.0) | changes


def order(id="P1", **changes):
    return {"PedidoID": id, "ClientID": "C1", "MerchantID": "R1", "DriversID": "D1", "Produtos": [line()],
            "quantidade_total": 2, "valor_total": 61.0, "tipo_pagamento": "PIX", "created_at": STAMP} | changes


def payload(batch_id="b1", **tables):
    return json.dumps({"batch_id": batch_id, "ingestion_ts": STAMP, "source_system": "test",
                       "schema_version": "1.0", "tables": tables}, ensure_ascii=False)


class Archive:
    """A folder of capture files, one file per call."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.next = spark, str(folder), 0

    def add(self, *bodies, enqueued=STAMP, sub=""):
        rows = []
        for body in bodies:
            rows.append((self.next, str(self.next), enqueued, {"k": "v"}, {"event_type": "t"},
                         None if body is None else bytearray(body, "utf-8")))
            self.next += 1
        df = self.spark.createDataFrame(rows, ENVELOPE_DDL).coalesce(1)
        df.write.mode("append").parquet(f"{self.folder}/{sub}".rstrip("/"))
        return self


@pytest.fixture
def archive(spark, tmp_path):
    return Archive(spark, tmp_path / "archive")


@pytest.fixture
def batches(spark):
    """Parsed batches out of body texts, in arrival order."""
    from marmita.operators.bronze import parse_batches

    def build(*bodies):
        rows = [(i, body) for i, body in enumerate(bodies)]
        raw = spark.createDataFrame(rows, "sequence_number BIGINT, body_json STRING")
        return parse_batches(raw.selectExpr("*", f"TIMESTAMP'{STAMP}' AS enqueued_time_utc"))

    return build
