"""One local session for all tests, and the small invoice fixture."""

from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import SparkSession

from billwright import InvoiceTables
from billwright.schemas import BASE_TABLES

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def _header(numero, day, cfop, client, hour=0, **changes):
    row = {
        "cod_empresa": 1, "numero": numero, "dt_emissao": datetime.datetime(2026, *day, hour),
        "nfse": 0, "cancelada": 0, "nfe_desc_status": "AUT", "condicao_pagamento": "30D",
        "cli_for": 0, "cfop": cfop, "natureza_op": "VENDA", "entrada": None, "saida": "X",
        "razao_social": client,
    }
    return row | changes


HEADERS = [
    _header(1, (4, 30), "5101", "Alfa", 10),
    _header(2, (5, 4), "5101", "Alfa", 9, cancelada=1),
    _header(3, (5, 4), "5102", "Fernando ME", 9),
    _header(4, (5, 5), "5933", "Beta", nfse=1, nfe_desc_status=None),
    _header(5, (5, 5), "6101", "Beta", nfe_desc_status=None),
    _header(6, (5, 5), "6102", "Beta", nfe_desc_status="   "),
    _header(7, (5, 6), "6118", "Gama", cancelada=None),
    _header(8, (5, 6), "5101", "Forn", cli_for=1),
    _header(9, (5, 6), "5101", "Gama", condicao_pagamento=""),
    _header(10, (5, 6), "5101", "Gama", condicao_pagamento=None),
    _header(11, (5, 6), "5101", "Gama", cod_empresa=2),
    _header(12, (5, 7), "6123", "Gama"),
    _header(13, (5, 7), "6124", "Gama"),
    _header(14, (5, 7), "6933", "Delta", nfse=1),
    _header(15, (5, 8), "5124", "Delta"),
    _header(16, (5, 8), "5101", "Delta"),
    _header(17, (5, 8), "5101", "Delta"),
    _header(18, (5, 11), "5910", "Delta"),
    _header(19, (5, 11), "5101", "Delta", entrada="X", saida=None),
    _header(20, (5, 11), "5101", "Delta"),
]

GOODS = [
    (1, 100, "Painel", 1, "UN", 100, 10, None), (2, 100, "Painel", 1, "UN", 200, 0, None),
    (3, 100, None, 1, "UN", 300, 0, None), (5, 100, "Painel", 1, "UN", 500, 0, None),
    (6, 100, "Painel", 1, "UN", 600, 0, None), (7, 100, "Painel", 2, "UN", 700, 70, None),
    (13, 100, "Painel", 1, "UN", 1300, None, None), (14, 100, "Painel", 1, "UN", 14, 0, None),
    (14, 101, "Cabo", 1, "MT", 15, 0, None), (15, 100, "Painel", 1, "UN", 1500, 0, "GA"),
    (16, 700, "Bananal", 1, "UN", 1600, 0, None), (17, 999, "Painel", 1, "UN", 1700, 0, "GE"),
    (18, 100, "Painel", 1, "UN", 1800, 0, None), (19, 100, "Painel", 1, "UN", 1900, 0, None),
    (20, 100, "Painel", 1, "UN", 2000, 0, None),
]


def _money(value):
    return None if value is None else Decimal(value)


ROWS = {
    "tnota_fiscal": [tuple(row.values()) for row in HEADERS],
    "tnota_fiscal_item": [
        (1, nf, code, product, float(qty), unit, _money(total), _money(tax), guid)
        for nf, code, product, qty, unit, total, tax, guid in GOODS
    ],
    "tnota_fiscal_servico": [
        (1, 4, 3.0, "HR", _money(400)), (1, 14, 1.0, "HR", _money(1)),
        (1, 14, 1.0, "HR", _money(2)),
    ],
    "torcamento_itens": [(1, "GA", 10)],
    "torcamento": [(1, 10, "PERDIDO", 1)],
    "tos": [
        (1, "OS1", "GA", 50), (1, "OS2", "GA", 51), (1, "e5", "GE", 999), (1, "OS9", None, 700),
        (1, "OS7", None, 700), (1, "E3", None, 700), (1, None, "GE", 52),
    ],
    "tnota_fiscal_nfref": [(1, 2, 89), (1, 3, 91), (1, 3, 90), (1, 20, None), (2, 7, 92)],
    "tordem_fat": [(1, 8001, 1, 1), (1, 8000, 1, 3), (1, 8002, 0, 5)],
}


@pytest.fixture(scope="session")
def tables(spark):
    return InvoiceTables(lambda name: spark.createDataFrame(ROWS[name], BASE_TABLES[name]))


def bag(df):
    """The rows as a sorted list, for comparisons that ignore order but not copies."""
    return sorted((tuple(row) for row in df.collect()), key=lambda row: [(v is None, str(v)) for v in row])
