"""Schemas of the eight base tables and the invoice view."""

from pyspark.sql import types as T

_INT, _LONG, _TEXT, _DOUBLE = T.IntegerType(), T.LongType(), T.StringType(), T.DoubleType()
_MONEY, _TAX = T.DecimalType(18, 2), T.DecimalType(18, 4)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


BASE_TABLES: dict[str, T.StructType] = {
    "tnota_fiscal": _schema(
        cod_empresa=_INT, numero=_LONG, dt_emissao=T.TimestampNTZType(), nfse=_INT,
        cancelada=_INT, nfe_desc_status=_TEXT, condicao_pagamento=_TEXT, cli_for=_INT,
        cfop=_TEXT, natureza_op=_TEXT, entrada=_TEXT, saida=_TEXT, razao_social=_TEXT,
    ),
    "tnota_fiscal_item": _schema(
        cod_empresa=_INT, numero_nf=_LONG, codigo=_LONG, produto=_TEXT, qtde=_DOUBLE,
        unidade=_TEXT, vl_total=_MONEY, vl_ipi=_TAX, guid_orcamento=_TEXT,
    ),
    "tnota_fiscal_servico": _schema(
        cod_empresa=_INT, numero_nf=_LONG, qtde=_DOUBLE, unidade=_TEXT, vl_total=_MONEY,
    ),
    "torcamento_itens": _schema(cod_empresa=_INT, guid_linha=_TEXT, cod_orcamento=_LONG),
    "torcamento": _schema(cod_empresa=_INT, codigo=_LONG, estagio_orc=_TEXT, status=_INT),
    "tos": _schema(cod_empresa=_INT, n_os=_TEXT, guid_orcamento=_TEXT, cod_pecas=_LONG),
    "tnota_fiscal_nfref": _schema(cod_empresa=_INT, nfref_numero_nf=_LONG, numero_nf=_LONG),
    "tordem_fat": _schema(cod_empresa=_INT, codigo=_LONG, status=_INT, numero_nf=_LONG),
}

LINE_VALUE = T.DecimalType(21, 4)
TOTAL_VALUE = T.DecimalType(38, 4)

# Column of the view -> the heading people know it by, in view order.
VIEW_HEADINGS: dict[str, str] = {
    "tipo": "Tipo",
    "nf": "NF",
    "data_emissao": "Data Emissão",
    "cancelada": "Cancelada",
    "status": "Status",
    "cfop": "CFOP",
    "natureza_operacao": "Natureza Operação",
    "entrada": "Entrada",
    "saida": "Saída",
    "cod_interno": "Cod Interno",
    "os": "OS",
    "cliente": "Cliente",
    "produto": "Produto",
    "qtd": "Qtd",
    "un": "Un",
    "valor": "Valor",
    "of": "OF",
}

# The columns a report shows, in order.
REPORT_COLUMNS = ("tipo", "nf", "data_emissao", "status", "os", "produto", "cliente", "valor")
