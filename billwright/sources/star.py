"""The eight base tables derived from a star schema of orders, lines, parts and suppliers.

A stand-in for an invoicing database: the tables carry the shapes, nulls, blanks
and repeated keys the view has to cope with, at any scale. The statements run
unchanged in Spark and in other SQL engines; ``{orders}`` and the like stand for
the star tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from billwright.sources.tables import InvoiceTables

STATEMENTS: dict[str, str] = {
    "tnota_fiscal": """
select case when o_orderkey%17=0 then 2 else 1 end cod_empresa, o_orderkey numero, o_orderdate dt_emissao,
 case when o_orderkey%7=0 then 1 else 0 end nfse,
 case when o_orderstatus='P' and o_orderkey%5=0 then 1 else 0 end cancelada,
 case o_orderpriority when '4-NOT SPECIFIED' then null when '5-LOW' then '' else 'AUTORIZADA' end nfe_desc_status,
 case when o_orderkey%11=0 then null when o_orderkey%11=1 then '' else '30 DIAS' end condicao_pagamento,
 case when o_orderkey%13=0 then 1 else 0 end cli_for,
 case o_orderkey%12 when 0 then '5101' when 1 then '5102' when 2 then '5124' when 3 then '5933' when 4 then '6101'
  when 5 then '6102' when 6 then '6118' when 7 then '6123' when 8 then '6124' when 9 then '6933' when 10 then '5910' else '6949' end cfop,
 o_orderpriority natureza_op, case when o_orderkey%19<3 then 'X' end entrada,
 case when o_orderkey%19>=3 then 'X' end saida, c_name razao_social
from {orders} join {customer} on o_custkey=c_custkey""",
    "tnota_fiscal_item": """
select case when l_orderkey%17=0 or l_partkey%37=0 then 2 else 1 end cod_empresa, l_orderkey numero_nf, l_partkey codigo,
 case when l_partkey%23=0 then null else p_name end produto, l_quantity qtde, p_type unidade,
 cast(l_extendedprice as decimal(18,2)) vl_total,
 case when l_linenumber=7 and l_tax=0 then null
  else cast(cast(l_extendedprice as decimal(12,2))*cast(l_tax as decimal(4,2)) as decimal(18,4)) end vl_ipi,
 case when l_linenumber<=4 then 'G'||cast(l_partkey as string) end guid_orcamento
from {lineitem} join {part} on l_partkey=p_partkey where l_orderkey%14<>0""",
    "tnota_fiscal_servico": """
select case when o_orderkey%17=0 or o_custkey%37=0 then 2 else 1 end cod_empresa, o_orderkey numero_nf, cast(1 as double) qtde,
 'SV' unidade, cast(o_totalprice as decimal(18,2)) vl_total from {orders} where o_orderkey%7=0""",
    "torcamento_itens": """
select case when p_partkey%17=0 then 2 else 1 end cod_empresa, 'G'||cast(p_partkey as string) guid_linha,
 p_partkey%10 cod_orcamento from {part}
union all select 1, 'G'||cast(p_partkey as string), p_partkey%10 from {part} where p_partkey%29=0""",
    "torcamento": """
select 1 cod_empresa, s_suppkey codigo, case when s_suppkey%3=0 then 'GANHOU' else 'PERDIDO' end estagio_orc, 1 status from {supplier}
union all select 1, s_suppkey, 'GANHOU', 1 from {supplier} where s_suppkey in (6,7)
union all select 2, s_suppkey, 'GANHOU', 1 from {supplier} where s_suppkey=3
union all select 1, s_suppkey, 'GANHOU', 0 from {supplier} where s_suppkey=9""",
    "tos": """
select 1 cod_empresa, case when p_partkey%9=0 then 'e' else 'OS' end||cast(p_partkey as string) n_os,
 case when p_partkey%4<>0 then 'G'||cast(p_partkey as string) end guid_orcamento,
 case when p_partkey%5<>0 then p_partkey end cod_pecas from {part}
union all select 1, 'OX'||cast(p_partkey as string), 'G'||cast(p_partkey as string), null from {part} where p_partkey%31=0
union all select 2, 'AA'||cast(p_partkey as string), 'G'||cast(p_partkey as string), p_partkey from {part} where p_partkey%41=0""",
    "tnota_fiscal_nfref": """
select case when l_orderkey%5=1 then 2 else 1 end cod_empresa, l_orderkey nfref_numero_nf, l_orderkey+1000000+l_linenumber numero_nf
from {lineitem} where l_returnflag='R' and l_linenumber<=2 and l_orderkey%3=0""",
    "tordem_fat": """
select case when o_orderkey%3=0 then 2 else 1 end cod_empresa, o_orderkey+500000 codigo, case when o_orderkey%4=0 then 1 else 0 end status, o_orderkey numero_nf
from {orders} where o_orderkey%2=0""",
}

# The columns read from each star table; declared, so that no file is opened to infer them.
_LONG, _INT, _TEXT, _DOUBLE = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType()
STAR_COLUMNS: dict[str, dict[str, T.DataType]] = {
    "orders": {
        "o_orderkey": _LONG, "o_custkey": _LONG, "o_orderstatus": _TEXT, "o_totalprice": _DOUBLE,
        "o_orderdate": T.TimestampNTZType(), "o_orderpriority": _TEXT,
    },
    "customer": {"c_custkey": _LONG, "c_name": _TEXT},
    "lineitem": {
        "l_orderkey": _LONG, "l_partkey": _LONG, "l_linenumber": _INT, "l_quantity": _DOUBLE,
        "l_extendedprice": _DOUBLE, "l_tax": _DOUBLE, "l_returnflag": _TEXT,
    },
    "part": {"p_partkey": _LONG, "p_name": _TEXT, "p_type": _TEXT},
    "supplier": {"s_suppkey": _LONG},
}


def star_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    columns = STAR_COLUMNS[name].items()
    schema = T.StructType([T.StructField(column, kind) for column, kind in columns])
    return spark.read.schema(schema).parquet(f"{folder}/{name}.parquet")


def star_tables(spark: SparkSession, folder: str) -> InvoiceTables:
    """The base tables over the star schema in ``folder``."""

    def read(name: str) -> DataFrame:
        statement = STATEMENTS[name]
        used = [table for table in STAR_COLUMNS if f"{{{table}}}" in statement]
        return spark.sql(statement, **{table: star_table(spark, folder, table) for table in used})

    return InvoiceTables(read)
