"""Sources and sinks (A)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fiscoframe.checks import check, dbl
from fiscoframe.operators.lookup import _unique
from fiscoframe.operators.predicates import Condition
from fiscoframe.plans.catalogue import extract
from fiscoframe.plans.parameters import Params
from fiscoframe.schemas import all_text, lower_names
from fiscoframe.session import work_folder
from fiscoframe.sources import sinks
from fiscoframe.sources.readers import (
    import_factors,
    read_inventory_items,
    read_inventory_movements,
    read_invoice_items,
    read_invoice_movements,
    read_ledger_items,
    read_ledger_movements,
    read_manual_factors,
)
from fiscoframe.sources.reference import STOCK_AUDIT, marked_cfop
from fiscoframe.sources.tables import base_year, by_precedence, for_taxpayer, list_taxpayers, read_mixed


def _folder(df, label: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{work_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"


@check(
    "A01_list_taxpayers",
    "SELECT DISTINCT lpad(CAST(c_custkey AS VARCHAR), 14, '0') AS cnpj FROM customer WHERE c_acctbal >= 0",
)
def a01(t):
    ids = F.when(F.col("c_acctbal") >= 0, F.lpad(F.col("c_custkey").cast("string"), 14, "0")).otherwise(F.col("c_name"))
    return list_taxpayers(t["customer"].select(ids.alias("cnpj")))


@check(
    "A01_scan_one_taxpayer",
    "SELECT id, cnpj, CAST(dt_ini AS VARCHAR) AS dt_ini FROM {reg_0000} WHERE cnpj = '77'",
)
def a01_scan(t):
    return for_taxpayer(t["reg_0000"], "77").select("id", "cnpj", "dt_ini")


@check(
    "A02_source_precedence",
    """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS cnpj, o_orderstatus FROM orders JOIN
       (SELECT o_custkey AS k, MIN(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END) AS best FROM orders GROUP BY o_custkey)
       ON k = o_custkey AND best = CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END""",
)
def a02(t):
    rows = t["orders"].select("o_orderkey", F.col("o_custkey").cast("string").alias("cnpj"), "o_orderstatus")
    return by_precedence([rows.where(F.col("o_orderstatus") == s) for s in ("F", "O", "P")])


_INVOICE_SQL = f"""
    SELECT co_emitente AS cnpj, prod_cprod AS codigo, prod_xprod AS descricao, prod_ncm AS ncm, prod_cest AS cest,
           CASE WHEN prod_ceantrib IS NULL OR prod_ceantrib = '' THEN prod_cean ELSE prod_ceantrib END AS gtin,
           prod_ucom AS unidade, CAST(year(dhemi) AS VARCHAR) AS ano,
           CAST(prod_vprod + coalesce(prod_vfrete, 0) + coalesce(prod_vseg, 0) + coalesce(prod_voutro, 0) - coalesce(prod_vdesc, 0) AS DOUBLE)
               AS valor_saida,
           CAST(prod_qcom AS DOUBLE) AS quantidade_saida
    FROM {{fato_nfe_detalhe}} WHERE co_tp_nf = 1 AND co_cfop IN (SELECT co_cfop FROM {{dm_cfop}} WHERE operacao_mercantil = 'X')"""


@check("A03_invoice_items", _INVOICE_SQL)
def a03(t):
    rows = read_invoice_items(t["nfe"], "NFe", marked_cfop(t["dm_cfop"]))
    return rows.select(
        "cnpj", "codigo", "descricao", "ncm", "cest", "gtin", "unidade", "ano", "valor_saida", "quantidade_saida"
    )


@check(
    "A04_ledger_items",
    """SELECT cnpj, cod_item AS codigo, descr_item AS descricao, unid AS unidade,
         CAST(CASE WHEN ind_oper = '0' THEN vl_item ELSE 0 END AS DOUBLE) AS valor_entrada,
         CAST(CASE WHEN ind_oper = '1' THEN vl_item ELSE 0 END AS DOUBLE) AS valor_saida,
         CAST(CASE WHEN ind_oper = '0' THEN qtd ELSE 0 END AS DOUBLE) AS quantidade_entrada,
         CAST(CASE WHEN ind_oper = '1' THEN qtd ELSE 0 END AS DOUBLE) AS quantidade_saida
       FROM {c170} WHERE cfop IN (SELECT co_cfop FROM {dm_cfop} WHERE operacao_mercantil = 'X')""",
)
def a04(t):
    rows = read_ledger_items(t["c170"], marked_cfop(t["dm_cfop"]))
    return rows.drop("descr_compl", "tipo_item", "ncm", "cest", "gtin", "fonte", "ano")


@check(
    "A05_inventory_items",
    "SELECT cnpj, codigo_produto AS codigo, descricao_produto AS descricao, tipo_item, cod_ncm AS ncm, cest, unidade_medida AS unidade, 'bloco_h' AS fonte FROM {bloco_h}",
)
def a05(t):
    return read_inventory_items(t["bloco_h"]).select(
        "cnpj", "codigo", "descricao", "tipo_item", "ncm", "cest", "unidade", "fonte"
    )


@check(
    "A06_sales_movements",
    """SELECT co_emitente AS cnpj, prod_cprod AS codigo, prod_ucom AS unid, CAST(0 AS DOUBLE) AS compras,
         CAST(prod_vprod + coalesce(prod_vfrete, 0) + coalesce(prod_vseg, 0) + coalesce(prod_voutro, 0) - coalesce(prod_vdesc, 0) AS DOUBLE) AS vendas
       FROM {fato_nfce_detalhe} WHERE co_tp_nf = 1""",
)
def a06_sales(t):
    return read_invoice_movements(t["nfce"]).select("cnpj", "codigo", "unid", "compras", "vendas")


@check(
    "A06_purchase_movements",
    """SELECT cnpj, cod_item AS codigo, unid, CAST(vl_item AS DOUBLE) AS compras, CAST(0 AS DOUBLE) AS vendas
       FROM {c170} WHERE ind_oper = '0' AND cfop IN (SELECT co_cfop FROM {dm_cfop} WHERE operacao_mercantil = 'X')""",
)
def a06_purchases(t):
    rows = read_ledger_movements(t["c170"], marked_cfop(t["dm_cfop"]))
    return rows.select("cnpj", "codigo", "unid", "compras", "vendas")


@check(
    "A06_inventory_movements",
    """SELECT cnpj, codigo_produto AS codigo, unidade_medida AS unid, CAST(0 AS DOUBLE) AS compras, CAST(0 AS DOUBLE) AS vendas
       FROM {bloco_h}""",
)
def a06_inventory(t):
    return read_inventory_movements(t["bloco_h"]).select("cnpj", "codigo", "unid", "compras", "vendas")


@check(
    "A07_marked_operation_codes",
    """SELECT 'mercantil' AS kind, co_cfop FROM {dm_cfop} WHERE operacao_mercantil = 'X'
       UNION ALL SELECT 'estoque', co_cfop FROM {dm_cfop} WHERE sisaudit_estoque = 'X'""",
)
def a07(t):
    a = marked_cfop(t["dm_cfop"]).select(F.lit("mercantil").alias("kind"), "co_cfop")
    return a.unionByName(marked_cfop(t["dm_cfop"], STOCK_AUDIT).select(F.lit("estoque").alias("kind"), "co_cfop"))


@check(
    "A08_classification_references",
    """SELECT it_nu_ncm, it_nu_cest, MIN(it_co_sefin) AS it_co_sefin FROM {sitafe_cest_ncm} GROUP BY it_nu_ncm, it_nu_cest""",
)
def a08(t):
    return _unique(t["sitafe_cest_ncm"], ["it_nu_ncm", "it_nu_cest"], "it_co_sefin")


@check("A08_codes_by_cest", "SELECT cest, MIN(`co-sefin`) AS codigo FROM {sitafe_cest} WHERE cest IS NOT NULL GROUP BY cest")
def a08_cest(t):
    return _unique(t["sitafe_cest"].withColumnRenamed("co-sefin", "codigo"), ["cest"], "codigo")


@check("A08_codes_by_ncm", "SELECT ncm, MIN(`co-sefin`) AS codigo FROM {sitafe_ncm} WHERE ncm IS NOT NULL GROUP BY ncm")
def a08_ncm(t):
    return _unique(t["sitafe_ncm"].withColumnRenamed("co-sefin", "codigo"), ["ncm"], "codigo")


@check("A08_product_names", "SELECT it_co_sefin, MIN(it_no_produto) AS it_no_produto FROM {sitafe_produto_sefin} WHERE it_co_sefin IS NOT NULL GROUP BY it_co_sefin")
def a08_names(t):
    return _unique(t["sitafe_produto_sefin"], ["it_co_sefin"], "it_no_produto")


@check(
    "A09_base_year",
    "SELECT CAST(o_custkey AS VARCHAR) AS cnpj, CAST(MIN(year(o_orderdate)) AS VARCHAR) AS ano_base FROM orders GROUP BY o_custkey",
)
def a09(t):
    return base_year(t["reg_0000"])


@check(
    "A10_manual_factors",
    """SELECT CAST(p_partkey AS VARCHAR) AS chave_produto, p_brand AS unidade, CAST(p_size AS DOUBLE) AS fator_conversao_manual
       FROM part WHERE p_size > 9 AND p_type <> 'ECONOMY'""",
)
def a10(t):
    edited = t["part"].select(
        F.col("p_partkey").alias("codigo_produto_ajustado"),
        F.when(F.col("p_type") != "ECONOMY", F.col("p_brand")).alias("unid"),
        F.when(F.col("p_size") > 9, F.col("p_size").cast("string")).otherwise(F.lit("n/d")).alias("fator"),
        F.lit("x").alias("justificativa"),
    )
    return read_manual_factors(edited)


@check(
    "A11_import_factors",
    """SELECT '2020' AS ano, p_partkey AS chave_produto, p_brand AS unidade, CAST(p_size AS DOUBLE) AS fator_de_conversao FROM part""",
)
def a11(t):
    edited = t["part"].select(
        F.lit("2020").alias("ano"),
        F.col("p_partkey").alias("codigo_produto_ajustado"),
        F.col("p_brand").alias("unid"),
        F.col("p_size").alias("fator"),
    )
    return import_factors(edited)


@check(
    "A13_extract_queries",
    """SELECT cnpj, strftime(dt_ini, '%m/%Y') AS periodo_efd, unid, descr FROM (SELECT *, row_number() OVER
         (PARTITION BY cnpj, dt_ini ORDER BY data_entrega DESC, id DESC) AS rn FROM {reg_0000} WHERE data_entrega <= DATE '1999-12-31')
       JOIN {reg_0190} u ON u.reg_0000_id = id WHERE rn = 1""",
)
def a13(t):
    root = _folder(t["orders"], "extract")
    done = extract(
        t, Params(cut_off="1999-12-31"), lambda n, df: sinks.write_table(df, f"{root}/{n}", partition=None), ["verif_cnpjs", "reg_0190"]
    )
    written = next(o for o in done if o.status == "written")
    spark = t["orders"].sparkSession
    return spark.read.parquet(written.detail).select("cnpj", "periodo_efd", "unid", "descr")


@check(
    "A14_parquet_with_comments",
    "SELECT p_partkey, p_name, p_brand, 'nome' AS comentario FROM part",
)
def a14(t):
    path = _folder(t["part"], "comments")
    sinks.write_table(t["part"].select("p_partkey", "p_name", "p_brand"), path, {"p_name": "nome"}, partition=None)
    back = t["part"].sparkSession.read.parquet(path)
    return back.withColumn("comentario", F.lit(back.schema["p_name"].metadata["comment"]))


@check(
    "A14_partitioned_table",
    "SELECT c_mktsegment, c_custkey, c_acctbal FROM customer",
)
def a14_partitioned(t):
    path = _folder(t["customer"], "partitioned")
    sinks.write_table(t["customer"].select("c_custkey", "c_acctbal", "c_mktsegment"), path, partition="c_mktsegment")
    return sinks.read_table(t["customer"].sparkSession, path)


@check(
    "A14_one_key_of_a_table",
    "SELECT c_mktsegment, c_custkey, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'",
)
def a14_one_key(t):
    path = _folder(t["customer"], "keyed")
    rows = t["customer"].select("c_custkey", "c_acctbal", "c_mktsegment")
    # what is stored first is replaced key by key
    sinks.write_table(rows.withColumn("c_acctbal", F.lit(0.0)), path, partition="c_mktsegment")
    sinks.write_table(rows.where(F.col("c_mktsegment") == "BUILDING"), path, partition="c_mktsegment")
    return sinks.read_table(rows.sparkSession, path, "BUILDING")


@check("A15_lower_names", "SELECT p_partkey AS chave_x, p_name AS nome FROM part")
def a15(t):
    return lower_names(t["part"].select(F.col("p_partkey").alias("CHAVE_X"), F.col("p_name").alias("Nome")))


@check(
    "A16_text_fallback",
    "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey FROM customer",
)
def a16(t):
    return all_text(t["customer"].select("c_custkey", "c_name", "c_nationkey"))


@check(
    "A16_files_of_different_types",
    """SELECT CASE c_custkey % 3 WHEN 0 THEN CAST(c_custkey AS VARCHAR) WHEN 1 THEN CAST(CAST(c_custkey AS DECIMAL(20,2)) AS VARCHAR) ELSE concat('c', c_custkey) END AS chave,
         c_custkey AS id, CAST(CASE WHEN c_custkey % 3 = 2 THEN NULL ELSE c_acctbal END AS DOUBLE) AS saldo FROM customer""",
)
def a16_files(t):
    """One folder where a column is a whole number, a decimal and text, and another is missing in some files."""
    rows, root = t["customer"], _folder(t["customer"], "mixed")
    key, part = F.col("c_custkey"), F.col("c_custkey") % 3
    written = [key.cast("bigint"), key.cast("decimal(20,2)"), F.concat(F.lit("c"), key.cast("string"))]
    for i, chave in enumerate(written):
        kept = [F.col("c_acctbal").cast("double").alias("saldo")] if i < 2 else []
        rows.where(part == i).select(chave.alias("chave"), key.cast("int" if i else "bigint").alias("id"), *kept).write.mode("append").parquet(root)
    return read_mixed(rows.sparkSession, root).select("chave", "id", "saldo")


@check(
    "A17_operation_log",
    """SELECT * FROM (SELECT CAST(o_orderdate AS VARCHAR) AS timestamp, CAST(o_custkey AS VARCHAR) AS cnpj,
         lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS chave_produto, o_orderpriority AS descricao, 2 AS itens_unificados
       FROM orders WHERE o_custkey = 7 ORDER BY o_orderdate DESC, chave_produto DESC LIMIT 5)""",
)
def a17(t):
    path = _folder(t["orders"], "log")
    rows = t["orders"].select(
        F.col("o_orderdate").cast("string").alias("ts"),
        F.col("o_custkey").cast("string").alias("cnpj"),
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("chave_produto"),
        F.col("o_orderpriority").alias("descricao"),
        F.lit(2).alias("itens_unificados"),
    )
    log = sinks.operation_record(rows, "").withColumn("timestamp", F.lit(""))
    stamped = rows.select(F.col("ts").alias("timestamp"), *[c for c in rows.columns if c != "ts"])
    sinks.append_log(log.unionByName(stamped, allowMissingColumns=True).where(F.col("timestamp") != ""), path)
    spark = t["orders"].sparkSession
    spark.createDataFrame([('{"timestamp": "2099-01-01", "cnpj": ',)], "value string").write.mode("append").text(path)
    last = sinks.read_log(spark, path, "7", 5)
    return last.select("timestamp", "cnpj", "chave_produto", "descricao", "itens_unificados")


@check(
    "A18_registry_upsert",
    """WITH cur AS (SELECT CAST(o_custkey AS VARCHAR) AS cnpj, MIN(o_orderdate) AS added_at FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
            upd AS (SELECT CAST(o_custkey AS VARCHAR) AS cnpj, MIN(o_orderdate) AS a, MAX(o_orderdate) FILTER (WHERE o_totalprice > 250000) AS r
                    FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
       SELECT coalesce(cur.cnpj, upd.cnpj) AS cnpj, strftime(coalesce(cur.added_at, a), '%Y-%m-%d %H:%M:%S') AS added_at,
              strftime(r, '%Y-%m-%d %H:%M:%S') AS last_run_at FROM cur FULL JOIN upd ON cur.cnpj = upd.cnpj""",
)
def a18(t):
    rows = t["orders"].withColumn("cnpj", F.col("o_custkey").cast("string"))
    current = (
        rows.where("o_orderstatus = 'F'")
        .groupBy("cnpj")
        .agg(F.min("o_orderdate").alias("added_at"))
        .withColumn("last_run_at", F.lit(None).cast("timestamp_ntz"))
    )
    updates = rows.where("o_orderstatus = 'O'").select(
        "cnpj", F.col("o_orderdate").alias("now"), (F.col("o_totalprice") > 250000).alias("ran_now")
    )
    return sinks.upsert_registry(current, updates)


@check(
    "A19_flattened_lists",
    """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, concat(p_brand, ' | ', p_type) AS lista,
         CASE WHEN p_size > 25 THEN 'true' ELSE 'false' END AS grande, CASE WHEN p_size > 10 THEN CAST(p_size AS VARCHAR) ELSE '' END AS tamanho
       FROM part""",
)
def a19(t):
    return sinks.as_export(
        t["part"].select(
            "p_partkey",
            F.array("p_brand", F.lit(None).cast("string"), F.lit(""), "p_type").alias("lista"),
            (F.col("p_size") > 25).alias("grande"),
            F.when(F.col("p_size") > 10, F.col("p_size")).alias("tamanho"),
        )
    )


@check(
    "A19_display_cells",
    "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, concat(p_brand, ', ', ', ', p_type) AS lista FROM part",
)
def a19_display(t):
    return sinks.as_display(
        t["part"].select(
            "p_partkey", F.array("p_brand", F.lit(None).cast("string"), F.lit(""), "p_type").alias("lista")
        )
    )


@check(
    "A20_export_datasets",
    f"""SELECT c_custkey, c_name, {dbl("c_acctbal")} FROM customer WHERE c_acctbal > 100.5 AND contains(lower(c_mktsegment), 'build')""",
)
def a20(t):
    conditions = [Condition("c_acctbal", ">", "100,5"), Condition("c_mktsegment", "contém", "BUILD")]
    return sinks.export_dataset(t["customer"], "visible", conditions, ["c_custkey", "c_name", "c_acctbal", "nope"])


@check("A20_export_filtered", f"SELECT c_custkey, c_name, c_nationkey, {dbl('c_acctbal')}, c_mktsegment FROM customer WHERE c_acctbal > 100.5")
def a20_filtered(t):
    return sinks.export_dataset(t["customer"], "filtered", [Condition("c_acctbal", ">", "100,5")], ["c_name"])


@check("A20_export_full", f"SELECT c_custkey, c_name, c_nationkey, {dbl('c_acctbal')}, c_mktsegment FROM customer")
def a20_full(t):
    return sinks.export_dataset(t["customer"], "full", [Condition("c_acctbal", ">", "100,5")], ["c_name"])
