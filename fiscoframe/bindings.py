"""Stand-in fiscal tables over a generic sales schema.

The checks need documents, ledgers and dimensions; these views derive them from
the star-schema test tables.  The SQL is kept to what Spark and DuckDB both run
unchanged, so the same text defines the input on both sides of a comparison.
``{name}`` refers to another view or to a base table.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from fiscoframe.session import sized
from fiscoframe.sources.tables import Tables

REGISTERS = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
)
BASE_TABLES = (*REGISTERS, "documents")


def _key(order_key: str, priority: str) -> str:
    """22-character access key; characters 21-22 are the document model."""
    model = f"CASE substr({priority}, 1, 1) WHEN '5' THEN '65' WHEN '4' THEN '65' WHEN '3' THEN '57' ELSE '55' END"
    return f"concat(lpad(CAST({order_key} AS STRING), 20, '0'), {model})"


def _ddmmyyyy(value: str) -> str:
    return (
        f"concat(lpad(CAST(day({value}) AS STRING), 2, '0'), lpad(CAST(month({value}) AS STRING), 2, '0'), "
        f"CAST(year({value}) AS STRING))"
    )


def _yyyymmdd(value: str) -> str:
    return (
        f"concat(CAST(year({value}) AS STRING), lpad(CAST(month({value}) AS STRING), 2, '0'), "
        f"lpad(CAST(day({value}) AS STRING), 2, '0'))"
    )


def _money(column: str) -> str:
    return f"CAST({column} AS DECIMAL(18,2))"


_LINE_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"
_RATE = "CAST(l_tax AS DECIMAL(4,2))"
_OTHER_PARTY = "CAST(o_orderkey % 1000 AS STRING)"

VIEWS: dict[str, str] = {
    # ---- ledger -------------------------------------------------------------
    "reg_0000": """
        SELECT o_orderkey AS id, '0000' AS reg, CAST(o_custkey AS STRING) AS cnpj,
               CASE o_orderstatus WHEN 'F' THEN '0' WHEN 'O' THEN '1' ELSE '2' END AS cod_fin,
               CAST(date_trunc('month', o_orderdate) AS DATE) AS dt_ini, last_day(CAST(o_orderdate AS DATE)) AS dt_fin,
               CAST(o_orderdate AS DATE) AS data_entrega,
               CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'A' WHEN '2' THEN 'B' WHEN '3' THEN 'C' ELSE 'D' END AS ind_perfil,
               CAST(o_orderkey % 3 AS STRING) AS ind_ativ, concat('efd_', CAST(o_orderkey AS STRING)) AS arquivo_nome
        FROM {orders}""",
    "dm_efd_arquivo_valido": """
        SELECT id AS reg_0000_id, cnpj AS co_cnpj_cpf_declarante, dt_ini AS da_inicio_arquivo,
               dt_fin AS da_final_arquivo, data_entrega AS da_entrega_arquivo, cod_fin AS in_codigo_finalidade
        FROM {reg_0000} WHERE cod_fin <> '2'""",
    "reg_c100": f"""
        SELECT o_orderkey AS id, o_orderkey AS reg_0000_id, 'C100' AS reg,
               CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE {_key("o_orderkey", "o_orderpriority")} END AS chv_nfe,
               CASE o_orderstatus WHEN 'F' THEN '00' WHEN 'O' THEN '02' ELSE '77' END AS cod_sit,
               CASE WHEN o_totalprice > 200000 THEN '0' ELSE '1' END AS ind_oper,
               CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN '0' WHEN '5' THEN '9' ELSE '1' END AS ind_emit,
               CAST(o_custkey AS STRING) AS cod_part, '55' AS cod_mod, substr(o_orderpriority, 1, 1) AS ser,
               o_orderkey AS num_doc, {_ddmmyyyy("o_orderdate")} AS dt_doc,
               CASE WHEN o_orderstatus = 'P' THEN 'N/D' WHEN o_orderpriority = '5-LOW' THEN '99999999'
                    WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE {_ddmmyyyy("o_orderdate")} END AS dt_e_s,
               {_money("o_totalprice")} AS vl_doc, CAST(o_orderkey % 10 AS STRING) AS ind_pgto,
               CAST(o_orderkey % 4 AS STRING) AS ind_frt,
               CAST(NULL AS DECIMAL(18,2)) AS vl_desc, CAST(0 AS DECIMAL(18,2)) AS vl_abat_nt,
               {_money("o_totalprice")} AS vl_merc, CAST(1.5 AS DECIMAL(18,2)) AS vl_frt, CAST(0.5 AS DECIMAL(18,2)) AS vl_seg,
               CAST(NULL AS DECIMAL(18,2)) AS vl_out_da, {_money("o_totalprice")} AS vl_bc_icms,
               CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderpriority = '1-URGENT' THEN NULL
                    WHEN o_orderpriority = '3-MEDIUM' THEN {_money("o_totalprice")} * CAST(0.17 AS DECIMAL(4,2))
                    ELSE {_money("o_totalprice")} * CAST(0.12 AS DECIMAL(4,2)) END AS vl_icms,
               CAST(0 AS DECIMAL(18,2)) AS vl_bc_icms_st, CAST(0 AS DECIMAL(18,2)) AS vl_icms_st,
               CAST(0 AS DECIMAL(18,2)) AS vl_ipi, CAST(0 AS DECIMAL(18,2)) AS vl_pis, CAST(0 AS DECIMAL(18,2)) AS vl_cofins,
               CAST(0 AS DECIMAL(18,2)) AS vl_pis_st, CAST(0 AS DECIMAL(18,2)) AS vl_cofins_st
        FROM {{orders}}""",
    "reg_c170": f"""
        SELECT {_LINE_ID} AS id, l_orderkey AS reg_c100_id, l_orderkey AS reg_0000_id, 'C170' AS reg,
               l_linenumber AS num_item, lpad(CAST(l_partkey AS STRING), 6, '0') AS cod_item,
               CASE WHEN l_returnflag = 'N' THEN NULL ELSE concat('lote ', l_returnflag) END AS descr_compl,
               CAST(l_suppkey AS STRING) AS cfop, concat('N', CAST(l_linenumber AS STRING)) AS cod_nat,
               lpad(CAST(l_linenumber AS STRING), 3, '0') AS cst_icms, {_money("l_quantity")} AS qtd, l_returnflag AS unid,
               {_money("l_extendedprice")} AS vl_item, CAST(0 AS DECIMAL(18,2)) AS vl_desc,
               CASE WHEN l_tax = 0 THEN NULL ELSE {_money("l_extendedprice")} * {_RATE} END AS vl_icms,
               CASE WHEN l_tax = 0 THEN NULL ELSE {_money("l_extendedprice")} END AS vl_bc_icms, {_RATE} AS aliq_icms,
               CASE WHEN l_returnflag = 'R' THEN {_money("l_extendedprice")} END AS vl_bc_icms_st,
               CASE WHEN l_returnflag = 'R' THEN {_money("l_extendedprice")} * {_RATE} END AS vl_icms_st, {_RATE} AS aliq_st,
               CASE l_linestatus WHEN 'O' THEN '0' ELSE '1' END AS ind_mov, '53' AS cst_ipi, '999' AS cod_enq,
               CAST(0 AS DECIMAL(18,2)) AS vl_bc_ipi, CAST(0 AS DECIMAL(18,2)) AS aliq_ipi, CAST(0 AS DECIMAL(18,2)) AS vl_ipi,
               '1.1' AS cod_cta, CAST(0 AS DECIMAL(18,2)) AS vl_abat_nt
        FROM {{lineitem}}""",
    "reg_c176": f"""
        SELECT concat('r', {_LINE_ID}) AS id, l_orderkey AS reg_0000_id, l_orderkey AS reg_c100_id, {_LINE_ID} AS reg_c170_id,
               CAST(l_linenumber AS STRING) AS cod_mot_res, lpad(CAST(l_partkey AS STRING), 22, '9') AS chave_nfe_ult,
               l_linenumber AS num_item_ult_e,
               CASE WHEN l_linestatus = 'O' THEN {_ddmmyyyy("l_shipdate")} ELSE 'SEM DATA' END AS dt_ult_e,
               {_money("l_extendedprice")} AS vl_unit_ult_e,
               CASE WHEN l_discount = 0 THEN NULL ELSE CAST(l_discount AS DECIMAL(18,2)) END AS vl_unit_icms_ult_e,
               CAST(l_tax AS DECIMAL(18,2)) AS vl_unit_res
        FROM {{lineitem}} WHERE l_returnflag = 'R'""",
    "reg_e111": """
        SELECT l_orderkey AS reg_0000_id,
               CASE l_linenumber WHEN 1 THEN 'RO020023' WHEN 2 THEN 'RO020049' WHEN 3 THEN 'RO020022' WHEN 4 THEN 'RO020047'
                    WHEN 5 THEN 'RO020050' WHEN 6 THEN 'RO020048' ELSE 'RO000001' END AS cod_aj_apur,
               concat('ajuste ', l_returnflag) AS descr_compl_aj, CAST(l_quantity AS DECIMAL(18,2)) AS vl_aj_apur
        FROM {lineitem} WHERE l_returnflag = 'A'""",
    "dm_efd_ajustes": """
        SELECT DISTINCT concat(cod_aj_apur, '   ') AS co_cod_aj, concat('Ajuste ', cod_aj_apur) AS no_cod_aj
        FROM {reg_e111} WHERE cod_aj_apur <> 'RO000001'""",
    "reg_0200": """
        SELECT DISTINCT concat_ws('-', l_orderkey, l_partkey) AS id, l_orderkey AS reg_0000_id,
               lpad(CAST(l_partkey AS STRING), 6, '0') AS cod_item, p_name AS descr_item,
               concat('789', lpad(CAST(l_partkey AS STRING), 10, '0')) AS cod_barra, p_brand AS cod_ncm,
               concat(lpad(CAST(p_size AS STRING), 2, '0'), '.001.00') AS cest,
               CASE WHEN p_size > 40 THEN '99' ELSE lpad(CAST(p_size % 12 AS STRING), 2, '0') END AS tipo_item,
               lpad(CAST(p_size AS STRING), 2, '0') AS cod_gen, 'UN' AS unid_inv,
               CASE WHEN p_size > 25 THEN CAST(p_partkey AS STRING) END AS cod_ant_item, CAST(17.5 AS DECIMAL(6,2)) AS aliq_icms
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey WHERE p_type <> 'PROMO'""",
    "reg_0205": """
        SELECT reg_0000_id, id AS reg_0200_id, concat('antigo ', descr_item) AS descr_ant_item, '01012000' AS dt_ini,
               '31122001' AS dt_fim, cod_ant_item FROM {reg_0200} WHERE cod_ant_item IS NOT NULL""",
    "reg_0220": """
        SELECT reg_0000_id, id AS reg_0200_id, 'CX' AS unid_conv, CAST(12 AS DECIMAL(10,2)) AS fat_conv
        FROM {reg_0200} WHERE tipo_item IN ('00', '99')
        UNION ALL SELECT reg_0000_id, id, 'FD', CAST(6 AS DECIMAL(10,2)) FROM {reg_0200} WHERE tipo_item = '99'""",
    "reg_0400": """
        SELECT DISTINCT l_orderkey AS reg_0000_id, concat('N', CAST(l_linenumber AS STRING)) AS cod_nat,
               concat('Natureza ', CAST(l_linenumber AS STRING)) AS descr_nat FROM {lineitem} WHERE l_linenumber <= 3""",
    "reg_0005": """
        SELECT id AS reg_0005_id, id AS reg_0000_id, concat('Fantasia ', cnpj) AS fantasia, '76800000' AS cep FROM {reg_0000}""",
    "reg_0190": """
        SELECT DISTINCT l_orderkey AS reg_0000_id, l_returnflag AS unid, concat('Unidade ', l_returnflag) AS descr
        FROM {lineitem}""",
    "reg_h005": f"""
        SELECT o_orderkey AS id, o_orderkey AS reg_0000_id, {_ddmmyyyy("o_orderdate")} AS dt_inv,
               CAST(o_totalprice AS STRING) AS vl_inv, lpad(CAST(o_orderkey % 8 AS STRING), 2, '0') AS mot_inv
        FROM {{orders}} WHERE o_orderstatus = 'F'""",
    "reg_h010": f"""
        SELECT {_LINE_ID} AS id, l_orderkey AS reg_h005_id, l_orderkey AS reg_0000_id,
               lpad(CAST(l_partkey AS STRING), 6, '0') AS cod_item, l_returnflag AS unid, CAST(l_quantity AS STRING) AS qtd,
               CAST(NULL AS STRING) AS vl_unit, CAST(l_extendedprice AS STRING) AS vl_item,
               CASE l_linestatus WHEN 'O' THEN '0' ELSE '1' END AS ind_prop,
               CASE l_linestatus WHEN 'F' THEN CAST(l_suppkey AS STRING) END AS cod_part, '' AS txt_compl
        FROM {{lineitem}}""",
    "reg_h020": f"""
        SELECT {_LINE_ID} AS reg_h010_id, l_orderkey AS reg_0000_id, '060' AS cst_icms,
               CAST(l_extendedprice AS STRING) AS bc_icms, CAST(l_tax AS STRING) AS vl_icms
        FROM {{lineitem}} WHERE l_tax > 0.04""",
    # ---- invoices -----------------------------------------------------------
    "invoice_lines": f"""
        SELECT {_key("o_orderkey", "o_orderpriority")} AS chave_acesso, l_linenumber AS seq_nitem, l_linenumber AS prod_nitem,
               CAST(o_custkey AS STRING) AS co_emitente, {_OTHER_PARTY} AS co_destinatario,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE 1 END AS co_tp_nf,
               CASE o_orderstatus WHEN 'F' THEN '100' WHEN 'O' THEN '150' ELSE '101' END AS infprot_cstat,
               substr(o_orderpriority, 1, 1) AS ide_serie, o_orderkey AS nnf, CAST(o_orderdate AS DATE) AS dhemi,
               CASE WHEN l_returnflag = 'A' THEN NULL ELSE CAST(l_shipdate AS DATE) END AS dhsaient,
               {_money("o_totalprice")} AS tot_vnf, {_money("o_totalprice")} * CAST(0.17 AS DECIMAL(4,2)) AS tot_vicms,
               CASE WHEN o_custkey % 3 = 0 THEN 'RO' ELSE 'SP' END AS co_uf_emit, 'RO' AS co_uf_dest,
               concat('Emitente ', CAST(o_custkey AS STRING)) AS xnome_emit,
               CAST(l_partkey AS STRING) AS prod_cprod, concat(' ', replace(p_name, 'a', 'ã')) AS prod_xprod, p_brand AS prod_ncm,
               p_type AS prod_cest, CASE WHEN l_returnflag = 'R' THEN '' ELSE concat('789', CAST(p_size AS STRING)) END AS prod_ceantrib,
               concat('SEM', CAST(p_size AS STRING)) AS prod_cean, l_returnflag AS prod_ucom, CAST(l_suppkey AS STRING) AS co_cfop,
               {_money("l_quantity")} AS prod_qcom, {_money("l_extendedprice")} AS prod_vprod,
               CAST(l_discount AS DECIMAL(18,2)) AS prod_vfrete, CAST(NULL AS DECIMAL(18,2)) AS prod_vseg,
               CAST(l_tax AS DECIMAL(18,2)) AS prod_voutro, CAST(l_discount AS DECIMAL(18,2)) AS prod_vdesc,
               {_money("l_extendedprice")} AS icms_vbcst, {_money("l_extendedprice")} * {_RATE} AS icms_vicmsst,
               o_orderpriority AS prioridade
        FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey JOIN {{part}} ON l_partkey = p_partkey""",
    "fato_nfe_detalhe": "SELECT * FROM {invoice_lines} WHERE prioridade <> '5-LOW'",
    "fato_nfce_detalhe": "SELECT * FROM {invoice_lines} WHERE prioridade = '5-LOW'",
    "dm_eventos": f"""
        SELECT {_key("o_orderkey", "o_orderpriority")} AS chave_acesso, event_id AS nsu, ts AS evento_dhevento,
               substr(event_type, 1, 3) AS evento_tpevento, event_type AS evento_descevento
        FROM {{events}} JOIN {{orders}} ON user_id = o_orderkey""",
    "pendencias": """
        SELECT o_orderkey AS id, CAST(o_custkey AS STRING) AS cpf_cnpj, CAST(substr(o_orderpriority, 1, 1) AS INT) AS malhas_id,
               year(o_orderdate) AS referencia_malhas_id,
               concat(CAST(year(o_orderdate) AS STRING), lpad(CAST(month(o_orderdate) AS STRING), 2, '0')) AS periodo,
               CAST(o_orderkey % 14 AS INT) AS status,
               CASE WHEN o_totalprice > 150000 THEN CAST(o_orderdate AS DATE) END AS data_ciencia
        FROM {orders} WHERE o_orderstatus = 'O'""",
    "malhas": "SELECT r_regionkey + 1 AS id, concat('Malha ', r_name) AS titulo FROM {region} WHERE r_regionkey < 4",
    "vw_fisconforme_chave_nota": f"""
        SELECT CAST(o_custkey AS STRING) AS cpf_cnpj, {_key("o_orderkey", "o_orderpriority")} AS chave_acesso,
               CAST(substr(o_orderpriority, 1, 1) AS INT) AS malhas_id, year(o_orderdate) AS referencia_malhas_id FROM {{orders}}""",
    "fato_det_notificacao": """
        SELECT l_orderkey AS id_fisconforme, l_partkey * 1000 + l_suppkey AS id_notificacao,
               CASE l_returnflag WHEN 'N' THEN 'ENVIADA' ELSE 'CIENTE' END AS tp_status,
               CASE WHEN l_returnflag <> 'N' THEN CAST(l_shipdate AS DATE) END AS dt_envio,
               CASE WHEN l_linestatus = 'O' THEN CAST(l_shipdate AS DATE) END AS dt_ciencia,
               CAST(o_custkey AS STRING) AS co_cnpj_notif, CAST(l_suppkey AS STRING) AS co_cpf_cnpj_ciencia,
               concat('Pessoa ', CAST(l_suppkey AS STRING)) AS no_pessoa_ciencia
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "fato_nfe_nfce_sumarizada": f"""
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS da_referencia, CAST(o_custkey AS STRING) AS co_emitente,
               CAST(l_suppkey AS STRING) AS co_destinatario, CASE WHEN o_orderstatus = 'P' THEN 'SP' ELSE 'RO' END AS co_uf_emit,
               CASE WHEN o_orderpriority = '1-URGENT' THEN '0' ELSE '1' END AS co_tp_nf, CAST(l_suppkey AS STRING) AS co_cfop,
               {_money("l_extendedprice")} * {_RATE} AS icms_vicms,
               CASE WHEN l_returnflag = 'R' THEN NULL ELSE {_money("l_extendedprice")} * {_RATE} END AS icms_vicmsst,
               {_money("l_extendedprice")} AS prod_vprod, CAST(l_tax AS DECIMAL(18,2)) AS prod_vfrete,
               CAST(0 AS DECIMAL(18,2)) AS prod_vseg, CAST(0 AS DECIMAL(18,2)) AS prod_voutro,
               CAST(l_discount AS DECIMAL(18,2)) AS prod_vdesc
        FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey""",
    "dm_contribuinte": """
        SELECT CAST(c_custkey AS STRING) AS co_cnpj_cpf, c_name AS no_razao_social, concat('Loja ', c_mktsegment) AS no_fantasia,
               CASE c_mktsegment WHEN 'BUILDING' THEN '001' WHEN 'MACHINERY' THEN '001' ELSE '002' END AS co_regime_pagto
        FROM {customer}""",
    "fato_cte_detalhe": """
        SELECT concat('CTE', CAST(o_orderkey AS STRING)) AS chave_acesso, o_orderkey AS nsu, CAST(o_orderkey % 6 AS INT) AS co_tomador3,
               CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE concat(CAST(o_custkey AS STRING), '-') END AS emit_co_cnpj,
               CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE CAST(o_orderkey % 1000 AS STRING) END AS rem_cnpj_cpf,
               CASE WHEN o_orderpriority = '3-MEDIUM' THEN CAST(o_custkey AS STRING) ELSE CAST(o_orderkey % 700 AS STRING) END AS dest_cnpj_cpf,
               CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS STRING) WHEN o_orderstatus = 'O' THEN concat(' ', CAST(o_orderkey % 333 AS STRING)) END
                   AS co_tomador4_cnpj_cpf,
               CAST(o_totalprice AS DECIMAL(18,2)) AS prest_vtprest
        FROM {orders}""",
    "nfe_xml": """
        SELECT chave_acesso, concat('<?xml version="1.0"?><nfeProc xmlns="http://www.portalfiscal.inf.br/nfe"><NFe><infNFe>',
               array_join(collect_list(det), ''), '</infNFe></NFe></nfeProc>') AS xml
        FROM (SELECT chave_acesso, concat('<det nItem="', seq_nitem, '"><prod><cProd>', prod_cprod, '</cProd></prod><imposto><ICMS>',
                     CASE WHEN prod_ucom = 'A' THEN '<ICMS00><vBC>1</vBC></ICMS00>' ELSE
                       concat('<ICMS10><vBCST>', icms_vbcst, '</vBCST><vICMSST>', icms_vicmsst, '</vICMSST></ICMS10>') END,
                     '</ICMS></imposto></det>') AS det FROM {fato_nfe_detalhe})
        GROUP BY chave_acesso""",
    # ---- registration and dimensions ----------------------------------------
    "dm_pessoa": """
        SELECT CAST(c_custkey AS STRING) AS co_cnpj_cpf, concat('IE', CAST(c_custkey AS STRING)) AS co_cad_icms, c_name AS no_razao_social,
               CASE WHEN c_acctbal > 0 THEN concat('Fantasia ', c_mktsegment) END AS no_fantasia,
               concat('Rua ', CAST(c_custkey AS STRING)) AS desc_endereco,
               'Centro' AS bairro, c_nationkey AS co_municipio,
               CASE c_mktsegment WHEN 'BUILDING' THEN '001' ELSE '002' END AS co_regime_pagto,
               CASE WHEN c_acctbal > 5000 THEN '001' WHEN c_acctbal > 0 THEN '002' ELSE '009' END AS in_situacao,
               DATE '1990-01-31' + CAST(c_custkey % 3000 AS INT) AS da_inicio_atividade
        FROM {customer}""",
    "dm_localidade": """
        SELECT n_nationkey AS co_municipio, n_name AS no_municipio, substr(r_name, 1, 2) AS co_uf
        FROM {nation} JOIN {region} ON n_regionkey = r_regionkey WHERE n_nationkey < 20""",
    "dm_regime_pagto_descricao": """
        SELECT lpad(CAST(r_regionkey + 1 AS STRING), 3, '0') AS co_regime_pagamento, concat('Regime ', r_name) AS no_regime_pagamento
        FROM {region}""",
    "dm_situacao_contribuinte": """
        SELECT lpad(CAST(r_regionkey + 1 AS STRING), 3, '0') AS co_situacao_contribuinte,
               concat('Situacao ', r_name) AS no_situacao_contribuinte FROM {region}""",
    "sitafe_historico_gr_situacao": """
        SELECT o_orderkey AS tuk, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN '030' WHEN '2' THEN '150' ELSE '001' END
               AS it_co_situacao_contribuinte FROM {orders}""",
    "sitafe_historico_situacao": f"""
        SELECT o_orderkey AS tuk, {_yyyymmdd("o_orderdate")} AS it_da_transacao,
               concat('IE', CAST(o_custkey AS STRING)) AS it_nu_inscricao_estadual,
               CASE o_orderstatus WHEN 'F' THEN 'INTERNET' WHEN 'O' THEN 'FISCAL' ELSE 'P30015AC   ' END AS it_co_usuario
        FROM {{orders}}""",
    "dm_cfop": """
        SELECT CAST(s_suppkey AS STRING) AS co_cfop,
               CASE s_nationkey WHEN 1 THEN 'Transferência' WHEN 2 THEN 'RETORNO' WHEN 3 THEN 'anulação' ELSE concat('Venda ', CAST(s_suppkey AS STRING)) END
                   AS descricao_cfop,
               CASE WHEN s_acctbal > 0 THEN 'X' END AS in_vaf, CASE WHEN s_nationkey = 5 THEN 'X' END AS dev_venda,
               CASE WHEN s_nationkey = 6 THEN 'X' END AS dev_compra, CASE WHEN s_nationkey < 15 THEN 'X' END AS operacao_mercantil,
               CASE WHEN s_nationkey < 20 THEN 'X' ELSE 'N' END AS sisaudit_estoque
        FROM {supplier}""",
    "dm_cst": """
        SELECT DISTINCT lpad(CAST(l_linenumber AS STRING), 3, '0') AS co_cst, concat('CST ', CAST(l_linenumber AS STRING)) AS desc_cst
        FROM {lineitem} WHERE l_linenumber > 1""",
    "dm_cest_segmento": """
        SELECT lpad(CAST(n_nationkey AS STRING), 2, '0') AS cod_segmento, concat('Segmento ', n_name) AS no_segmento FROM {nation}""",
    # ---- border tax ---------------------------------------------------------
    "sitafe_nota_fiscal": f"""
        SELECT {_key("o_orderkey", "o_orderpriority")} AS it_nu_identificao_nf_e, o_orderkey AS it_nu_identificacao_nf,
               {_OTHER_PARTY} AS it_nucnpj_cpf_destino_nf FROM {{orders}}""",
    "sitafe_nf_lancamento": f"""
        SELECT o_orderkey AS it_nu_identificacao_nf, {_OTHER_PARTY} AS it_nu_cnpj_cpf_destino_nf,
               {_yyyymmdd("o_orderdate")} AS it_da_entrada, substr(o_orderpriority, 1, 1) AS it_co_comando,
               o_orderkey + 7 AS it_nu_guia_lancamento, o_orderkey + 9 AS it_nu_identificacao_ndf
        FROM {{orders}} WHERE o_orderpriority <> '4-NOT SPECIFIED'""",
    "sitafe_lancamento": """
        SELECT o_orderkey + 7 AS it_nu_guia_lancamento, CASE WHEN o_totalprice > 100000 THEN '1145' END AS it_co_receita,
               CAST(o_totalprice AS DECIMAL(18,2)) AS it_va_principal_original,
               CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.5 AS DECIMAL(2,1)) AS it_va_total_pgto_efetuado,
               CASE WHEN o_orderkey % 15 = 0 THEN NULL ELSE lpad(CAST(o_orderkey % 15 AS STRING), 2, '0') END AS it_co_situacao_lancamento
        FROM {orders}""",
    "sitafe_nfe_item": f"""
        SELECT chave_acesso AS it_nu_chave_acesso, CAST(seq_nitem AS STRING) AS it_nu_item, prod_xprod AS it_no_produto,
               co_cfop AS it_co_cfop, prod_ncm AS it_co_ncm, prod_ucom AS it_un_comercial, prod_qcom AS it_qt_comercial,
               prod_vprod AS it_va_unitario_com, prod_vprod AS it_va_produto, prod_vfrete AS it_va_frete, prod_vdesc AS it_va_desconto,
               prod_voutro AS it_va_outro, CAST(0 AS DECIMAL(18,2)) AS it_va_seguro, icms_vbcst AS it_va_bc, CAST(12 AS DECIMAL(5,2)) AS it_pc_icms,
               icms_vicmsst AS it_va_icms, icms_vbcst AS it_va_bc_st, icms_vicmsst AS it_va_icms_st, prod_ncm AS it_co_sefin
        FROM {{fato_nfe_detalhe}}""",
    "sitafe_lancamento_item": """
        SELECT DISTINCT l_orderkey + 9 AS it_nu_identificacao_ndf, p_brand AS it_co_produto, CAST(p_size AS DECIMAL(18,2)) AS it_vl_merc_item,
               CAST(p_size AS DECIMAL(18,2)) AS it_vl_merc_bc_item, CAST(17.5 AS DECIMAL(5,2)) AS it_aliq_item,
               CAST(1 AS DECIMAL(18,2)) AS it_vl_tot_debito_item, CAST(0 AS DECIMAL(18,2)) AS it_vl_credito_rateio,
               CAST(p_size AS DECIMAL(18,2)) AS it_vl_icms_recolher
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey WHERE l_returnflag <> 'N'""",
    "sitafe_mercadoria": """
        SELECT DISTINCT p_brand AS it_co_sefin, CAST(17.5 AS DECIMAL(5,2)) AS it_pc_aliquota_interna, CAST(12 AS DECIMAL(5,2)) AS it_pc_aliquota_origem,
               'N' AS it_convenio, CAST(40 AS DECIMAL(5,2)) AS it_pc_agregacao_interna, 'N' AS it_in_pgto_saida, 'N' AS it_boletim_pauta,
               'N' AS it_in_isento_icms, 'N' AS it_passe_fiscal, 'N' AS it_in_combustivel, 'S' AS it_in_produto_st, 'S' AS it_in_cest_st,
               CAST(17.5 AS DECIMAL(5,2)) AS it_pc_interna FROM {part}""",
    "sitafe_nfe_calculo_item": """
        SELECT chave_acesso AS it_nu_chave_acesso, seq_nitem AS it_nu_item, prod_ncm AS it_co_sefin, prod_ucom AS it_co_rotina_calculo,
               icms_vicmsst AS it_vl_icms FROM {fato_nfe_detalhe} WHERE prod_ucom <> 'N'""",
    # ---- classification references ------------------------------------------
    "sitafe_cest_ncm": """
        SELECT p_brand AS it_nu_ncm, concat(p_type, '.') AS it_nu_cest, concat('A', CAST(MIN(p_partkey) AS STRING)) AS it_co_sefin
        FROM {part} WHERE p_size < 10 GROUP BY p_brand, p_type""",
    "sitafe_cest": """
        SELECT concat(' ', p_type) AS cest, concat('B', CAST(MIN(p_partkey) AS STRING)) AS `co-sefin`
        FROM {part} WHERE p_type LIKE '%O%' GROUP BY p_type""",
    "sitafe_ncm": """
        SELECT p_brand AS ncm, concat('C', CAST(MIN(p_partkey) AS STRING)) AS `co-sefin`
        FROM {part} WHERE p_retailprice > 950 GROUP BY p_brand""",
    "sitafe_produto_sefin": """
        SELECT p_brand AS it_co_sefin, concat('Produto ', p_brand) AS it_no_produto FROM {part} WHERE p_size < 25 GROUP BY p_brand""",
    "sitafe_produto_sefin_aux": """
        SELECT p_brand AS it_co_sefin, '19950101' AS it_da_inicio, '19971231' AS it_da_final, 17.5 AS it_pc_interna, 'S' AS it_in_st,
               40.0 AS it_pc_mva, 'S' AS it_in_mva_ajustado FROM {part} GROUP BY p_brand
        UNION ALL
        SELECT p_brand, '19980101', ' ', 18.0, 'S', 60.0, 'N' FROM {part} GROUP BY p_brand""",
    # ---- extracted tables read by the product jobs ---------------------------
    "nfe": "SELECT * FROM {fato_nfe_detalhe}",
    "nfce": "SELECT * FROM {fato_nfce_detalhe}",
    "c170": """
        SELECT CAST(o_custkey AS STRING) AS cnpj, concat('00', CAST(l_partkey AS STRING)) AS cod_item,
               CASE WHEN l_returnflag = 'A' THEN upper(p_name) ELSE replace(p_name, 'e', 'é') END AS descr_item, CAST(NULL AS STRING) AS descr_compl,
               CASE WHEN p_size > 25 THEN '00' ELSE '04' END AS tipo_item, p_brand AS cod_ncm, p_type AS cest,
               CAST(NULL AS STRING) AS cod_barra, l_returnflag AS unid, CAST(l_suppkey AS STRING) AS cfop,
               CASE l_linestatus WHEN 'O' THEN '0' ELSE '1' END AS ind_oper, CAST(l_quantity AS DECIMAL(18,2)) AS qtd,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS vl_item
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey""",
    "bloco_h": """
        SELECT DISTINCT CAST(o_custkey AS STRING) AS cnpj, concat('00', CAST(l_partkey AS STRING)) AS codigo_produto,
               upper(p_name) AS descricao_produto, '00' AS tipo_item, p_brand AS cod_ncm, p_type AS cest, CAST(NULL AS STRING) AS cod_barra,
               'UN' AS unidade_medida
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey WHERE o_orderstatus = 'P'""",
}

#: The same rows for Spark: distinct keys first, moved once to the place where registers of a file are joined, and not
#: the wide rows that are made of them.  ``VIEWS`` stays the definition; a test compares both.
MOVED_ONCE: dict[str, str] = {
    "reg_0200": """
        SELECT concat_ws('-', l_orderkey, l_partkey) AS id, l_orderkey AS reg_0000_id,
               lpad(CAST(l_partkey AS STRING), 6, '0') AS cod_item, descr_item,
               concat('789', lpad(CAST(l_partkey AS STRING), 10, '0')) AS cod_barra, cod_ncm, cest, tipo_item, cod_gen,
               'UN' AS unid_inv, cod_ant_item, CAST(17.5 AS DECIMAL(6,2)) AS aliq_icms
        FROM (SELECT DISTINCT l_orderkey, l_partkey FROM (SELECT l_orderkey, l_partkey FROM {lineitem} DISTRIBUTE BY l_orderkey))
        JOIN (SELECT DISTINCT p_partkey, p_name AS descr_item, p_brand AS cod_ncm,
                     concat(lpad(CAST(p_size AS STRING), 2, '0'), '.001.00') AS cest,
                     CASE WHEN p_size > 40 THEN '99' ELSE lpad(CAST(p_size % 12 AS STRING), 2, '0') END AS tipo_item,
                     lpad(CAST(p_size AS STRING), 2, '0') AS cod_gen, CASE WHEN p_size > 25 THEN CAST(p_partkey AS STRING) END AS cod_ant_item
              FROM {part} WHERE p_type <> 'PROMO') ON l_partkey = p_partkey""",
    "reg_0400": """
        SELECT l_orderkey AS reg_0000_id, concat('N', CAST(l_linenumber AS STRING)) AS cod_nat,
               concat('Natureza ', CAST(l_linenumber AS STRING)) AS descr_nat
        FROM (SELECT DISTINCT l_orderkey, l_linenumber
              FROM (SELECT l_orderkey, l_linenumber FROM {lineitem} WHERE l_linenumber <= 3 DISTRIBUTE BY l_orderkey))""",
}

_NAME = re.compile(r"\{([a-z]\w*)\}")


def needed_views(sql: str) -> list[str]:
    """Views a text refers to, directly or not, in the order they must be defined."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in _NAME.findall(text):
            if name in VIEWS and name not in ordered:
                visit(VIEWS[name])
                ordered.append(name)

    visit(sql)
    return ordered


def standalone_sql(sql: str) -> str:
    """The text with the views it needs as leading ``WITH`` clauses."""
    ctes = [f"{name} AS ({VIEWS[name]})" for name in needed_views(sql)]
    text = (f"WITH {', '.join(ctes)} SELECT * FROM ({sql})" if ctes else sql).replace("`", '"')
    return _NAME.sub(lambda m: m.group(1), text)


_OPEN: dict[tuple[str, str], Mapping[str, DataFrame]] = {}


def bound_tables(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """The views of a folder; their (lazy) definitions are built once per application, shuffles sized for each use."""
    sized(spark, *[f"{sf_dir}/{name}.parquet" for name in REGISTERS])
    key = (spark.sparkContext.applicationId + str(id(spark)), sf_dir)
    if key not in _OPEN:
        _OPEN[key] = _bind(spark, sf_dir)
    return _OPEN[key]


def _bind(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """Base tables and views as DataFrames, opened on first use."""
    openers = {
        name: (lambda name=name: spark.read.parquet(f"{sf_dir}/{name}.parquet")) for name in BASE_TABLES
    }
    tables: dict[str, Tables] = {}

    def open_view(name: str) -> DataFrame:
        sql = MOVED_ONCE.get(name, VIEWS[name])
        inputs = {dep: tables["all"][dep] for dep in set(_NAME.findall(sql))}
        return spark.sql(sql, **inputs)

    for name in VIEWS:
        openers[name] = lambda name=name: open_view(name)
    tables["all"] = Tables(openers)
    return tables["all"]
