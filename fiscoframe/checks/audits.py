"""The audit query catalogue over all taxpayers (Q)."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscoframe.checks import check, dbl, txt
from fiscoframe.functions import labels as lb
from fiscoframe.plans.border import GOODS_ATTRIBUTES
from fiscoframe.operators.flags import RULES, Rule, with_flags
from fiscoframe.plans.catalogue import CATALOGUE, extract
from fiscoframe.plans.parameters import Params
from fiscoframe.session import remove_at_end, work_folder
from fiscoframe.sources.sinks import read_table, table_writer

CUT_OFF, TODAY = "2000-06-30", "2001-12-31"
PARAMS = Params(cut_off=CUT_OFF, start="1996-01-01", end="1999-12-31", today=TODAY)


def _files(where: str = "") -> str:
    return f"""(SELECT * FROM (SELECT id AS reg_0000_id, cnpj, cod_fin AS cod_fin_efd, dt_ini, data_entrega,
                row_number() OVER (PARTITION BY cnpj, dt_ini ORDER BY data_entrega DESC, id DESC) AS rn FROM {{reg_0000}}
                WHERE data_entrega <= DATE '{CUT_OFF}' {where}) WHERE rn = 1)"""


FILES = _files()
FILES_BY_PERIOD = _files("AND dt_ini BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'")
DECLARED = f"""(SELECT * FROM (SELECT reg_0000_id, co_cnpj_cpf_declarante AS cnpj, in_codigo_finalidade AS cod_fin_efd, da_inicio_arquivo AS dt_ini,
                da_entrega_arquivo AS data_entrega, row_number() OVER (PARTITION BY co_cnpj_cpf_declarante, da_inicio_arquivo
                ORDER BY da_entrega_arquivo DESC, reg_0000_id DESC) AS rn FROM {{dm_efd_arquivo_valido}}
                WHERE da_entrega_arquivo <= DATE '{CUT_OFF}') WHERE rn = 1)"""


def _date(column: str, name: str) -> str:
    return (
        f"CAST(CASE WHEN regexp_full_match({column}, '[0-9]{{8}}') THEN CAST(TRY_STRPTIME({column}, '%d%m%Y') AS DATE) END AS VARCHAR) AS {name}"
    )


#: SQL of each catalogue query, for rows that take them all.
AUDITS: dict[str, str] = {}


def _audit(name: str, query: str, sql: str, params: Params = PARAMS):
    AUDITS[query] = sql

    @check(name, sql)
    def build(t):
        return CATALOGUE[query].run(t, params)

    return build


_PENDENCY = lb.decode_sql("pen.status", lb.PENDENCY_STATUS, "CAST(pen.status AS VARCHAR)")
_CONTEXT = f"""pen.id AS id_pendencia, n.id_notificacao, f.malhas_id, m.titulo AS titulo_malha, pen.periodo, {_PENDENCY} AS status_pendencia,
    n.tp_status AS status_notificacao, CAST(n.dt_envio AS VARCHAR) AS data_envio_notificacao,
    CAST(coalesce(n.dt_ciencia, pen.data_ciencia) AS VARCHAR) AS data_ciencia_consolidada, n.co_cpf_cnpj_ciencia AS cnpj_cpf_assinante,
    n.no_pessoa_ciencia AS nome_assinante"""
_LEDGER_DOCS = """(SELECT c.*, r.cnpj FROM {reg_c100} c JOIN {reg_0000} r ON r.id = c.reg_0000_id
    WHERE c.reg_0000_id IN (SELECT reg_0000_id FROM {dm_efd_arquivo_valido}))"""

_audit(
    "Q01_omitted_documents",
    "omissao_saidas",
    f"""SELECT d.co_emitente AS cnpj, {_CONTEXT}, {lb.decode_sql("substr(d.chave_acesso, 21, 2)", lb.OMITTED_MODEL)} AS operacao, d.chave_acesso, d.ide_serie AS serie,
          d.nnf, {dbl("d.tot_vnf").replace("AS tot_vnf", "AS valor_nota")}, {dbl("d.tot_vicms").replace("AS tot_vicms", "AS valor_icms")},
          CAST(d.dhemi AS VARCHAR) AS data_emissao, d.infprot_cstat AS status_nfe, coalesce(e.descricao, 'SEM EVENTO') AS ultimo_evento
        FROM {{fato_nfe_detalhe}} d
        LEFT JOIN {{vw_fisconforme_chave_nota}} f ON f.cpf_cnpj = d.co_emitente AND f.chave_acesso = d.chave_acesso
        LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY cpf_cnpj, malhas_id, referencia_malhas_id ORDER BY id DESC) AS rn FROM {{pendencias}}) pen
          ON pen.rn = 1 AND pen.cpf_cnpj = d.co_emitente AND pen.malhas_id = f.malhas_id AND pen.referencia_malhas_id = f.referencia_malhas_id
        LEFT JOIN {{malhas}} m ON m.id = f.malhas_id
        LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY co_cnpj_notif, id_fisconforme ORDER BY coalesce(dt_envio, dt_ciencia) DESC NULLS FIRST, id_notificacao DESC) AS rn
                   FROM {{fato_det_notificacao}}) n ON n.rn = 1 AND n.id_fisconforme = pen.id AND n.co_cnpj_notif = d.co_emitente
        LEFT JOIN (SELECT chave_acesso, concat(evento_descevento, ' (', strftime(evento_dhevento, '%d/%m/%y %H:%M'), ')') AS descricao,
                     row_number() OVER (PARTITION BY chave_acesso ORDER BY nsu DESC, evento_dhevento DESC) AS rn FROM {{dm_eventos}}) e ON e.rn = 1 AND e.chave_acesso = d.chave_acesso
        WHERE d.co_tp_nf = 1 AND d.seq_nitem = 1 AND d.infprot_cstat IN ('100', '150') AND substr(d.chave_acesso, 21, 2) IN ('55', '65')
          AND NOT EXISTS (SELECT 1 FROM {_LEDGER_DOCS} l WHERE l.chv_nfe = d.chave_acesso AND l.cnpj = d.co_emitente)""",
)

_audit(
    "Q02_ledger_adjustments",
    "e111",
    f"""SELECT a.cnpj, strftime(a.dt_ini, '%Y/%m') AS periodo_efd, e.cod_aj_apur AS codigo_ajuste, n.no_cod_aj AS descricao_codigo_ajuste, e.descr_compl_aj AS descr_compl,
          CAST(e.vl_aj_apur AS DOUBLE) AS valor_ajuste, CAST(a.data_entrega AS VARCHAR) AS data_entrega_efd_periodo, a.cod_fin_efd
        FROM {FILES} a JOIN {{reg_e111}} e ON e.reg_0000_id = a.reg_0000_id LEFT JOIN {{dm_efd_ajustes}} n ON rtrim(n.co_cod_aj) = e.cod_aj_apur""",
)

_audit(
    "Q03_audit_pendencies",
    "fisconforme",
    f"""SELECT cpf_cnpj AS cnpj, id_pendencia, id_notificacao, malhas_id, titulo AS titulo_malha, periodo, status_pendencia, status_notificacao,
          CAST(ciencia AS VARCHAR) AS data_ciencia_consolidada FROM
        (SELECT pen.cpf_cnpj, pen.id AS id_pendencia, n.id_notificacao, pen.malhas_id, m.titulo, pen.periodo, {_PENDENCY} AS status_pendencia, n.tp_status AS status_notificacao,
           coalesce(n.dt_ciencia, pen.data_ciencia) AS ciencia,
           row_number() OVER (PARTITION BY pen.id ORDER BY coalesce(n.dt_ciencia, pen.data_ciencia) DESC NULLS LAST, n.id_notificacao DESC NULLS LAST) AS rn
         FROM {{pendencias}} pen LEFT JOIN {{malhas}} m ON m.id = pen.malhas_id LEFT JOIN {{fato_det_notificacao}} n ON n.id_fisconforme = pen.id) WHERE rn = 1""",
)


def _detail_sql(table: str) -> str:
    shown = (
        "chave_acesso, seq_nitem, prod_nitem, co_tp_nf, infprot_cstat, ide_serie, nnf, co_uf_emit, co_uf_dest, xnome_emit, prod_cprod, prod_xprod, prod_ncm, prod_cest, "
        "prod_ceantrib, prod_cean, prod_ucom, co_cfop, prioridade, "
        + txt("dhemi", "dhsaient")
        + ", "
        + dbl("tot_vnf", "tot_vicms", "prod_qcom", "prod_vprod", "prod_vfrete", "prod_vseg", "prod_voutro", "prod_vdesc", "icms_vbcst", "icms_vicmsst")
    )
    side = "SELECT *, {} AS cnpj_filtro FROM {{" + table + "}}"
    return f"""SELECT CASE WHEN (co_emitente = cnpj_filtro) = (co_tp_nf = 1) THEN '1 - SAIDA' ELSE '0 - ENTRADA' END AS tipo_operacao,
        co_destinatario, co_emitente, cnpj_filtro, {shown} FROM ({side.format("co_emitente")} UNION ALL {side.format("co_destinatario")} WHERE co_destinatario <> co_emitente)"""


_audit("Q04_retail_invoice_detail", "nfce", _detail_sql("fato_nfce_detalhe"))
_audit("Q05_invoice_detail", "nfe", _detail_sql("fato_nfe_detalhe"))

_audit(
    "Q06_invoice_events",
    "nfe_evento",
    """SELECT DISTINCT p.cnpj, e.chave_acesso, e.nsu AS nsu_evento, strftime(e.evento_dhevento, '%Y-%m-%d %H:%M:%S') AS evento_dhevento, e.evento_tpevento, e.evento_descevento
       FROM {dm_eventos} e JOIN (SELECT chave_acesso, co_emitente AS cnpj FROM {fato_nfe_detalhe} WHERE seq_nitem = 1
         UNION SELECT chave_acesso, co_destinatario FROM {fato_nfe_detalhe} WHERE seq_nitem = 1) p ON p.chave_acesso = e.chave_acesso""",
)

_audit(
    "Q07_xml_tax_values",
    "nfe_dados_st",
    """SELECT p.cnpj, d.chave_acesso, d.seq_nitem AS prod_nitem, d.prod_cprod, CASE WHEN prod_ucom = 'A' THEN 0 ELSE CAST(icms_vbcst AS DOUBLE) END AS icms_vbcst,
         CASE WHEN prod_ucom = 'A' THEN 0 ELSE CAST(icms_vicmsst AS DOUBLE) END AS icms_vicmsst, 0.0::DOUBLE AS icms_vicmssubstituto, 0.0::DOUBLE AS icms_vicmsstret,
         0.0::DOUBLE AS icms_vbcfcpst, 0.0::DOUBLE AS icms_pfcpst, 0.0::DOUBLE AS icms_vfcpst
       FROM {fato_nfe_detalhe} d JOIN (SELECT chave_acesso, co_emitente AS cnpj FROM {fato_nfe_detalhe} UNION SELECT chave_acesso, co_destinatario FROM {fato_nfe_detalhe}) p
         ON p.chave_acesso = d.chave_acesso WHERE d.infprot_cstat IN ('100', '150')""",
)

_audit(
    "Q08_sales_to_listed_buyers",
    "verif_cnpjs",
    """SELECT CAST(v.da_referencia AS VARCHAR) AS da_referencia, v.co_emitente, c.no_razao_social, c.no_fantasia, v.co_destinatario, p.no_razao_social AS no_razao_social_destinatario,
         CAST(SUM(icms_vicms + icms_vicmsst) AS DOUBLE) AS icms, CAST(SUM(prod_vprod + prod_vfrete + prod_vseg + prod_voutro - prod_vdesc) AS DOUBLE) AS venda
       FROM {fato_nfe_nfce_sumarizada} v JOIN {dm_contribuinte} c ON c.co_cnpj_cpf = v.co_emitente AND c.co_regime_pagto = '001'
       LEFT JOIN {dm_pessoa} p ON p.co_cnpj_cpf = v.co_destinatario
       WHERE v.co_uf_emit = 'RO' AND v.co_tp_nf = '1' AND v.da_referencia BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' AND v.co_destinatario IN ('3', '14', '15', '92')
         AND v.co_cfop IN (SELECT co_cfop FROM {dm_cfop} WHERE in_vaf = 'X' AND dev_venda IS NULL AND dev_compra IS NULL
           AND upper(descricao_cfop) NOT LIKE 'TRANSF%' AND upper(descricao_cfop) NOT LIKE 'RETORN%' AND upper(descricao_cfop) NOT LIKE 'ANULA%')
       GROUP BY ALL""",
    Params(start="1996-01-01", end="1999-12-31", buyers=("3", "14", "15", "92")),
)

_audit(
    "Q09_inventory",
    "bloco_h",
    f"""SELECT a.cnpj, {_date("h.dt_inv", "dt_inv")}, h.mot_inv AS cod_mot_inv, {lb.decode_sql("h.mot_inv", lb.INVENTORY_REASON, "h.mot_inv")} AS mot_inv_desc,
          CAST(CAST(h.vl_inv AS DECIMAL(18,6)) AS DOUBLE) AS valor_total_inventario_h005, i.cod_item AS codigo_produto,
          regexp_replace(i.cod_item, '[^[:alnum:]]', '', 'g') AS codigo_produto_limpo, p.descr_item AS descricao_produto, p.cod_ncm, p.cest, p.cod_barra, p.tipo_item,
          i.unid AS unidade_medida, CAST(i.qtd AS DOUBLE) AS quantidade, 0.0::DOUBLE AS valor_unitario, CAST(CAST(i.vl_item AS DECIMAL(18,6)) AS DOUBLE) AS valor_item,
          i.ind_prop AS indicador_propriedade, i.cod_part AS participante_terceiro, i.txt_compl AS obs_complementar, x.cst_icms,
          CAST(CAST(x.bc_icms AS DECIMAL(18,6)) AS DOUBLE) AS bc_icms, CAST(CAST(x.vl_icms AS DECIMAL(18,6)) AS DOUBLE) AS vl_icms
        FROM {FILES} a JOIN {{reg_h005}} h ON h.reg_0000_id = a.reg_0000_id JOIN {{reg_h010}} i ON i.reg_h005_id = h.id AND i.reg_0000_id = a.reg_0000_id
        LEFT JOIN {{reg_h020}} x ON x.reg_h010_id = i.id AND x.reg_0000_id = a.reg_0000_id
        LEFT JOIN {{reg_0200}} p ON p.reg_0000_id = a.reg_0000_id AND p.cod_item = i.cod_item""",
)

_MONEY_C100 = (
    "vl_doc vl_desc vl_abat_nt vl_merc vl_frt vl_seg vl_out_da vl_bc_icms vl_icms vl_bc_icms_st vl_icms_st vl_ipi vl_pis vl_cofins vl_pis_st vl_cofins_st"
).split()

_audit(
    "Q10_ledger_documents",
    "c100",
    f"""SELECT a.cnpj, strftime(a.dt_ini, '%Y/%m') AS periodo_efd, CAST(a.data_entrega AS VARCHAR) AS data_entrega_efd_periodo, a.cod_fin_efd,
          {lb.decode_sql("c.ind_oper", lb.DIRECTION)} AS ind_oper_desc, {lb.decode_sql("c.ind_emit", lb.ISSUER)} AS ind_emit_desc, c.cod_part, c.cod_mod, c.cod_sit,
          {lb.decode_sql("c.cod_sit", lb.DOCUMENT_SITUATION, "'Código desconhecido'")} AS descricao_cod_sit, c.ser, c.num_doc, c.chv_nfe,
          {_date("c.dt_doc", "dt_doc")}, {_date("c.dt_e_s", "dt_e_s")}, {lb.decode_sql("c.ind_pgto", lb.PAYMENT)} AS ind_pgto_desc,
          {lb.decode_sql("c.ind_frt", lb.FREIGHT)} AS ind_frt_por_conta_de, {dbl(*["c." + m for m in _MONEY_C100])}
        FROM {{reg_c100}} c JOIN {DECLARED} a ON a.reg_0000_id = c.reg_0000_id""",
)

_audit(
    "Q11_ledger_items",
    "c170",
    f"""SELECT a.cnpj, strftime(a.dt_ini, '%Y/%m') AS periodo_efd, trim(c.chv_nfe) AS chv_nfe, c.cod_sit, {lb.decode_sql("c.cod_sit", lb.DOCUMENT_SITUATION, "'Código desconhecido'")} AS cod_sit_desc,
          c.ind_emit, {lb.decode_sql("c.ind_emit", lb.ISSUER, "'Não informado'")} AS ind_emit_desc, c.ind_oper, {lb.decode_sql("c.ind_oper", lb.DIRECTION, "'Não informado'")} AS ind_oper_desc,
          c.num_doc, {_date("c.dt_doc", "dt_doc")}, i.num_item, i.cod_item, p.cod_barra, p.cod_ncm, p.cest, p.tipo_item, p.descr_item, i.descr_compl, i.cfop, i.cst_icms, i.unid,
          CAST(coalesce(i.qtd, 0) AS DOUBLE) AS qtd, CAST(i.vl_item AS DOUBLE) AS vl_item, CAST(coalesce(i.vl_icms, 0) AS DOUBLE) AS vl_icms,
          CAST(coalesce(i.vl_bc_icms, 0) AS DOUBLE) AS vl_bc_icms, CAST(i.aliq_icms AS DOUBLE) AS aliq_icms, CAST(coalesce(i.vl_bc_icms_st, 0) AS DOUBLE) AS vl_bc_icms_st,
          CAST(coalesce(i.vl_icms_st, 0) AS DOUBLE) AS vl_icms_st, CAST(i.aliq_st AS DOUBLE) AS aliq_st
        FROM {{reg_c170}} i JOIN {{reg_c100}} c ON c.id = i.reg_c100_id AND c.reg_0000_id = i.reg_0000_id JOIN {FILES} a ON a.reg_0000_id = c.reg_0000_id
        LEFT JOIN {{reg_0200}} p ON p.reg_0000_id = i.reg_0000_id AND p.cod_item = i.cod_item""",
)

_audit(
    "Q12_refund_items",
    "c176",
    f"""SELECT a.cnpj, strftime(a.dt_ini, '%Y/%m') AS periodo_efd, CAST(a.data_entrega AS VARCHAR) AS data_entrega_efd_periodo, a.cod_fin_efd,
          {lb.decode_sql("a.cod_fin_efd", lb.FILE_PURPOSE, "a.cod_fin_efd")} AS finalidade_efd, c.chv_nfe AS chave_saida, c.num_doc AS num_nf_saida, c.dt_doc AS dt_doc_saida,
          c.dt_e_s AS dt_e_s_saida, i.cod_item, i.descr_compl AS descricao_item, i.num_item AS num_item_saida, i.cfop AS cfop_saida, i.unid AS unid_saida,
          CAST(i.qtd AS DOUBLE) AS qtd_item_saida, CAST(i.vl_item AS DOUBLE) AS vl_total_item, r.cod_mot_res, {lb.decode_sql("r.cod_mot_res", lb.REFUND_REASON, "r.cod_mot_res")} AS descricao_motivo_ressarcimento,
          r.chave_nfe_ult AS chave_nfe_ultima_entrada, r.num_item_ult_e AS c176_num_item_ult_e_declarado, {_date("r.dt_ult_e", "dt_ultima_entrada")},
          CAST(r.vl_unit_ult_e AS DOUBLE) AS vl_unit_bc_st_entrada, CAST(r.vl_unit_icms_ult_e AS DOUBLE) AS vl_unit_icms_proprio_entrada, CAST(r.vl_unit_res AS DOUBLE) AS vl_unit_ressarcimento_st,
          CAST(coalesce(i.qtd, 0) * coalesce(r.vl_unit_icms_ult_e, 0) AS DOUBLE) AS vl_ressarc_credito_proprio, CAST(coalesce(i.qtd, 0) * coalesce(r.vl_unit_res, 0) AS DOUBLE) AS vl_ressarc_st_retido,
          CAST(CASE WHEN coalesce(i.vl_icms, 0) > 0 THEN i.qtd * r.vl_unit_res + i.qtd * r.vl_unit_icms_ult_e ELSE i.qtd * r.vl_unit_res END AS DOUBLE) AS vr_total_ressarcimento
        FROM {{reg_c176}} r JOIN {DECLARED} a ON a.reg_0000_id = r.reg_0000_id JOIN {{reg_c100}} c ON c.id = r.reg_c100_id JOIN {{reg_c170}} i ON i.id = r.reg_c170_id""",
)


def _adjusted(codes: str, name: str) -> str:
    return f"CAST(SUM(CASE WHEN e.cod_aj_apur IN ({codes}) THEN coalesce(e.vl_aj_apur, 0) ELSE 0 END) AS DOUBLE) AS {name}"


_audit(
    "Q13_refund_reconciliation",
    "c176_mensal",
    f"""SELECT coalesce(r.cnpj, e.cnpj) AS cnpj, strftime(coalesce(r.mes, e.mes), '%m/%Y') AS periodo_efd, CAST(coalesce(r.mes, e.mes) AS VARCHAR) AS mes_referencia,
          coalesce(r.n, 0) AS qtd_itens_analisados_c176, coalesce(r.p, 0) AS total_ressarc_credito_proprio, coalesce(e.p, 0) AS total_ajuste_credito_proprio_e111,
          CAST(CAST(coalesce(r.p, 0) AS DECIMAL(18,4)) - CAST(coalesce(e.p, 0) AS DECIMAL(18,4)) AS DOUBLE) AS diferenca_credito_proprio,
          coalesce(r.s, 0) AS total_ressarc_st_retido, coalesce(e.s, 0) AS total_ajuste_st_retido_e111,
          CAST(CAST(coalesce(r.s, 0) AS DECIMAL(18,4)) - CAST(coalesce(e.s, 0) AS DECIMAL(18,4)) AS DOUBLE) AS diferenca_st_retido,
          coalesce(e.c50, 0) AS total_ajuste_ro020050_e111, coalesce(e.c48, 0) AS total_ajuste_ro020048_e111
        FROM (SELECT a.cnpj, a.dt_ini AS mes, count(*) AS n, CAST(SUM(coalesce(i.qtd, 0) * coalesce(r.vl_unit_icms_ult_e, 0)) AS DOUBLE) AS p,
                CAST(SUM(coalesce(i.qtd, 0) * coalesce(r.vl_unit_res, 0)) AS DOUBLE) AS s
              FROM {FILES_BY_PERIOD} a JOIN {{reg_c176}} r ON r.reg_0000_id = a.reg_0000_id JOIN {{reg_c100}} c ON c.id = r.reg_c100_id AND c.reg_0000_id = a.reg_0000_id
              JOIN {{reg_c170}} i ON i.id = r.reg_c170_id AND i.reg_0000_id = a.reg_0000_id GROUP BY 1, 2) r
        FULL JOIN (SELECT a.cnpj, a.dt_ini AS mes, {_adjusted("'RO020023', 'RO020049'", "p")}, {_adjusted("'RO020022', 'RO020047'", "s")},
                     {_adjusted("'RO020050'", "c50")}, {_adjusted("'RO020048'", "c48")}
                   FROM {FILES_BY_PERIOD} a JOIN {{reg_e111}} e ON e.reg_0000_id = a.reg_0000_id GROUP BY 1, 2) e ON e.cnpj = r.cnpj AND e.mes = r.mes""",
)

_MONEY_V2 = "qtd vl_item vl_desc vl_bc_icms vl_icms vl_bc_icms_st aliq_st vl_icms_st vl_bc_ipi aliq_ipi vl_ipi vl_abat_nt aliq_icms".split()

_audit(
    "Q14_analytic_items",
    "c176_v2",
    f"""SELECT a.cnpj, strftime(a.data_entrega, '%d/%m/%Y') AS dt_ultima_entrega, a.cod_fin_efd AS cod_fin, {lb.decode_sql("a.cod_fin_efd", lb.FILE_PURPOSE_PLAIN, "'Outros'")} AS descricao_fin,
          CAST(year(a.dt_ini) AS INTEGER) AS ano_efd, strftime(a.dt_ini, '%m/%Y') AS periodo_efd, c.reg AS c100_reg, c.cod_sit,
          {lb.decode_sql("c.cod_sit", lb.DOCUMENT_SITUATION_SHORT, "'Código desconhecido'")} AS descricao_cod_sit, c.ind_oper, {lb.decode_sql("c.ind_oper", lb.DIRECTION_SHORT)} AS oper,
          c.ind_emit, {lb.decode_sql("c.ind_emit", lb.ISSUER_SHORT)} AS descricao_ind_emit, c.chv_nfe, c.num_doc, c.cod_part, {_date("c.dt_doc", "dt_doc")}, {_date("c.dt_e_s", "dt_e_s")},
          i.reg AS c170_reg, i.num_item, i.cod_item, regexp_replace(ltrim(i.cod_item, '0'), '[ .-]', '', 'g') AS cod, p.cod_barra, p.descr_item, p.tipo_item,
          {lb.decode_sql("p.tipo_item", lb.ITEM_TYPE, "'Tipo Desconhecido'")} AS descricao_tipo_item, p.cod_gen,
          CASE p.cod_gen WHEN '00' THEN 'Serviço' WHEN '01' THEN 'Animais vivos' ELSE concat('Código Genérico ', p.cod_gen) END AS descricao_cod_gen, p.cod_ncm, p.cest,
          nullif(regexp_extract(p.cest, '^[0-9][0-9]'), '') AS segmento_cest, g.no_segmento, i.cfop, o.descricao_cfop, i.cod_nat, n.descr_nat AS descricao_cod_nat, i.cst_icms,
          s.desc_cst AS descricao_cst_icms, i.ind_mov, {lb.decode_sql("i.ind_mov", lb.PHYSICAL_MOVEMENT)} AS descricao_ind_mov, p.unid_inv, i.unid, i.cst_ipi, i.cod_enq, i.cod_cta,
          {dbl(*["i." + m for m in _MONEY_V2])}
        FROM {{reg_c170}} i JOIN {FILES_BY_PERIOD} a ON a.reg_0000_id = i.reg_0000_id JOIN {{reg_c100}} c ON c.id = i.reg_c100_id
        LEFT JOIN {{reg_0200}} p ON p.reg_0000_id = i.reg_0000_id AND p.cod_item = i.cod_item LEFT JOIN {{reg_0400}} n ON n.cod_nat = i.cod_nat AND n.reg_0000_id = i.reg_0000_id
        LEFT JOIN {{dm_cfop}} o ON o.co_cfop = i.cfop LEFT JOIN {{dm_cst}} s ON s.co_cst = i.cst_icms
        LEFT JOIN {{dm_cest_segmento}} g ON g.cod_segmento = regexp_extract(p.cest, '^[0-9][0-9]')""",
)

_CTE = "SELECT *, {} AS cnpj, '{}' AS papel_cnpj_filtrado FROM cte WHERE {}"
_audit(
    "Q15_transport_documents",
    "cte",
    f"""WITH cte AS (SELECT *, regexp_replace(emit_co_cnpj, '[^0-9]', '', 'g') AS e, regexp_replace(rem_cnpj_cpf, '[^0-9]', '', 'g') AS r,
          regexp_replace(dest_cnpj_cpf, '[^0-9]', '', 'g') AS d, regexp_replace(co_tomador4_cnpj_cpf, '[^0-9]', '', 'g') AS t FROM {{fato_cte_detalhe}})
        SELECT cnpj, papel_cnpj_filtrado, {lb.decode_sql("co_tomador3", lb.TRANSPORT_PAYER, "'Outros'")} AS tipo_tomador, chave_acesso, nsu, co_tomador3, emit_co_cnpj, rem_cnpj_cpf,
          dest_cnpj_cpf, co_tomador4_cnpj_cpf, CAST(prest_vtprest AS DOUBLE) AS prest_vtprest
        FROM ({_CTE.format("e", "Emitente", "e IS NOT NULL")} UNION ALL {_CTE.format("r", "Remetente", "e <> r")}
              UNION ALL {_CTE.format("d", "Destinatário", "e <> d AND r <> d")} UNION ALL {_CTE.format("t", "Tomador", "e <> t AND r <> t AND d <> t")})""",
)

_START, _END = "t.da_inicio_atividade", f"CASE WHEN t.in_situacao = '001' THEN DATE '{TODAY}' ELSE CAST(strptime(h.d, '%Y%m%d') AS DATE) END"
_MONTHS = """CASE WHEN day(a) = day(b) OR (a = last_day(a) AND b = last_day(b)) THEN CAST((year(b) - year(a)) * 12 + month(b) - month(a) AS DOUBLE)
             ELSE CAST((year(b) - year(a)) * 12 + month(b) - month(a) AS DOUBLE) + (day(b) - day(a)) / 31.0 END"""
_audit(
    "Q16_taxpayer_data",
    "dados_cadastrais",
    f"""SELECT cnpj, ie, nome, nome_fantasia, endereco, municipio, uf, regime_de_pagamento, situacao_da_ie, CAST(a AS VARCHAR) AS data_de_inicio_da_atividade, data_da_ultima_situacao,
          concat(regexp_replace(CAST(CAST(CASE WHEN m >= 0 THEN floor(m * 100) ELSE ceil(m * 100) END / 100 AS DECIMAL(18,2)) AS VARCHAR), '(\\.00|0)$', ''), ' meses') AS periodo_em_atividade,
          redesim FROM (SELECT *, {_MONTHS} AS m FROM
        (SELECT t.co_cnpj_cpf AS cnpj, t.co_cad_icms AS ie, t.no_razao_social AS nome, t.no_fantasia AS nome_fantasia, concat(t.desc_endereco, ' ', t.bairro) AS endereco, l.no_municipio AS municipio,
           l.co_uf AS uf, concat(t.co_regime_pagto, ' - ', r.no_regime_pagamento) AS regime_de_pagamento, concat(t.in_situacao, ' - ', s.no_situacao_contribuinte) AS situacao_da_ie,
           {_START} AS a, {_END} AS b, CAST(CAST(strptime(h.d, '%Y%m%d') AS DATE) AS VARCHAR) AS data_da_ultima_situacao,
           concat('https://portalcontribuinte.sefin.ro.gov.br/Publico/parametropublica.jsp?NuDevedor=', t.co_cad_icms) AS redesim
         FROM {{dm_pessoa}} t LEFT JOIN {{dm_localidade}} l ON l.co_municipio = t.co_municipio LEFT JOIN {{dm_regime_pagto_descricao}} r ON r.co_regime_pagamento = t.co_regime_pagto
         LEFT JOIN {{dm_situacao_contribuinte}} s ON s.co_situacao_contribuinte = t.in_situacao
         LEFT JOIN (SELECT u.it_nu_inscricao_estadual AS k, MAX(u.it_da_transacao) AS d FROM {{sitafe_historico_gr_situacao}} g LEFT JOIN {{sitafe_historico_situacao}} u ON u.tuk = g.tuk
                    WHERE g.it_co_situacao_contribuinte NOT IN ('030', '150', '005') AND u.it_co_usuario NOT IN ('INTERNET', 'P30015AC   ') GROUP BY 1) h ON h.k = t.co_cad_icms))""",
)

_DIFF = f"""
    SELECT x.cnpj, x.modelo, x.chave_acesso, x.serie, x.num_doc, x.data_emissao, x.v, x.icms, coalesce(l.vl_icms, 0) AS declarado
    FROM (SELECT co_emitente AS cnpj, 'NF-e (Mod 55)' AS modelo, chave_acesso, ide_serie AS serie, nnf AS num_doc, CAST(dhemi AS VARCHAR) AS data_emissao, tot_vnf AS v, tot_vicms AS icms
          FROM {{fato_nfe_detalhe}} WHERE co_tp_nf = 1 AND infprot_cstat IN ('100', '150') AND seq_nitem = 1
          UNION ALL SELECT co_emitente, 'NFC-e (Mod 65)', chave_acesso, ide_serie, nnf, CAST(dhemi AS VARCHAR), tot_vnf, tot_vicms
          FROM {{fato_nfce_detalhe}} WHERE infprot_cstat IN ('100', '150') AND seq_nitem = 1) x
    JOIN {_LEDGER_DOCS} l ON l.cnpj = x.cnpj AND l.chv_nfe = x.chave_acesso AND l.ind_oper = '1' WHERE coalesce(l.vl_icms, 0) < x.icms"""
_DIFF_SHOWN = """d.modelo, d.chave_acesso, d.serie, d.num_doc, d.data_emissao, CAST(d.v AS DOUBLE) AS valor_total_nfe, CAST(d.icms AS DOUBLE) AS icms_destacado_nfe,
    CAST(d.declarado AS DOUBLE) AS icms_escriturado_efd, CAST(d.icms - d.declarado AS DOUBLE) AS diferenca_icms_nao_debitado, 'Débito a Menor na EFD' AS status_auditoria"""

_audit("Q17_under_declared_tax", "dif_icms", f"SELECT d.cnpj, {_DIFF_SHOWN} FROM ({_DIFF}) d")

_audit(
    "Q18_under_declared_with_context",
    "dif_icms_v2",
    f"""SELECT d.cnpj, {_CONTEXT}, {_DIFF_SHOWN} FROM ({_DIFF}) d
        LEFT JOIN {{vw_fisconforme_chave_nota}} f ON f.cpf_cnpj = d.cnpj AND f.chave_acesso = d.chave_acesso
        LEFT JOIN {{pendencias}} pen ON pen.cpf_cnpj = d.cnpj AND pen.malhas_id = f.malhas_id AND pen.referencia_malhas_id = f.referencia_malhas_id
        LEFT JOIN {{malhas}} m ON m.id = f.malhas_id LEFT JOIN {{fato_det_notificacao}} n ON n.id_fisconforme = pen.id AND n.co_cnpj_notif = d.cnpj""",
)

_audit(
    "Q19_border_items",
    "fronteira",
    f"""SELECT p.cnpj, CASE WHEN (d.co_emitente = p.cnpj) = (d.co_tp_nf = 1) THEN '1 - SAIDA' ELSE '0 - ENTRADA' END AS tipo_operacao, d.chave_acesso, d.seq_nitem AS num_item,
          d.prod_cprod AS cod_item, d.prod_xprod AS desc_item, d.prod_ncm AS ncm, d.prod_cest AS cest, CAST(d.prod_qcom AS DOUBLE) AS qtd_comercial, CAST(d.prod_vprod AS DOUBLE) AS valor_produto,
          CAST(d.icms_vbcst AS DOUBLE) AS bc_icms_st_destacado, CAST(d.icms_vicmsst AS DOUBLE) AS icms_st_destacado, c.it_co_sefin AS co_sefin, c.it_co_rotina_calculo AS cod_rotina_calculo,
          CAST(c.it_vl_icms AS DOUBLE) AS valor_icms_fronteira
        FROM {{fato_nfe_detalhe}} d JOIN {{sitafe_nfe_calculo_item}} c ON c.it_nu_chave_acesso = d.chave_acesso AND c.it_nu_item = d.seq_nitem,
          (SELECT unnest([0, 1]) AS side) s, LATERAL (SELECT CASE side WHEN 0 THEN d.co_emitente ELSE d.co_destinatario END AS cnpj) p
        WHERE d.dhemi <= DATE '{CUT_OFF}' AND (side = 0 OR d.co_destinatario <> d.co_emitente)""",
)

_NOTE_MONEY = {
    "prod_qcom": "it_qt_comercial",
    "prod_vuncom": "it_va_unitario_com",
    "prod_vprod": "it_va_produto",
    "prod_vfrete": "it_va_frete",
    "prod_vdesc": "it_va_desconto",
    "prod_voutro": "it_va_outro",
    "prod_vseg": "it_va_seguro",
    "icms_vbc": "it_va_bc",
    "icms_picms": "it_pc_icms",
    "icms_vicms": "it_va_icms",
    "icms_vbcst": "it_va_bc_st",
    "icms_vicmsst": "it_va_icms_st",
}
_LAUNCH_MONEY = {
    "vl_merc": "it_vl_merc_item",
    "vl_bc_merc": "it_vl_merc_bc_item",
    "aliq": "it_aliq_item",
    "vl_tot_deb": "it_vl_tot_debito_item",
    "vl_tot_cred": "it_vl_credito_rateio",
    "vl_icms": "it_vl_icms_recolher",
}
_GOODS = ", ".join(
    f"CAST(m.{c} AS DOUBLE) AS {c}" if c.startswith("it_pc") else f"m.{c}" for c in GOODS_ATTRIBUTES
)

_audit(
    "Q20_border_analysis",
    "fronteira_completo",
    f"""SELECT o.cnpj, o.chave, o.nota, o.cnpj_emit, o.nome_emit, o.uf_emitente, CAST(o.emissao AS VARCHAR) AS emissao, CAST(CAST(strptime(nl.it_da_entrada, '%Y%m%d') AS DATE) AS VARCHAR) AS entrada,
          nl.it_co_comando AS comando, i.it_nu_item AS prod_nitem, i.it_no_produto AS prod_xprod, i.it_co_cfop AS co_cfop, i.it_co_ncm AS ncm, i.it_un_comercial AS prod_ucom,
          {", ".join(f"CAST(i.{src} AS DOUBLE) AS {name}" for name, src in _NOTE_MONEY.items())},
          CAST(i.it_va_produto + i.it_va_frete - i.it_va_desconto + i.it_va_outro + i.it_va_seguro AS DOUBLE) AS total_produto, l.it_co_receita AS receita, l.it_nu_guia_lancamento AS guia,
          CAST(l.it_va_principal_original AS DOUBLE) AS valor_devido, CASE WHEN l.it_co_receita IS NULL THEN 0 ELSE CAST(l.it_va_total_pgto_efetuado AS DOUBLE) END AS valor_pago,
          CASE WHEN l.it_co_situacao_lancamento IS NULL THEN ' ' ELSE {lb.decode_sql("l.it_co_situacao_lancamento", lb.LAUNCH_STATUS, "'VERIFICAR'")} END AS situacao,
          li.it_co_produto AS co_sefin, ps.it_no_produto AS nome_co_sefin, {", ".join(f"CAST(li.{src} AS DOUBLE) AS {name}" for name, src in _LAUNCH_MONEY.items())}, {_GOODS}
        FROM (SELECT chave_acesso AS chave, co_destinatario AS cnpj, MAX(nnf) AS nota, MAX(co_emitente) AS cnpj_emit, MAX(xnome_emit) AS nome_emit, MAX(dhemi) AS emissao, MAX(co_uf_emit) AS uf_emitente
              FROM {{fato_nfe_detalhe}} WHERE co_tp_nf = 1 AND co_uf_emit <> 'RO' AND infprot_cstat IN ('100', '150') GROUP BY 1, 2) o
        JOIN {{sitafe_nota_fiscal}} nf ON nf.it_nu_identificao_nf_e = o.chave AND nf.it_nucnpj_cpf_destino_nf = o.cnpj
        JOIN {{sitafe_nf_lancamento}} nl ON nl.it_nu_identificacao_nf = nf.it_nu_identificacao_nf AND nl.it_nu_cnpj_cpf_destino_nf = o.cnpj
        JOIN {{sitafe_nfe_item}} i ON i.it_nu_chave_acesso = o.chave JOIN {{sitafe_lancamento}} l ON l.it_nu_guia_lancamento = nl.it_nu_guia_lancamento
        JOIN {{sitafe_lancamento_item}} li ON li.it_nu_identificacao_ndf = nl.it_nu_identificacao_ndf AND li.it_co_produto = i.it_co_sefin
        JOIN {{sitafe_mercadoria}} m ON m.it_co_sefin = li.it_co_produto LEFT JOIN {{sitafe_produto_sefin}} ps ON ps.it_co_sefin = li.it_co_produto""",
)

_audit(
    "Q21_file_versions",
    "reg_0000",
    f"""SELECT cnpj, id AS reg_0000_id, reg, cod_fin, {lb.decode_sql("cod_fin", lb.FILE_PURPOSE_LONG, "'Outros'")} AS finalidade_arquivo, {txt("dt_ini", "dt_fin")},
          {lb.decode_sql("ind_perfil", lb.PROFILE, "'Outros'")} AS ind_perfil, {lb.decode_sql("ind_ativ", lb.ACTIVITY, "'Outros'")} AS ind_ativ, arquivo_nome,
          strftime(dt_ini, '%m/%Y') AS periodo_efd, CAST(data_entrega AS VARCHAR) AS data_entrega,
          row_number() OVER (PARTITION BY cnpj, dt_ini ORDER BY data_entrega DESC, id DESC) AS ordem, count(*) OVER (PARTITION BY cnpj, dt_ini) AS qtd_envios,
          '{CUT_OFF}' AS data_limite_processamento FROM {{reg_0000}} WHERE data_entrega < DATE '{CUT_OFF}' + INTERVAL 1 DAY""",
)

for _name, _query, _table, _columns in (
    ("Q22_taxpayer_register", "reg_0005", "reg_0005", "r.reg_0005_id, r.reg_0000_id, r.fantasia, r.cep"),
    ("Q23_unit_register", "reg_0190", "reg_0190", "r.reg_0000_id, r.unid, r.descr"),
):
    _audit(
        _name,
        _query,
        f"""SELECT a.cnpj, strftime(a.dt_ini, '%m/%Y') AS periodo_efd, {_columns}, a.cod_fin_efd, CAST(a.data_entrega AS VARCHAR) AS data_entrega_efd_periodo
            FROM {{{_table}}} r JOIN {FILES_BY_PERIOD} a ON a.reg_0000_id = r.reg_0000_id""",
    )

_audit(
    "Q24_product_register",
    "reg_0200",
    f"""SELECT a.cnpj, strftime(a.dt_ini, '%m/%Y') AS periodo_efd, p.cod_item, p.cod_ant_item, x.cod_ant_item AS r0205_cod_ant_item, p.descr_item, CAST(p.aliq_icms AS DOUBLE) AS aliq_icms,
          p.unid_inv, x.descr_ant_item, x.dt_ini AS dt_ini_ant_item, x.dt_fim AS dt_fim_ant_item, c.unid_conv, CAST(c.fat_conv AS DOUBLE) AS fat_conv, p.cod_barra, p.cod_ncm, p.cest,
          p.tipo_item, {lb.decode_sql("p.tipo_item", lb.ITEM_TYPE_NUMBERED, "p.tipo_item")} AS desc_tipo_item, p.cod_gen,
          {lb.decode_sql("p.cod_gen", lb.GENUS, "'Código Desconhecido'")} AS descricao_cod_gen, a.cod_fin_efd, CAST(a.data_entrega AS VARCHAR) AS data_entrega_efd_periodo
        FROM {FILES_BY_PERIOD} a JOIN {{reg_0200}} p ON p.reg_0000_id = a.reg_0000_id
        LEFT JOIN {{reg_0205}} x ON x.reg_0000_id = p.reg_0000_id AND x.reg_0200_id = p.id LEFT JOIN {{reg_0220}} c ON c.reg_0000_id = p.reg_0000_id AND c.reg_0200_id = p.id""",
)


@check(
    "A13_extract_all_queries",
    " UNION ALL ".join(
        f"SELECT '{query}' AS consulta, 'written' AS situacao, (SELECT count(*) FROM ({sql})) AS linhas"
        if CATALOGUE[query].per_taxpayer
        else f"SELECT '{query}', 'skipped', 0"
        for query, sql in AUDITS.items()
    ),
)
def a13_all(t):
    """Every query through the extraction and the writer of tables by taxpayer, and what is stored then."""
    spark = t["orders"].sparkSession
    root = f"{work_folder(spark)}/extract-{uuid.uuid4().hex}"
    done = extract(t, PARAMS, table_writer(root))
    counts = [
        (read_table(spark, o.detail).agg(F.count("*").alias("linhas")) if o.status == "written" else spark.range(1).select(F.lit(0).cast("long").alias("linhas")))
        .select(F.lit(o.query).alias("consulta"), F.lit(o.status).alias("situacao"), "linhas")
        for o in done
    ]
    remove_at_end(spark, root)
    return reduce(DataFrame.unionByName, counts)


def _rule_sql(rule: Rule) -> str:
    number = f"TRY_CAST({rule.column} AS DOUBLE)"
    fires = {
        "greater_than": f"{number} > {rule.value}",
        "not_blank": f"{rule.column} IS NOT NULL AND CAST({rule.column} AS VARCHAR) <> ''",
        "equals": f"CAST({rule.column} AS VARCHAR) = '{rule.value}'",
        "not_equal_zero": f"{number} <> 0",
        "compare_columns": f"{number} {rule.value} TRY_CAST({rule.other} AS DOUBLE)",
    }[rule.kind]
    return f"CASE WHEN {fires} THEN '{rule.label}' END"


#: Rules on columns that the stand-in tables lack; they are skipped.
_ABSENT = {("nfce", "ide_co_mod")}
_FLAGGED = {query: rules for query, rules in RULES.items() if query in CATALOGUE}
_SHOWN = {query: [r for r in rules if (query, r.column) not in _ABSENT] for query, rules in _FLAGGED.items()}


@check(
    "B20_declared_rules",
    " UNION ALL ".join(
        f"SELECT '{query}' AS tabela, concat_ws('; ', {', '.join(map(_rule_sql, rules))}) AS alertas, count(*) AS linhas FROM ({AUDITS[query]}) GROUP BY 1, 2"
        for query, rules in _SHOWN.items()
    ),
)
def b20_declared(t):
    """The declared rules over every catalogue query that has some."""
    flagged = [with_flags(CATALOGUE[query].run(t, PARAMS), rules).select(F.lit(query).alias("tabela"), "alertas") for query, rules in _FLAGGED.items()]
    return reduce(DataFrame.unionByName, flagged).groupBy("tabela", "alertas").agg(F.count("*").alias("linhas"))


@check(
    "C16_snowflake_join",
    f"SELECT uf_emitente, receita, situacao, co_sefin, nome_co_sefin, count(*) AS linhas, count(DISTINCT chave) AS notas, min(guia) AS guia FROM ({AUDITS['fronteira_completo']}) GROUP BY ALL",
)
def c16(t):
    """Eight tables from the note to the product code, counted by what the joins attach."""
    joined = CATALOGUE["fronteira_completo"].run(t, PARAMS)
    keys = ["uf_emitente", "receita", "situacao", "co_sefin", "nome_co_sefin"]
    return joined.groupBy(*keys).agg(F.count("*").alias("linhas"), F.count_distinct("chave").alias("notas"), F.min("guia").alias("guia"))


@check(
    "G04_exclusive_roles",
    f"SELECT cnpj, papel_cnpj_filtrado, count(*) AS documentos, min(chave_acesso) AS primeiro FROM ({AUDITS['cte']}) GROUP BY ALL",
)
def g04(t):
    """Each document once for every different party, under the first role that the party has in it."""
    roles = CATALOGUE["cte"].run(t, PARAMS)
    return roles.groupBy("cnpj", "papel_cnpj_filtrado").agg(F.count("*").alias("documentos"), F.min("chave_acesso").alias("primeiro"))
