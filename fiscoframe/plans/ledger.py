"""Audit queries over the monthly ledger files.

All start from the file version in force at the cut-off.  The version table is
joined to the document header first; items then join the reduced header, so the
large item tables meet the version filter through their own header key.  Every join
has the file among its keys, so registers move once, to the task of their file.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscoframe.functions import labels as lb
from fiscoframe.functions.text import clean_item_code
from fiscoframe.functions.values import ddmmyyyy, period
from fiscoframe.operators.aggregates import conditional_sum
from fiscoframe.operators.predicates import between_dates, equals_if_given
from fiscoframe.operators.versioning import all_versions, valid_files
from fiscoframe.plans.parameters import Params, one_taxpayer
from fiscoframe.schemas import MEASURE, measure
from fiscoframe.session import by_leading_keys

# Adjustment codes of the refund reconciliation.
OWN_CREDIT_CODES = ("RO020023", "RO020049")
WITHHELD_CODES = ("RO020022", "RO020047")
OTHER_CREDIT_CODE = "RO020050"
OTHER_WITHHELD_CODE = "RO020048"

T = Mapping[str, DataFrame]


def files_in_force(t: T, p: Params, by_period: bool = False) -> DataFrame:
    """Valid version of every ledger file, from the header register."""
    files = by_leading_keys(one_taxpayer(t["reg_0000"], "cnpj", p.cnpj))
    if by_period:
        files = files.where(between_dates(F.col("dt_ini"), p.start, p.end, p.today or p.limit))
    files = files.select(
        F.col("id").alias("reg_0000_id"), "cnpj", F.col("cod_fin").alias("cod_fin_efd"), "dt_ini", "data_entrega"
    )
    return valid_files(files, p.limit)


def declared_files_in_force(t: T, p: Params) -> DataFrame:
    """Valid version of every ledger file, from the valid-file dimension."""
    files = by_leading_keys(one_taxpayer(t["dm_efd_arquivo_valido"], "co_cnpj_cpf_declarante", p.cnpj)).select(
        "reg_0000_id",
        F.col("co_cnpj_cpf_declarante").alias("cnpj"),
        F.col("in_codigo_finalidade").alias("cod_fin_efd"),
        F.col("da_inicio_arquivo").alias("dt_ini"),
        F.col("da_entrega_arquivo").alias("data_entrega"),
    )
    return valid_files(files, p.limit)


def _amount(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).alias(name)


def documents(t: T, p: Params) -> DataFrame:
    """Ledger documents (C100)."""
    joined = t["reg_c100"].join(declared_files_in_force(t, p), "reg_0000_id")
    return joined.select(
        "cnpj",
        period(F.col("dt_ini")).alias("periodo_efd"),
        F.col("data_entrega").alias("data_entrega_efd_periodo"),
        "cod_fin_efd",
        lb.decode(F.col("ind_oper"), lb.DIRECTION).alias("ind_oper_desc"),
        lb.decode(F.col("ind_emit"), lb.ISSUER).alias("ind_emit_desc"),
        "cod_part",
        "cod_mod",
        "cod_sit",
        lb.decode(F.col("cod_sit"), lb.DOCUMENT_SITUATION, lb.UNKNOWN_CODE).alias("descricao_cod_sit"),
        "ser",
        "num_doc",
        "chv_nfe",
        ddmmyyyy(F.col("dt_doc")).alias("dt_doc"),
        ddmmyyyy(F.col("dt_e_s")).alias("dt_e_s"),
        "vl_doc",
        lb.decode(F.col("ind_pgto"), lb.PAYMENT).alias("ind_pgto_desc"),
        "vl_desc",
        "vl_abat_nt",
        "vl_merc",
        lb.decode(F.col("ind_frt"), lb.FREIGHT).alias("ind_frt_por_conta_de"),
        "vl_frt",
        "vl_seg",
        "vl_out_da",
        "vl_bc_icms",
        "vl_icms",
        "vl_bc_icms_st",
        "vl_icms_st",
        "vl_ipi",
        "vl_pis",
        "vl_cofins",
        "vl_pis_st",
        "vl_cofins_st",
    )


def items(t: T, p: Params) -> DataFrame:
    """Ledger items (C170) with their document and product master."""
    header = (
        t["reg_c100"]
        .select(
            F.col("id").alias("reg_c100_id"),
            "reg_0000_id",
            F.trim("chv_nfe").alias("chv_nfe"),
            "cod_sit",
            "ind_emit",
            "ind_oper",
            "num_doc",
            "dt_doc",
        )
        .join(files_in_force(t, p).select("reg_0000_id", "cnpj", "dt_ini"), "reg_0000_id")
    )
    product = t["reg_0200"].select(
        "reg_0000_id", "cod_item", "cod_barra", "cod_ncm", "cest", "tipo_item", "descr_item"
    )
    lines = t["reg_c170"].join(header, ["reg_c100_id", "reg_0000_id"])
    return lines.join(product, ["reg_0000_id", "cod_item"], "left").select(
        "cnpj",
        period(F.col("dt_ini")).alias("periodo_efd"),
        "chv_nfe",
        "cod_sit",
        lb.decode(F.col("cod_sit"), lb.DOCUMENT_SITUATION, lb.UNKNOWN_CODE).alias("cod_sit_desc"),
        "ind_emit",
        lb.decode(F.col("ind_emit"), lb.ISSUER, "Não informado").alias("ind_emit_desc"),
        "ind_oper",
        lb.decode(F.col("ind_oper"), lb.DIRECTION, "Não informado").alias("ind_oper_desc"),
        "num_doc",
        ddmmyyyy(F.col("dt_doc")).alias("dt_doc"),
        "num_item",
        "cod_item",
        "cod_barra",
        "cod_ncm",
        "cest",
        "tipo_item",
        "descr_item",
        "descr_compl",
        "cfop",
        "cst_icms",
        _amount("qtd"),
        "unid",
        "vl_item",
        _amount("vl_icms"),
        _amount("vl_bc_icms"),
        "aliq_icms",
        _amount("vl_bc_icms_st"),
        _amount("vl_icms_st"),
        "aliq_st",
    )


def adjustments(t: T, p: Params) -> DataFrame:
    """Ledger adjustments (E111) per period."""
    names = t["dm_efd_ajustes"].select(
        F.rtrim("co_cod_aj").alias("codigo_ajuste"), F.col("no_cod_aj").alias("descricao_codigo_ajuste")
    )
    rows = t["reg_e111"].withColumnRenamed("cod_aj_apur", "codigo_ajuste")
    return (
        rows.join(files_in_force(t, p), "reg_0000_id")
        .join(names, "codigo_ajuste", "left")
        .select(
            "cnpj",
            period(F.col("dt_ini")).alias("periodo_efd"),
            "codigo_ajuste",
            "descricao_codigo_ajuste",
            F.col("descr_compl_aj").alias("descr_compl"),
            F.col("vl_aj_apur").alias("valor_ajuste"),
            F.col("data_entrega").alias("data_entrega_efd_periodo"),
            "cod_fin_efd",
        )
    )


def inventory(t: T, p: Params) -> DataFrame:
    """Inventory (H005 -> H010 -> H020) with the product master."""
    head = t["reg_h005"].select(
        F.col("id").alias("reg_h005_id"),
        "reg_0000_id",
        ddmmyyyy(F.col("dt_inv")).alias("dt_inv"),
        measure(F.col("vl_inv")).alias("valor_total_inventario_h005"),
        F.col("mot_inv").alias("cod_mot_inv"),
    )
    lines = t["reg_h010"].select(
        F.col("id").alias("reg_h010_id"),
        "reg_h005_id",
        "reg_0000_id",
        "cod_item",
        F.col("unid").alias("unidade_medida"),
        measure(F.col("qtd")).alias("quantidade"),
        measure(F.col("vl_unit")).alias("valor_unitario"),
        measure(F.col("vl_item")).alias("valor_item"),
        F.col("ind_prop").alias("indicador_propriedade"),
        F.col("cod_part").alias("participante_terceiro"),
        F.col("txt_compl").alias("obs_complementar"),
    )
    taxes = t["reg_h020"].select(
        "reg_h010_id",
        "reg_0000_id",
        "cst_icms",
        measure(F.col("bc_icms")).alias("bc_icms"),
        measure(F.col("vl_icms")).alias("vl_icms"),
    )
    product = t["reg_0200"].select(
        "reg_0000_id",
        "cod_item",
        F.col("descr_item").alias("descricao_produto"),
        "tipo_item",
        "cod_ncm",
        "cest",
        "cod_barra",
    )
    head = head.join(files_in_force(t, p).select("reg_0000_id", "cnpj"), "reg_0000_id")
    reason = F.col("cod_mot_inv")
    return (
        lines.join(head, ["reg_h005_id", "reg_0000_id"])
        .join(taxes, ["reg_h010_id", "reg_0000_id"], "left")
        .join(product, ["reg_0000_id", "cod_item"], "left")
        .select(
            "cnpj",
            "dt_inv",
            "cod_mot_inv",
            lb.decode(reason, lb.INVENTORY_REASON, reason).alias("mot_inv_desc"),
            "valor_total_inventario_h005",
            F.col("cod_item").alias("codigo_produto"),
            F.regexp_replace("cod_item", "[^\\p{Alnum}]", "").alias("codigo_produto_limpo"),
            "descricao_produto",
            "cod_ncm",
            "cest",
            "cod_barra",
            "tipo_item",
            "unidade_medida",
            "quantidade",
            "valor_unitario",
            "valor_item",
            "indicador_propriedade",
            "participante_terceiro",
            "obs_complementar",
            "cst_icms",
            "bc_icms",
            "vl_icms",
        )
    )


def refund_items(t: T, p: Params) -> DataFrame:
    """Tax-substitution refund items (C176) with the computed refunds."""
    header = t["reg_c100"].select(
        F.col("id").alias("reg_c100_id"),
        "reg_0000_id",
        F.col("chv_nfe").alias("chave_saida"),
        F.col("num_doc").alias("num_nf_saida"),
        F.col("dt_doc").alias("dt_doc_saida"),
        F.col("dt_e_s").alias("dt_e_s_saida"),
    )
    line = t["reg_c170"].select(
        F.col("id").alias("reg_c170_id"),
        "reg_0000_id",
        "cod_item",
        F.col("descr_compl").alias("descricao_item"),
        F.col("num_item").alias("num_item_saida"),
        F.col("cfop").alias("cfop_saida"),
        F.col("unid").alias("unid_saida"),
        F.col("qtd").alias("qtd_item_saida"),
        F.col("vl_item").alias("vl_total_item"),
        F.col("vl_icms").alias("vl_icms_item"),
    )
    quantity = F.col("qtd_item_saida")
    own, withheld = F.col("vl_unit_icms_ult_e"), F.col("vl_unit_res")
    zero = F.lit(0)
    purpose, reason = F.col("cod_fin_efd"), F.col("cod_mot_res")
    taxed = F.coalesce(F.col("vl_icms_item"), zero) > 0
    # the two large tables are cut to the files in force before they are moved
    files = declared_files_in_force(t, p)
    in_force = files.select("reg_0000_id")
    header = header.join(in_force, "reg_0000_id", "left_semi")
    line = line.join(in_force, "reg_0000_id", "left_semi")
    return (
        t["reg_c176"]
        .join(files, "reg_0000_id")
        .join(header, ["reg_c100_id", "reg_0000_id"])
        .join(line, ["reg_c170_id", "reg_0000_id"])
        .select(
            "cnpj",
            period(F.col("dt_ini")).alias("periodo_efd"),
            F.col("data_entrega").alias("data_entrega_efd_periodo"),
            "cod_fin_efd",
            lb.decode(purpose, lb.FILE_PURPOSE, purpose.cast("string")).alias("finalidade_efd"),
            "chave_saida",
            "num_nf_saida",
            "dt_doc_saida",
            "dt_e_s_saida",
            "cod_item",
            "descricao_item",
            "num_item_saida",
            "cfop_saida",
            "unid_saida",
            "qtd_item_saida",
            "vl_total_item",
            "cod_mot_res",
            lb.decode(reason, lb.REFUND_REASON, reason.cast("string")).alias("descricao_motivo_ressarcimento"),
            F.col("chave_nfe_ult").alias("chave_nfe_ultima_entrada"),
            F.col("num_item_ult_e").alias("c176_num_item_ult_e_declarado"),
            ddmmyyyy(F.col("dt_ult_e")).alias("dt_ultima_entrada"),
            F.col("vl_unit_ult_e").alias("vl_unit_bc_st_entrada"),
            own.alias("vl_unit_icms_proprio_entrada"),
            withheld.alias("vl_unit_ressarcimento_st"),
            (F.coalesce(quantity, zero) * F.coalesce(own, zero)).alias("vl_ressarc_credito_proprio"),
            (F.coalesce(quantity, zero) * F.coalesce(withheld, zero)).alias("vl_ressarc_st_retido"),
            F.when(taxed, quantity * withheld + quantity * own)
            .otherwise(quantity * withheld)
            .alias("vr_total_ressarcimento"),
        )
    )


def refund_reconciliation(t: T, p: Params) -> DataFrame:
    """Monthly refunds against the adjustments; months of one side only are kept."""
    files = files_in_force(t, p, by_period=True).select("reg_0000_id", "cnpj", "dt_ini")
    month = F.trunc("dt_ini", "MM").alias("mes_referencia")
    zero = F.lit(0)
    line = t["reg_c170"].select(F.col("id").alias("reg_c170_id"), "reg_0000_id", "qtd")
    header = t["reg_c100"].select(F.col("id").alias("reg_c100_id"), "reg_0000_id")
    refund = t["reg_c176"].select(
        F.col("id").alias("reg_c176_id"),
        "reg_0000_id",
        "reg_c100_id",
        "reg_c170_id",
        "vl_unit_icms_ult_e",
        "vl_unit_res",
    )
    product = lambda name: F.sum(
        (F.coalesce("qtd", zero) * F.coalesce(name, zero)).cast(MEASURE)
    )
    refunds = (
        refund.join(files, "reg_0000_id")
        .join(header, ["reg_c100_id", "reg_0000_id"])
        .join(line, ["reg_c170_id", "reg_0000_id"])
        .groupBy("cnpj", month)
        .agg(
            F.count("reg_c176_id").alias("qtd"),
            product("vl_unit_icms_ult_e").alias("proprio"),
            product("vl_unit_res").alias("retido"),
        )
    )
    code, amount = F.col("cod_aj_apur"), F.col("vl_aj_apur")
    adjusted = (
        t["reg_e111"]
        .join(files, "reg_0000_id")
        .groupBy("cnpj", month)
        .agg(
            conditional_sum(code, OWN_CREDIT_CODES, amount).alias("aj_proprio"),
            conditional_sum(code, WITHHELD_CODES, amount).alias("aj_retido"),
            conditional_sum(code, (OTHER_CREDIT_CODE,), amount).alias("aj_50"),
            conditional_sum(code, (OTHER_WITHHELD_CODE,), amount).alias("aj_48"),
        )
    )
    amounts = ("qtd", "proprio", "retido", "aj_proprio", "aj_retido", "aj_50", "aj_48")
    both = refunds.join(adjusted, ["cnpj", "mes_referencia"], "full").fillna(0, subset=list(amounts))
    return both.select(
        "cnpj",
        period(F.col("mes_referencia"), "MM/yyyy").alias("periodo_efd"),
        F.col("qtd").alias("qtd_itens_analisados_c176"),
        F.col("proprio").alias("total_ressarc_credito_proprio"),
        F.col("aj_proprio").alias("total_ajuste_credito_proprio_e111"),
        (F.col("proprio") - F.col("aj_proprio")).alias("diferenca_credito_proprio"),
        F.col("retido").alias("total_ressarc_st_retido"),
        F.col("aj_retido").alias("total_ajuste_st_retido_e111"),
        (F.col("retido") - F.col("aj_retido")).alias("diferenca_st_retido"),
        F.col("aj_50").alias("total_ajuste_ro020050_e111"),
        F.col("aj_48").alias("total_ajuste_ro020048_e111"),
        "mes_referencia",
    )


def analytic_items(t: T, p: Params) -> DataFrame:
    """Ledger items with every dimension; optional item and document filters."""
    files = files_in_force(t, p, by_period=True)
    header = (
        t["reg_c100"]
        .where(equals_if_given(F.col("chv_nfe"), p.access_key))
        .select(
            F.col("id").alias("reg_c100_id"),
            "reg_0000_id",
            F.col("reg").alias("c100_reg"),
            "cod_sit",
            "ind_oper",
            "ind_emit",
            "chv_nfe",
            "num_doc",
            "cod_part",
            "dt_doc",
            "dt_e_s",
        )
        .join(files, "reg_0000_id")
    )
    cleaned = clean_item_code(F.col("cod_item"))
    lines = (
        t["reg_c170"]
        .withColumn("cod", cleaned)
        .where(equals_if_given(F.col("cod"), p.item_code))
        .withColumnRenamed("reg", "c170_reg")
        .drop("id")
    )
    product = t["reg_0200"].select(
        "reg_0000_id",
        "cod_item",
        "cod_barra",
        "descr_item",
        "tipo_item",
        "cod_gen",
        "cod_ncm",
        "cest",
        "unid_inv",
        F.regexp_extract("cest", "^[0-9]{2}", 0).alias("segmento_cest"),
    )
    nature = t["reg_0400"].select("reg_0000_id", "cod_nat", F.col("descr_nat").alias("descricao_cod_nat"))
    operation = t["dm_cfop"].select(F.col("co_cfop").alias("cfop"), "descricao_cfop")
    situation = t["dm_cst"].select(F.col("co_cst").alias("cst_icms"), F.col("desc_cst").alias("descricao_cst_icms"))
    segment = t["dm_cest_segmento"].select(F.col("cod_segmento").alias("segmento_cest"), "no_segmento")
    genus = F.col("cod_gen")
    return (
        lines.join(header, ["reg_c100_id", "reg_0000_id"])
        .join(product, ["reg_0000_id", "cod_item"], "left")
        .join(nature, ["reg_0000_id", "cod_nat"], "left")
        .join(operation, "cfop", "left")
        # official code lists of a hundred rows, whatever the plan thinks of their size
        .join(F.broadcast(situation), "cst_icms", "left")
        .withColumn("segmento_cest", F.nullif(F.col("segmento_cest"), F.lit("")))
        .join(F.broadcast(segment), "segmento_cest", "left")
        .select(
            "cnpj",
            period(F.col("data_entrega"), "dd/MM/yyyy").alias("dt_ultima_entrega"),
            F.col("cod_fin_efd").alias("cod_fin"),
            lb.decode(F.col("cod_fin_efd"), lb.FILE_PURPOSE_PLAIN, "Outros").alias("descricao_fin"),
            F.year("dt_ini").alias("ano_efd"),
            period(F.col("dt_ini"), "MM/yyyy").alias("periodo_efd"),
            "c100_reg",
            "cod_sit",
            lb.decode(F.col("cod_sit"), lb.DOCUMENT_SITUATION_SHORT, lb.UNKNOWN_CODE).alias("descricao_cod_sit"),
            "ind_oper",
            lb.decode(F.col("ind_oper"), lb.DIRECTION_SHORT).alias("oper"),
            "ind_emit",
            lb.decode(F.col("ind_emit"), lb.ISSUER_SHORT).alias("descricao_ind_emit"),
            "chv_nfe",
            "num_doc",
            "cod_part",
            ddmmyyyy(F.col("dt_doc")).alias("dt_doc"),
            ddmmyyyy(F.col("dt_e_s")).alias("dt_e_s"),
            "c170_reg",
            "num_item",
            "cod_item",
            "cod",
            "cod_barra",
            "descr_item",
            "tipo_item",
            lb.decode(F.col("tipo_item"), lb.ITEM_TYPE, "Tipo Desconhecido").alias("descricao_tipo_item"),
            "cod_gen",
            lb.decode(
                genus, lb.GENUS_SHORT, F.concat(F.lit("Código Genérico "), F.coalesce(genus, F.lit("")))
            ).alias("descricao_cod_gen"),
            "cod_ncm",
            "cest",
            "segmento_cest",
            "no_segmento",
            "cfop",
            "descricao_cfop",
            "cod_nat",
            "descricao_cod_nat",
            "cst_icms",
            "descricao_cst_icms",
            "aliq_icms",
            "ind_mov",
            lb.decode(F.col("ind_mov"), lb.PHYSICAL_MOVEMENT).alias("descricao_ind_mov"),
            "unid_inv",
            "unid",
            "qtd",
            "vl_item",
            "vl_desc",
            "vl_bc_icms",
            "vl_icms",
            "vl_bc_icms_st",
            "aliq_st",
            "vl_icms_st",
            "cst_ipi",
            "cod_enq",
            "vl_bc_ipi",
            "aliq_ipi",
            "vl_ipi",
            "cod_cta",
            "vl_abat_nt",
        )
    )


def file_versions(t: T, p: Params) -> DataFrame:
    """Every submitted version of every file, ranked newest first."""
    files = one_taxpayer(t["reg_0000"], "cnpj", p.cnpj).withColumnRenamed("id", "reg_0000_id")
    ranked = all_versions(files, p.limit)
    lead = ("cnpj", "reg_0000_id", "cod_fin", "dt_ini", "dt_fin", "ind_perfil", "ind_ativ", "data_entrega")
    others = [c for c in files.columns if c not in lead]
    return ranked.select(
        "cnpj",
        "reg_0000_id",
        "cod_fin",
        lb.decode(F.col("cod_fin"), lb.FILE_PURPOSE_LONG, "Outros").alias("finalidade_arquivo"),
        "dt_ini",
        "dt_fin",
        lb.decode(F.col("ind_perfil"), lb.PROFILE, "Outros").alias("ind_perfil"),
        lb.decode(F.col("ind_ativ"), lb.ACTIVITY, "Outros").alias("ind_ativ"),
        *others,
        period(F.col("dt_ini"), "MM/yyyy").alias("periodo_efd"),
        "data_entrega",
        "ordem",
        "qtd_envios",
        F.lit(p.limit).cast("date").alias("data_limite_processamento"),
    )


def _register(t: T, p: Params, name: str) -> DataFrame:
    files = files_in_force(t, p, by_period=True)
    rows = t[name]
    return rows.join(files, "reg_0000_id").select(
        "cnpj",
        period(F.col("dt_ini"), "MM/yyyy").alias("periodo_efd"),
        *rows.columns,
        "cod_fin_efd",
        F.col("data_entrega").alias("data_entrega_efd_periodo"),
    )


def taxpayer_register(t: T, p: Params) -> DataFrame:
    """Register 0005 of the files in force."""
    return _register(t, p, "reg_0005")


def unit_register(t: T, p: Params) -> DataFrame:
    """Register 0190 (units of measure) of the files in force."""
    return _register(t, p, "reg_0190")


def product_register(t: T, p: Params) -> DataFrame:
    """Product master 0200 with its changes (0205) and unit conversions (0220)."""
    changes = t["reg_0205"].select(
        "reg_0000_id",
        "reg_0200_id",
        F.col("cod_ant_item").alias("r0205_cod_ant_item"),
        "descr_ant_item",
        F.col("dt_ini").alias("dt_ini_ant_item"),
        F.col("dt_fim").alias("dt_fim_ant_item"),
    )
    conversions = t["reg_0220"].select("reg_0000_id", "reg_0200_id", "unid_conv", "fat_conv")
    kind = F.col("tipo_item")
    return (
        t["reg_0200"]
        .withColumnRenamed("id", "reg_0200_id")
        .join(files_in_force(t, p, by_period=True), "reg_0000_id")
        .join(changes, ["reg_0200_id", "reg_0000_id"], "left")
        .join(conversions, ["reg_0200_id", "reg_0000_id"], "left")
        .select(
            "cnpj",
            period(F.col("dt_ini"), "MM/yyyy").alias("periodo_efd"),
            "cod_item",
            "cod_ant_item",
            "r0205_cod_ant_item",
            "descr_item",
            "aliq_icms",
            "unid_inv",
            "descr_ant_item",
            "dt_ini_ant_item",
            "dt_fim_ant_item",
            "unid_conv",
            "fat_conv",
            "cod_barra",
            "cod_ncm",
            "cest",
            "tipo_item",
            lb.decode(kind, lb.ITEM_TYPE_NUMBERED, kind).alias("desc_tipo_item"),
            "cod_gen",
            lb.decode(F.col("cod_gen"), lb.GENUS, "Código Desconhecido").alias("descricao_cod_gen"),
            "cod_fin_efd",
            F.col("data_entrega").alias("data_entrega_efd_periodo"),
        )
    )
