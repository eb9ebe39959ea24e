"""Border-tax queries: incoming interstate invoices against the tax launches."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscoframe.functions import labels as lb
from fiscoframe.functions.values import yyyymmdd
from fiscoframe.operators.predicates import authorised
from fiscoframe.plans.invoices import direction, per_party
from fiscoframe.plans.parameters import Params, one_taxpayer

T = Mapping[str, DataFrame]

# Goods attributes returned with each launch.
GOODS_ATTRIBUTES = (
    "it_pc_aliquota_interna",
    "it_pc_aliquota_origem",
    "it_convenio",
    "it_pc_agregacao_interna",
    "it_in_pgto_saida",
    "it_boletim_pauta",
    "it_in_isento_icms",
    "it_passe_fiscal",
    "it_in_combustivel",
    "it_in_produto_st",
    "it_in_cest_st",
    "it_pc_interna",
)


def border_items(t: T, p: Params) -> DataFrame:
    """Invoice items with the border tax computed for them."""
    computed = t["sitafe_nfe_calculo_item"].select(
        F.col("it_nu_chave_acesso").alias("chave_acesso"),
        F.col("it_nu_item").alias("seq_nitem"),
        F.col("it_co_sefin").alias("co_sefin"),
        F.col("it_co_rotina_calculo").alias("cod_rotina_calculo"),
        F.col("it_vl_icms").alias("valor_icms_fronteira"),
    )
    items = t["fato_nfe_detalhe"].where(F.col("dhemi") <= F.lit(p.limit).cast("date"))
    matched = items.select(
        "co_emitente",
        "co_destinatario",
        "co_tp_nf",
        "chave_acesso",
        "seq_nitem",
        F.col("prod_cprod").alias("cod_item"),
        F.col("prod_xprod").alias("desc_item"),
        F.col("prod_ncm").alias("ncm"),
        F.col("prod_cest").alias("cest"),
        F.col("prod_qcom").alias("qtd_comercial"),
        F.col("prod_vprod").alias("valor_produto"),
        F.col("icms_vbcst").alias("bc_icms_st_destacado"),
        F.col("icms_vicmsst").alias("icms_st_destacado"),
    ).join(computed, ["chave_acesso", "seq_nitem"])
    return per_party(matched, p.cnpj, "cnpj").select(
        "cnpj",
        direction(F.col("cnpj")).alias("tipo_operacao"),
        "chave_acesso",
        F.col("seq_nitem").alias("num_item"),
        "cod_item",
        "desc_item",
        "ncm",
        "cest",
        "qtd_comercial",
        "valor_produto",
        "bc_icms_st_destacado",
        "icms_st_destacado",
        "co_sefin",
        "cod_rotina_calculo",
        "valor_icms_fronteira",
    )


def launch_status(code: Column) -> Column:
    return F.when(code.isNull(), F.lit(" ")).otherwise(lb.decode(code, lb.LAUNCH_STATUS, "VERIFICAR"))


def border_analysis(t: T, p: Params) -> DataFrame:
    """Interstate purchases joined to their launches, goods and payments.

    Launch items join by product code, not by item number, as the source does, so
    repeated codes in one document multiply.
    """
    origin = (
        one_taxpayer(t["fato_nfe_detalhe"], "co_destinatario", p.cnpj)
        .where(
            (F.col("co_tp_nf") == 1)
            & (F.col("co_uf_emit") != p.home_state)
            & authorised(F.col("infprot_cstat"))
        )
        .groupBy(F.col("chave_acesso").alias("chave"), F.col("co_destinatario").alias("cnpj"))
        .agg(
            F.max("nnf").alias("nota"),
            F.max("co_emitente").alias("cnpj_emit"),
            F.max("xnome_emit").alias("nome_emit"),
            F.max("co_uf_emit").alias("uf_emitente"),
            F.max("dhemi").alias("emissao"),
        )
    )
    note = one_taxpayer(t["sitafe_nota_fiscal"], "it_nucnpj_cpf_destino_nf", p.cnpj).select(
        F.col("it_nu_identificao_nf_e").alias("chave"),
        "it_nu_identificacao_nf",
        F.col("it_nucnpj_cpf_destino_nf").alias("cnpj"),
    )
    entry = one_taxpayer(t["sitafe_nf_lancamento"], "it_nu_cnpj_cpf_destino_nf", p.cnpj).select(
        "it_nu_identificacao_nf",
        F.col("it_nu_cnpj_cpf_destino_nf").alias("cnpj"),
        yyyymmdd(F.col("it_da_entrada")).alias("entrada"),
        F.col("it_co_comando").alias("comando"),
        F.col("it_nu_guia_lancamento").alias("guia"),
        "it_nu_identificacao_ndf",
    )
    item = t["sitafe_nfe_item"].select(
        F.col("it_nu_chave_acesso").alias("chave"),
        F.col("it_nu_item").alias("prod_nitem"),
        F.col("it_no_produto").alias("prod_xprod"),
        F.col("it_co_cfop").alias("co_cfop"),
        F.col("it_co_ncm").alias("ncm"),
        F.col("it_un_comercial").alias("prod_ucom"),
        F.col("it_qt_comercial").alias("prod_qcom"),
        F.col("it_va_unitario_com").alias("prod_vuncom"),
        F.col("it_va_produto").alias("prod_vprod"),
        F.col("it_va_frete").alias("prod_vfrete"),
        F.col("it_va_desconto").alias("prod_vdesc"),
        F.col("it_va_outro").alias("prod_voutro"),
        F.col("it_va_seguro").alias("prod_vseg"),
        F.col("it_va_bc").alias("icms_vbc"),
        F.col("it_pc_icms").alias("icms_picms"),
        F.col("it_va_icms").alias("icms_vicms"),
        F.col("it_va_bc_st").alias("icms_vbcst"),
        F.col("it_va_icms_st").alias("icms_vicmsst"),
        F.col("it_co_sefin").alias("co_sefin"),
    )
    launch = t["sitafe_lancamento"].select(
        F.col("it_nu_guia_lancamento").alias("guia"),
        F.col("it_co_receita").alias("receita"),
        F.col("it_va_principal_original").alias("valor_devido"),
        F.when(F.col("it_co_receita").isNull(), F.lit(0))
        .otherwise(F.col("it_va_total_pgto_efetuado"))
        .alias("valor_pago"),
        launch_status(F.col("it_co_situacao_lancamento")).alias("situacao"),
    )
    launch_item = t["sitafe_lancamento_item"].select(
        "it_nu_identificacao_ndf",
        F.col("it_co_produto").alias("co_sefin"),
        F.col("it_vl_merc_item").alias("vl_merc"),
        F.col("it_vl_merc_bc_item").alias("vl_bc_merc"),
        F.col("it_aliq_item").alias("aliq"),
        F.col("it_vl_tot_debito_item").alias("vl_tot_deb"),
        F.col("it_vl_credito_rateio").alias("vl_tot_cred"),
        F.col("it_vl_icms_recolher").alias("vl_icms"),
    )
    goods = t["sitafe_mercadoria"].select(F.col("it_co_sefin").alias("co_sefin"), *GOODS_ATTRIBUTES)
    names = t["sitafe_produto_sefin"].select(
        F.col("it_co_sefin").alias("co_sefin"), F.col("it_no_produto").alias("nome_co_sefin")
    )
    total = (
        F.col("prod_vprod") + F.col("prod_vfrete") - F.col("prod_vdesc") + F.col("prod_voutro") + F.col("prod_vseg")
    )
    return (
        origin.join(note, ["chave", "cnpj"])
        .join(entry, ["it_nu_identificacao_nf", "cnpj"])
        .join(launch, "guia")
        .join(item, "chave")
        .join(launch_item, ["it_nu_identificacao_ndf", "co_sefin"])
        .join(goods, "co_sefin")
        .join(names, "co_sefin", "left")
        .select(
            "cnpj",
            "chave",
            "nota",
            "cnpj_emit",
            "nome_emit",
            "uf_emitente",
            "emissao",
            "entrada",
            "comando",
            "prod_nitem",
            "prod_xprod",
            "co_cfop",
            "ncm",
            "prod_ucom",
            "prod_qcom",
            "prod_vuncom",
            "prod_vprod",
            "prod_vfrete",
            "prod_vdesc",
            "prod_voutro",
            "prod_vseg",
            total.alias("total_produto"),
            "icms_vbc",
            "icms_picms",
            "icms_vicms",
            "icms_vbcst",
            "icms_vicmsst",
            "receita",
            "guia",
            "valor_devido",
            "valor_pago",
            "situacao",
            "co_sefin",
            "nome_co_sefin",
            "vl_merc",
            "vl_bc_merc",
            "aliq",
            "vl_tot_deb",
            "vl_tot_cred",
            "vl_icms",
            *GOODS_ATTRIBUTES,
        )
    )
