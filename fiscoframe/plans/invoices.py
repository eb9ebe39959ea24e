"""Audit queries over invoices, events, pendencies and transport documents."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscoframe.functions import labels as lb
from fiscoframe.functions.keys import digits_only
from fiscoframe.functions.text import read_as_windows_1252
from fiscoframe.functions.values import months_between_2dp, plain_number, yyyymmdd
from fiscoframe.functions.xml import invoice_items
from fiscoframe.operators.predicates import authorised, consumer_or_invoice_model
from fiscoframe.operators.versioning import last_event, last_notification, last_pendency, latest
from fiscoframe.plans.parameters import Params, one_taxpayer
from fiscoframe.schemas import MEASURE
from fiscoframe.session import stage

T = Mapping[str, DataFrame]

# Operation kinds and party roles.
OUT, IN, UNDEFINED = "1 - SAIDA", "0 - ENTRADA", "INDEFINIDO"
ROLES = (
    ("emit_co_cnpj", "Emitente"),
    ("rem_cnpj_cpf", "Remetente"),
    ("dest_cnpj_cpf", "Destinatário"),
    ("co_tomador4_cnpj_cpf", "Tomador"),
)
UNDER_DECLARED = "Débito a Menor na EFD"
# Records left out of the situation history.
EXCLUDED_SITUATIONS = ("030", "150", "005")
EXCLUDED_USERS = ("INTERNET", "P30015AC   ")
REGISTRATION_PAGE = "https://portalcontribuinte.sefin.ro.gov.br/Publico/parametropublica.jsp?NuDevedor="
# Operations that are not sales, by the start of their description.
NOT_A_SALE = ("TRANSF", "RETORN", "ANULA")


def direction(taxpayer: Column) -> Column:
    """Operation seen from the taxpayer: the issuer's kind, reversed for the recipient."""
    kind = F.col("co_tp_nf").cast("string")
    issuer = F.col("co_emitente") == taxpayer
    recipient = F.col("co_destinatario") == taxpayer
    return (
        F.when(issuer & (kind == "1"), OUT)
        .when(issuer & (kind == "0"), IN)
        .when(recipient & (kind == "1"), IN)
        .when(recipient & (kind == "0"), OUT)
        .otherwise(UNDEFINED)
    )


def per_party(df: DataFrame, cnpj: str | None, name: str = "cnpj_filtro") -> DataFrame:
    """Documents of a taxpayer as issuer or recipient.

    For all taxpayers each row is repeated once per different party, so that the
    party is an ordinary equality key and the ``OR`` never reaches a join.
    """
    if cnpj is not None:
        mine = (F.col("co_emitente") == cnpj) | (F.col("co_destinatario") == cnpj)
        return df.where(mine).withColumn(name, F.lit(cnpj))
    parties = F.array_compact(F.array_distinct(F.array("co_emitente", "co_destinatario")))
    return df.withColumn(name, F.explode(parties))


def _item_detail(df: DataFrame, p: Params) -> DataFrame:
    rows = per_party(df, p.cnpj)
    lead = ("co_destinatario", "co_emitente", "cnpj_filtro")
    rest = [c for c in df.columns if c not in lead]
    return rows.select(direction(F.col("cnpj_filtro")).alias("tipo_operacao"), *lead, *rest)


def invoice_detail(t: T, p: Params) -> DataFrame:
    """Invoice items with the operation kind; cancelled documents included."""
    return _item_detail(t["fato_nfe_detalhe"], p)


def retail_invoice_detail(t: T, p: Params) -> DataFrame:
    """Retail invoice items with the operation kind."""
    return _item_detail(t["fato_nfce_detalhe"], p)


def invoice_events(t: T, p: Params) -> DataFrame:
    """Events of the taxpayer's invoices."""
    documents = per_party(
        t["fato_nfe_detalhe"]
        .where(F.col("seq_nitem") == 1)
        .select("chave_acesso", "co_emitente", "co_destinatario"),
        p.cnpj,
        "cnpj",
    ).select("cnpj", "chave_acesso")
    events = t["dm_eventos"].select(
        "chave_acesso", F.col("nsu").alias("nsu_evento"), "evento_dhevento", "evento_tpevento", "evento_descevento"
    )
    return events.join(documents.distinct(), "chave_acesso").distinct().select("cnpj", *events.columns)


def xml_tax_values(t: T, p: Params) -> DataFrame:
    """Substitution-tax values of each item, read from the invoice XML."""
    documents = per_party(
        t["fato_nfe_detalhe"]
        .where(authorised(F.col("infprot_cstat")))
        .select("chave_acesso", "co_emitente", "co_destinatario"),
        p.cnpj,
        "cnpj",
    )
    # one row a document with its parties (two at most for each), so that its XML is joined and read once
    parties = documents.groupBy("chave_acesso").agg(F.collect_set("cnpj").alias("parties"))
    wanted = t["nfe_xml"].join(parties, "chave_acesso")
    values = invoice_items(wanted, "xml", "chave_acesso", "parties")
    own = [c for c in values.columns if c != "parties"]
    return values.select(F.explode("parties").alias("cnpj"), *own)


def sales_to_listed_buyers(t: T, p: Params) -> DataFrame:
    """Sales and tax from normal-regime sellers to the listed buyers."""
    description = F.upper("descricao_cfop")
    sales_codes = t["dm_cfop"].where(
        (F.col("in_vaf") == "X") & F.col("dev_venda").isNull() & F.col("dev_compra").isNull()
    )
    for start in NOT_A_SALE:
        sales_codes = sales_codes.where(~description.startswith(start))
    sellers = (
        t["dm_contribuinte"]
        .where(F.col("co_regime_pagto") == "001")
        .select(F.col("co_cnpj_cpf").alias("co_emitente"), "no_razao_social", "no_fantasia")
    )
    buyers = t["dm_pessoa"].select(
        F.col("co_cnpj_cpf").alias("co_destinatario"), F.col("no_razao_social").alias("no_razao_social_destinatario")
    )
    rows = t["fato_nfe_nfce_sumarizada"].where(
        (F.col("co_uf_emit") == p.home_state)
        & F.col("da_referencia").between(F.lit(p.start).cast("date"), F.lit(p.end).cast("date"))
        & (F.col("co_tp_nf").cast("string") == "1")
    )
    if p.buyers:
        rows = rows.where(F.col("co_destinatario").isin(*p.buyers))
    tax = (F.col("icms_vicms") + F.col("icms_vicmsst")).cast(MEASURE)
    sale = (
        F.col("prod_vprod") + F.col("prod_vfrete") + F.col("prod_vseg") + F.col("prod_voutro") - F.col("prod_vdesc")
    ).cast(MEASURE)
    totals = (
        rows.join(sales_codes.select("co_cfop"), "co_cfop", "left_semi")
        .groupBy("da_referencia", "co_emitente", "co_destinatario")
        .agg(F.sum(tax).alias("icms"), F.sum(sale).alias("venda"))
    )
    return (
        totals.join(sellers, "co_emitente")
        .join(buyers, "co_destinatario", "left")
        .select(
            "da_referencia",
            "co_emitente",
            "no_razao_social",
            "no_fantasia",
            "co_destinatario",
            "no_razao_social_destinatario",
            "icms",
            "venda",
        )
    )


def _ledger_documents(t: T, p: Params) -> DataFrame:
    """Header rows of all valid files, with their taxpayer."""
    owners = one_taxpayer(t["reg_0000"], "cnpj", p.cnpj).select(F.col("id").alias("reg_0000_id"), "cnpj")
    valid = t["dm_efd_arquivo_valido"].select("reg_0000_id")
    return t["reg_c100"].join(owners, "reg_0000_id").join(valid, "reg_0000_id", "left_semi")


def _pendency_status(column: str) -> Column:
    return lb.decode(F.col(column), lb.PENDENCY_STATUS, F.col(column).cast("string"))


def _audit_context(documents: DataFrame, t: T, p: Params, one_row: bool) -> DataFrame:
    """Add pendency, audit type and notification of each document.

    ``one_row`` reduces every context table to its newest row first.
    """
    links = one_taxpayer(t["vw_fisconforme_chave_nota"], "cpf_cnpj", p.cnpj).select(
        F.col("cpf_cnpj").alias("cnpj"), "chave_acesso", "malhas_id", "referencia_malhas_id"
    )
    pendencies = one_taxpayer(t["pendencias"], "cpf_cnpj", p.cnpj).withColumnRenamed("id", "id_pendencia")
    notices = one_taxpayer(t["fato_det_notificacao"], "co_cnpj_notif", p.cnpj)
    if one_row:
        pendencies = last_pendency(pendencies)
        notices = last_notification(notices)
    pendencies = pendencies.select(
        F.col("cpf_cnpj").alias("cnpj"),
        "id_pendencia",
        "malhas_id",
        "referencia_malhas_id",
        "periodo",
        _pendency_status("status").alias("status_pendencia"),
        "data_ciencia",
    )
    notices = notices.select(
        F.col("co_cnpj_notif").alias("cnpj"),
        F.col("id_fisconforme").alias("id_pendencia"),
        "id_notificacao",
        F.col("tp_status").alias("status_notificacao"),
        F.col("dt_envio").alias("data_envio_notificacao"),
        "dt_ciencia",
        F.col("co_cpf_cnpj_ciencia").alias("cnpj_cpf_assinante"),
        F.col("no_pessoa_ciencia").alias("nome_assinante"),
    )
    kinds = t["malhas"].select(F.col("id").alias("malhas_id"), F.col("titulo").alias("titulo_malha"))
    # the context tables meet among themselves first; the documents are moved once, and those
    # without a link never carry null keys into a join
    context = (
        links.join(pendencies, ["cnpj", "malhas_id", "referencia_malhas_id"], "left")
        .join(kinds, "malhas_id", "left")
        .join(notices, ["cnpj", "id_pendencia"], "left")
        .withColumn("data_ciencia_consolidada", F.coalesce("dt_ciencia", "data_ciencia"))
    )
    return documents.join(context, ["cnpj", "chave_acesso"], "left")


_CONTEXT = (
    "id_pendencia",
    "id_notificacao",
    "malhas_id",
    "titulo_malha",
    "periodo",
    "status_pendencia",
    "status_notificacao",
    "data_envio_notificacao",
    "data_ciencia_consolidada",
    "cnpj_cpf_assinante",
    "nome_assinante",
)


def omitted_documents(t: T, p: Params) -> DataFrame:
    """Authorised outgoing documents missing from every ledger file."""
    key = F.col("chave_acesso")
    issued = (
        one_taxpayer(t["fato_nfe_detalhe"], "co_emitente", p.cnpj)
        .where(
            (F.col("co_tp_nf") == 1)
            & (F.col("seq_nitem") == 1)
            & authorised(F.col("infprot_cstat"))
            & consumer_or_invoice_model(key)
        )
        .select(
            F.col("co_emitente").alias("cnpj"),
            "chave_acesso",
            lb.decode(F.substring(key, 21, 2), lb.OMITTED_MODEL, "Saída Omissa").alias("operacao"),
            F.col("ide_serie").alias("serie"),
            "nnf",
            F.col("tot_vnf").alias("valor_nota"),
            F.col("tot_vicms").alias("valor_icms"),
            F.col("dhemi").alias("data_emissao"),
            F.col("infprot_cstat").alias("status_nfe"),
        )
    )
    declared = (
        _ledger_documents(t, p)
        .where(F.col("chv_nfe").isNotNull())
        .select("cnpj", F.col("chv_nfe").alias("chave_acesso"))
    )
    # stored, as both the events below and the result read it: only events of missing documents are ranked
    missing = stage(issued.join(declared, ["cnpj", "chave_acesso"], "left_anti"))
    events = last_event(t["dm_eventos"].join(missing.select("chave_acesso"), "chave_acesso", "left_semi"))
    return (
        _audit_context(missing, t, p, one_row=True)
        .join(events, "chave_acesso", "left")
        .select(
            "cnpj",
            *_CONTEXT,
            "operacao",
            "chave_acesso",
            "serie",
            "nnf",
            "valor_nota",
            "valor_icms",
            "data_emissao",
            "status_nfe",
            F.coalesce("desc_evento", F.lit("SEM EVENTO")).alias("ultimo_evento"),
        )
    )


def audit_pendencies(t: T, p: Params) -> DataFrame:
    """Pendencies with their newest notification; both status columns are returned."""
    notices = t["fato_det_notificacao"].select(
        F.col("id_fisconforme").alias("id_pendencia"),
        "id_notificacao",
        F.col("tp_status").alias("status_notificacao"),
        "dt_ciencia",
    )
    kinds = t["malhas"].select(F.col("id").alias("malhas_id"), F.col("titulo").alias("titulo_malha"))
    joined = (
        one_taxpayer(t["pendencias"], "cpf_cnpj", p.cnpj)
        .withColumnRenamed("id", "id_pendencia")
        .join(notices, "id_pendencia", "left")
        .withColumn("data_ciencia_consolidada", F.coalesce("dt_ciencia", "data_ciencia"))
    )
    newest = latest(
        joined,
        ["id_pendencia"],
        [F.col("data_ciencia_consolidada").desc_nulls_last(), F.col("id_notificacao").desc_nulls_last()],
    )
    return newest.join(kinds, "malhas_id", "left").select(
        F.col("cpf_cnpj").alias("cnpj"),
        "id_pendencia",
        "id_notificacao",
        "malhas_id",
        "titulo_malha",
        "periodo",
        _pendency_status("status").alias("status_pendencia"),
        "status_notificacao",
        "data_ciencia_consolidada",
    )


def _under_declared(t: T, p: Params) -> DataFrame:
    def issued(df: DataFrame, model: str) -> DataFrame:
        return (
            one_taxpayer(df, "co_emitente", p.cnpj)
            .where(authorised(F.col("infprot_cstat")) & (F.col("seq_nitem").cast("string") == "1"))
            .select(
                F.col("co_emitente").alias("cnpj"),
                F.lit(model).alias("modelo"),
                "chave_acesso",
                F.col("ide_serie").alias("serie"),
                F.col("nnf").alias("num_doc"),
                F.col("dhemi").alias("data_emissao"),
                F.col("tot_vnf").alias("valor_total_nfe"),
                F.col("tot_vicms").alias("icms_destacado_nfe"),
            )
        )

    invoices = issued(t["fato_nfe_detalhe"].where(F.col("co_tp_nf") == 1), "NF-e (Mod 55)")
    retail = issued(t["fato_nfce_detalhe"], "NFC-e (Mod 65)")
    declared = (
        _ledger_documents(t, p)
        .where(F.col("ind_oper") == "1")
        .select(
            "cnpj",
            F.col("chv_nfe").alias("chave_acesso"),
            F.coalesce("vl_icms", F.lit(0)).alias("icms_escriturado_efd"),
        )
    )
    return (
        invoices.unionByName(retail)
        .join(declared, ["cnpj", "chave_acesso"])
        .where(F.col("icms_escriturado_efd") < F.col("icms_destacado_nfe"))
        .withColumn("diferenca_icms_nao_debitado", F.col("icms_destacado_nfe") - F.col("icms_escriturado_efd"))
        .withColumn("status_auditoria", F.lit(UNDER_DECLARED))
    )


_UNDER_DECLARED = (
    "modelo",
    "chave_acesso",
    "serie",
    "num_doc",
    "data_emissao",
    "valor_total_nfe",
    "icms_destacado_nfe",
    "icms_escriturado_efd",
    "diferenca_icms_nao_debitado",
    "status_auditoria",
)


def under_declared(t: T, p: Params) -> DataFrame:
    """Documents whose ledger tax is below the invoice tax."""
    return _under_declared(t, p).select("cnpj", *_UNDER_DECLARED)


def under_declared_with_context(t: T, p: Params) -> DataFrame:
    """The same with every pendency and notification (several rows per document)."""
    return _audit_context(_under_declared(t, p), t, p, one_row=False).select("cnpj", *_CONTEXT, *_UNDER_DECLARED)


def transport_documents(t: T, p: Params) -> DataFrame:
    """Transport documents once per taxpayer, under its first role.

    A later role needs every earlier party to be known and different, as an
    unknown earlier party cannot be told apart from the taxpayer.
    """
    df = t["fato_cte_detalhe"]
    candidates = []
    for i, (column, label) in enumerate(ROLES):
        party = digits_only(F.col(column))
        condition = party.isNotNull()
        for earlier, _ in ROLES[:i]:
            condition = condition & F.coalesce(digits_only(F.col(earlier)) != party, F.lit(False))
        if p.cnpj is not None:
            condition = condition & (party == digits_only(F.trim(F.lit(p.cnpj))))
        candidates.append(F.when(condition, F.struct(party.alias("cnpj"), F.lit(label).alias("papel"))))
    roles = F.explode(F.array_compact(F.array(*candidates))).alias("__role")
    return df.select("*", roles).select(
        F.col("__role.cnpj").alias("cnpj"),
        lb.decode(F.col("co_tomador3"), lb.TRANSPORT_PAYER, "Outros").alias("tipo_tomador"),
        F.col("__role.papel").alias("papel_cnpj_filtrado"),
        *df.columns,
    )


def taxpayer_data(t: T, p: Params) -> DataFrame:
    """Registration data and months of activity."""
    places = t["dm_localidade"].select("co_municipio", F.col("no_municipio").alias("municipio"), F.col("co_uf").alias("uf"))
    regimes = t["dm_regime_pagto_descricao"].select(
        F.col("co_regime_pagamento").alias("co_regime_pagto"), "no_regime_pagamento"
    )
    situations = t["dm_situacao_contribuinte"].select(
        F.col("co_situacao_contribuinte").alias("in_situacao"),
        F.col("no_situacao_contribuinte").alias("desc_situacao"),
    )
    history = (
        t["sitafe_historico_gr_situacao"]
        .where(~F.col("it_co_situacao_contribuinte").isin(*EXCLUDED_SITUATIONS))
        .join(t["sitafe_historico_situacao"].where(~F.col("it_co_usuario").isin(*EXCLUDED_USERS)), "tuk")
        .groupBy(F.col("it_nu_inscricao_estadual").alias("co_cad_icms"))
        .agg(F.max("it_da_transacao").alias("data_ult_sit"))
    )
    changed = yyyymmdd(F.col("data_ult_sit"))
    end = F.when(F.col("in_situacao") == "001", F.lit(p.today).cast("date")).otherwise(changed)
    months = months_between_2dp(end, F.col("da_inicio_atividade"))
    text = lambda name: F.coalesce(F.col(name), F.lit(""))
    # labels of all situations but the active one are converted from the code page
    label = F.col("desc_situacao")
    situation = F.when(F.col("in_situacao") == "001", label).otherwise(read_as_windows_1252(label))
    return (
        one_taxpayer(t["dm_pessoa"], "co_cnpj_cpf", p.cnpj)
        .join(places, "co_municipio", "left")
        .join(regimes, "co_regime_pagto", "left")
        .join(situations, "in_situacao", "left")
        .join(history, "co_cad_icms", "left")
        .select(
            F.col("co_cnpj_cpf").alias("cnpj"),
            F.col("co_cad_icms").alias("ie"),
            F.col("no_razao_social").alias("nome"),
            F.col("no_fantasia").alias("nome_fantasia"),
            F.concat(text("desc_endereco"), F.lit(" "), text("bairro")).alias("endereco"),
            "municipio",
            "uf",
            F.concat(text("co_regime_pagto"), F.lit(" - "), text("no_regime_pagamento")).alias("regime_de_pagamento"),
            F.concat(text("in_situacao"), F.lit(" - "), F.coalesce(situation, F.lit(""))).alias("situacao_da_ie"),
            F.col("da_inicio_atividade").alias("data_de_inicio_da_atividade"),
            changed.alias("data_da_ultima_situacao"),
            F.concat(F.coalesce(plain_number(months), F.lit("")), F.lit(" meses")).alias("periodo_em_atividade"),
            F.concat(F.lit(REGISTRATION_PAGE), text("co_cad_icms")).alias("redesim"),
        )
    )
