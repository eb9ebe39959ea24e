"""Projections, filters and predicates (B)."""

from __future__ import annotations

from pyspark.sql import functions as F

from fiscoframe.checks import check, dbl
from fiscoframe.functions import labels as lb
from fiscoframe.functions.keys import is_valid_cnpj, sanitize_cnpj
from fiscoframe.operators.flags import Rule, with_flags
from fiscoframe.operators.predicates import (
    Condition,
    apply_filters,
    authorised,
    between_dates,
    consumer_or_invoice_model,
    equals_if_given,
    not_blank,
    search_everywhere,
    visible,
    with_quick_filters,
)
from fiscoframe.plans.invoices import direction, per_party
from fiscoframe.plans.items import normalize_items
from fiscoframe.schemas import TRANSACTION, conform


def _filter(name, table, columns, condition, where):
    keys = ", ".join(columns)

    @check(name, f"SELECT {keys} FROM {table} WHERE {where}")
    def build(t):
        return apply_filters(t[table], [condition]).select(*columns)

    return build


_filter("B01_contains", "part", ["p_partkey", "p_name"], Condition("p_name", "contém", "RiN"), "contains(lower(p_name), 'rin')")
_filter("B02_equals", "part", ["p_partkey", "p_name"], Condition("p_size", "igual", "15"), "CAST(p_size AS VARCHAR) = '15'")
_filter("B03_starts_with", "part", ["p_partkey", "p_name"], Condition("p_name", "começa com", "SMALL"), "starts_with(lower(p_name), 'small')")
_filter("B04_ends_with", "part", ["p_partkey", "p_name"], Condition("p_name", "termina com", "Ring"), "suffix(lower(p_name), 'ring')")
_filter("B07_greater_than", "customer", ["c_custkey", "c_name"], Condition("c_acctbal", ">", "1234,5"), "c_acctbal > 1234.5")
_filter("B07_unparsable_cells", "customer", ["c_custkey", "c_name"], Condition("c_name", "<=", "10"), "TRY_CAST(c_name AS DOUBLE) <= 10")
_filter("B08_numeric_operator_on_text", "part", ["p_partkey", "p_type"], Condition("p_type", ">", "PROMO"), "p_type = 'PROMO'")
_filter("B08_unknown_operator", "part", ["p_partkey", "p_type"], Condition("p_type", "parecido", "LARGE"), "p_type = 'LARGE'")

_NULLABLE = "CASE WHEN p_size > 40 THEN NULL WHEN p_size > 30 THEN '' ELSE p_name END"


def _with_nullable(t):
    return t["part"].withColumn("texto", F.expr(_NULLABLE))


@check("B05_is_null", f"SELECT p_partkey FROM part WHERE coalesce({_NULLABLE}, '') = ''")
def b05(t):
    return apply_filters(_with_nullable(t), [Condition("texto", "é nulo")]).select("p_partkey")


@check("B06_is_not_null", f"SELECT p_partkey FROM part WHERE coalesce({_NULLABLE}, '') <> ''")
def b06(t):
    return apply_filters(_with_nullable(t), [Condition("texto", "não é nulo")]).select("p_partkey")


@check(
    "B09_all_conditions",
    "SELECT p_partkey, p_name, p_size FROM part WHERE contains(lower(p_name), 'a') AND p_size >= 10 AND p_size < 40",
)
def b09(t):
    conditions = [
        Condition("p_name", "contém", "A"),
        Condition("p_size", ">=", "10"),
        Condition("p_size", "<", "40"),
        Condition("", "igual", "ignored"),
        Condition("p_brand", "igual", ""),
    ]
    return apply_filters(t["part"], conditions).select("p_partkey", "p_name", "p_size")


@check("B10_visible_columns", "SELECT p_name, p_partkey FROM part")
def b10(t):
    return visible(t["part"], ["p_name", "missing", "p_partkey"])


@check(
    "B11_search_everywhere",
    """SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE contains(lower(CAST(n_nationkey AS VARCHAR)), '1')
       OR contains(lower(n_name), '1') OR contains(lower(CAST(n_regionkey AS VARCHAR)), '1')""",
)
def b11(t):
    return search_everywhere(t["nation"], " 1 ")


@check(
    "B12_quick_filters",
    "SELECT p_partkey FROM part WHERE contains(lower(p_name), 'ring') AND (contains(lower(p_brand), '#1') OR contains(lower(p_type), '#1'))",
)
def b12(t):
    df = t["part"].select("p_partkey", F.col("p_name").alias("descricao"), F.array("p_brand", "p_type").alias("lista_ncm"))
    old = [Condition("lista_ncm", "contém", "zzz", quick=True)]
    return apply_filters(df, with_quick_filters(df, old, {"descricao": "Ring", "ncm_padrao": "#1"})).select("p_partkey")


@check(
    "B13_optional_parameter",
    "SELECT o_orderkey, 'all' AS kind FROM orders UNION ALL SELECT o_orderkey, 'one' FROM orders WHERE o_custkey = 11",
)
def b13(t):
    rows = lambda value, kind: t["orders"].where(equals_if_given(F.col("o_custkey"), value)).select(
        "o_orderkey", F.lit(kind).alias("kind")
    )
    return rows(None, "all").unionByName(rows(11, "one"))


@check(
    "B14_date_range",
    """SELECT id, 'open' AS kind FROM {reg_0000} WHERE dt_ini BETWEEN DATE '1900-01-01' AND DATE '1998-06-30'
       UNION ALL SELECT id, 'closed' FROM {reg_0000} WHERE dt_ini BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'""",
)
def b14(t):
    files = t["reg_0000"]
    rows = lambda kind, *a: files.where(between_dates(F.col("dt_ini"), *a)).select("id", F.lit(kind).alias("kind"))
    return rows("open", None, None, "1998-06-30").unionByName(rows("closed", "1997-01-01", "1997-12-31"))


@check(
    "B15_authorised_documents",
    """SELECT chave_acesso, infprot_cstat FROM {invoice_lines} WHERE infprot_cstat IN ('100', '150') AND seq_nitem = 1
       AND substr(chave_acesso, 21, 2) IN ('55', '65')""",
)
def b15(t):
    keep = authorised(F.col("infprot_cstat")) & (F.col("seq_nitem") == 1) & consumer_or_invoice_model(F.col("chave_acesso"))
    return t["invoice_lines"].where(keep).select("chave_acesso", "infprot_cstat")


@check(
    "B16_party_of_documents",
    """SELECT chave_acesso, seq_nitem, co_emitente AS cnpj_filtro FROM {fato_nfce_detalhe}
       UNION ALL SELECT chave_acesso, seq_nitem, co_destinatario FROM {fato_nfce_detalhe} WHERE co_destinatario <> co_emitente""",
)
def b16(t):
    return per_party(t["fato_nfce_detalhe"], None).select("chave_acesso", "seq_nitem", "cnpj_filtro")


@check(
    "B17_direction",
    """SELECT chave_acesso, seq_nitem, p AS cnpj_filtro, CASE WHEN co_emitente = p AND co_tp_nf = 1 THEN '1 - SAIDA'
         WHEN co_emitente = p THEN '0 - ENTRADA' WHEN co_tp_nf = 1 THEN '0 - ENTRADA' ELSE '1 - SAIDA' END AS tipo_operacao
       FROM (SELECT *, co_emitente AS p FROM {fato_nfe_detalhe} UNION ALL
             SELECT *, co_destinatario FROM {fato_nfe_detalhe} WHERE co_destinatario <> co_emitente)""",
)
def b17(t):
    rows = per_party(t["fato_nfe_detalhe"], None)
    return rows.select("chave_acesso", "seq_nitem", "cnpj_filtro", direction(F.col("cnpj_filtro")).alias("tipo_operacao"))


_DECODES = {
    "cod_sit": (lb.DOCUMENT_SITUATION, "'Código desconhecido'"),
    "ind_oper": (lb.DIRECTION, "NULL"),
    "ind_emit": (lb.ISSUER, "'Não informado'"),
    "ind_pgto": (lb.PAYMENT, "NULL"),
    "ind_frt": (lb.FREIGHT, "NULL"),
}


@check(
    "B18_document_labels",
    "SELECT id, " + ", ".join(f"{lb.decode_sql(c, m, d)} AS {c}" for c, (m, d) in _DECODES.items()) + " FROM {reg_c100}",
)
def b18(t):
    def label(c, table, default):
        return lb.decode(F.col(c), table, None if default == "NULL" else default.strip("'")).alias(c)

    return t["reg_c100"].select("id", *[label(c, m, d) for c, (m, d) in _DECODES.items()])


@check(
    "B18_product_labels",
    f"""SELECT id, {lb.decode_sql("tipo_item", lb.ITEM_TYPE_NUMBERED, "tipo_item")} AS tipo,
          {lb.decode_sql("cod_gen", lb.GENUS, "'Código Desconhecido'")} AS genero FROM {{reg_0200}}""",
)
def b18_product(t):
    kind = F.col("tipo_item")
    return t["reg_0200"].select(
        "id",
        lb.decode(kind, lb.ITEM_TYPE_NUMBERED, kind).alias("tipo"),
        lb.decode(F.col("cod_gen"), lb.GENUS, "Código Desconhecido").alias("genero"),
    )


_OTHER_DECODES = {
    "finalidade": ("CAST(o_orderkey % 3 AS STRING)", lb.FILE_PURPOSE_LONG, "'Outros'"),
    "inventario": ("lpad(CAST(o_orderkey % 8 AS STRING), 2, '0')", lb.INVENTORY_REASON, "NULL"),
    "ressarcimento": ("CAST(o_orderkey % 10 AS STRING)", lb.REFUND_REASON, "NULL"),
    "pendencia": ("CAST(o_orderkey % 14 AS STRING)", lb.PENDENCY_STATUS, "'outra'"),
    "lancamento": ("lpad(CAST(o_orderkey % 70 AS STRING), 2, '0')", lb.LAUNCH_STATUS, "'VERIFICAR'"),
    "perfil": ("substr('ABCD', CAST(o_orderkey % 4 AS INT) + 1, 1)", lb.PROFILE, "'Outros'"),
    "atividade": ("CAST(o_orderkey % 3 AS STRING)", lb.ACTIVITY, "'Outros'"),
    "movimento": ("CAST(o_orderkey % 3 AS STRING)", lb.PHYSICAL_MOVEMENT, "NULL"),
    "tomador": ("CAST(o_orderkey % 6 AS STRING)", lb.TRANSPORT_PAYER, "'Outros'"),
    "modelo": ("CAST(o_orderkey % 10 + 55 AS STRING)", lb.OMITTED_MODEL, "'Saída Omissa'"),
}


@check(
    "B18_other_labels",
    "SELECT o_orderkey, " + ", ".join(f"{lb.decode_sql(e, m, d)} AS {n}" for n, (e, m, d) in _OTHER_DECODES.items()) + " FROM orders",
)
def b18_other(t):
    columns = [
        lb.decode(F.expr(e), m, None if d == "NULL" else d.strip("'")).alias(n) for n, (e, m, d) in _OTHER_DECODES.items()
    ]
    return t["orders"].select("o_orderkey", *columns)


@check("B19_not_blank", f"SELECT p_partkey FROM part WHERE {_NULLABLE} IS NOT NULL AND {_NULLABLE} <> ''")
def b19(t):
    return _with_nullable(t).where(not_blank(F.col("texto"))).select("p_partkey")


@check(
    "B20_review_flags",
    """SELECT id, reg_c100_id, concat_ws('; ', CASE WHEN qtd > 40 THEN 'greater_than:qtd' END, CASE WHEN descr_compl <> '' THEN 'not_blank:descr_compl' END,
         CASE WHEN unid = 'R' THEN 'equals:unid' END, CASE WHEN aliq_icms <> 0 THEN 'not_equal_zero:aliq_icms' END,
         CASE WHEN vl_icms < qtd THEN 'compare_columns:vl_icms' END) AS alertas FROM {reg_c170}""",
)
def b20(t):
    rules = [
        Rule("greater_than", "qtd", 40),
        Rule("not_blank", "descr_compl"),
        Rule("equals", "unid", "R"),
        Rule("not_equal_zero", "aliq_icms"),
        Rule("compare_columns", "vl_icms", "<", "qtd"),
        Rule("boolean_true", "absent"),
    ]
    return with_flags(t["reg_c170"], rules).select("id", "reg_c100_id", "alertas")


_CNPJ = "lpad(CAST(o_orderkey * 7919 AS STRING), 14, '0')"
_CNPJ_DUCK = "lpad(CAST(o_orderkey * 7919 AS VARCHAR), 14, '0')"


def _digit_sql(weights, length):
    terms = " + ".join(f"CAST(substr(c, {i + 1}, 1) AS INTEGER) * {w}" for i, w in enumerate(weights))
    return f"(CASE WHEN ({terms}) % 11 < 2 THEN 0 ELSE 11 - ({terms}) % 11 END)"


@check(
    "B21_valid_cnpj",
    f"""SELECT o_orderkey, {_digit_sql((5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2), 12)} = CAST(substr(c, 13, 1) AS INTEGER)
          AND {_digit_sql((6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2), 13)} = CAST(substr(c, 14, 1) AS INTEGER)
          AND c <> repeat(substr(c, 1, 1), 14) AS valido
        FROM (SELECT o_orderkey, {_CNPJ_DUCK} AS c FROM orders)""",
)
def b21(t):
    dotted = F.expr(f"concat(substr({_CNPJ}, 1, 2), '.', substr({_CNPJ}, 3, 10), '-', substr({_CNPJ}, 13, 2))")
    return t["orders"].select("o_orderkey", is_valid_cnpj(dotted).alias("valido"))


@check(
    "B22_sanitize_cnpj",
    "SELECT c_custkey, CASE WHEN length(regexp_replace(c_name, '[^0-9]', '', 'g')) = 14 THEN regexp_replace(c_name, '[^0-9]', '', 'g') END AS cnpj "
    "FROM (SELECT c_custkey, CASE WHEN c_nationkey < 12 THEN concat('12.345/', c_name) ELSE c_name END AS c_name FROM customer)",
)
def b22(t):
    raw = F.when(F.col("c_nationkey") < 12, F.concat(F.lit("12.345/"), "c_name")).otherwise(F.col("c_name"))
    return t["customer"].select("c_custkey", sanitize_cnpj(raw).alias("cnpj"))


@check(
    "B23_conformed_rows",
    """SELECT CAST(p_partkey AS VARCHAR) AS codigo, CAST(NULL AS VARCHAR) AS gtin, 'X' AS fonte,
         CAST(coalesce(TRY_CAST(CASE WHEN p_size > 30 THEN 'n/d' ELSE CAST(p_size AS VARCHAR) END AS DECIMAL(18,6)), 0) AS DOUBLE) AS valor_saida
       FROM part""",
)
def b23(t):
    from fiscoframe.schemas import measure

    raw = F.when(F.col("p_size") > 30, "n/d").otherwise(F.col("p_size").cast("string"))
    rows = t["part"].select(F.col("p_partkey").alias("codigo"), measure(raw).alias("valor_saida"), F.lit("X").alias("fonte"))
    return conform(rows, TRANSACTION).select("codigo", "gtin", "fonte", "valor_saida")


@check(
    "B24_renamed_and_reordered",
    "SELECT codigo, CASE WHEN ltrim(codigo, '0') = '' THEN '0' ELSE ltrim(codigo, '0') END AS cod_normalizado FROM (SELECT lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS codigo FROM part)",
)
def b24(t):
    rows = t["part"].select(F.lpad(F.col("p_partkey").cast("string"), 6, "0").alias("codigo"))
    return normalize_items(rows)


@check(
    "B25_arithmetic_projections",
    f"""SELECT id, {dbl("a.total")}, {dbl("a.ressarc")}, {dbl("a.pago")} FROM (SELECT id, vl_item + coalesce(vl_icms, 0) - vl_desc AS total,
          coalesce(qtd, 0) * coalesce(aliq_icms, 0) AS ressarc, CASE WHEN descr_compl IS NULL THEN 0 ELSE vl_item END AS pago FROM {{reg_c170}}) a""",
)
def b25(t):
    zero = F.lit(0)
    return t["reg_c170"].select(
        "id",
        (F.col("vl_item") + F.coalesce("vl_icms", zero) - F.col("vl_desc")).alias("total"),
        (F.coalesce("qtd", zero) * F.coalesce("aliq_icms", zero)).alias("ressarc"),
        F.when(F.col("descr_compl").isNull(), zero).otherwise(F.col("vl_item")).alias("pago"),
    )
