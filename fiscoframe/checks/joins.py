"""Joins (C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from fiscoframe.checks import check, dbl
from fiscoframe.functions.text import bare_key
from fiscoframe.operators.lookup import classify, classify_goods, dated_attributes, reference_date
from fiscoframe.operators.predicates import equals_if_given
from fiscoframe.operators.sets import without
from fiscoframe.operators.versioning import valid_files
from fiscoframe.plans import units
from fiscoframe.plans.parameters import one_taxpayer
from fiscoframe.sources.readers import only_cfop
from fiscoframe.sources.reference import classification_tables, marked_cfop


@check(
    "C01_inner_join_composite_key",
    f"""SELECT i.id, c.chv_nfe, {dbl("i.vl_item")} FROM {{reg_c170}} i JOIN {{reg_c100}} c
        ON c.id = i.reg_c100_id AND c.reg_0000_id = i.reg_0000_id""",
)
def c01(t):
    header = t["reg_c100"].select(F.col("id").alias("reg_c100_id"), "reg_0000_id", "chv_nfe")
    return t["reg_c170"].join(header, ["reg_c100_id", "reg_0000_id"]).select("id", "chv_nfe", "vl_item")


@check(
    "C02_left_join",
    """SELECT i.id, p.descr_item FROM {reg_c170} i LEFT JOIN {reg_0200} p
       ON p.reg_0000_id = i.reg_0000_id AND p.cod_item = i.cod_item""",
)
def c02(t):
    product = t["reg_0200"].select("reg_0000_id", "cod_item", "descr_item")
    return t["reg_c170"].join(product, ["reg_0000_id", "cod_item"], "left").select("id", "descr_item")


@check(
    "C03_full_join_coalesced_keys",
    """SELECT coalesce(a.k, b.k) AS k, coalesce(a.n, 0) AS n_a, coalesce(b.n, 0) AS n_r FROM
       (SELECT l_orderkey AS k, count(*) AS n FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1) a FULL JOIN
       (SELECT l_orderkey AS k, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) b ON a.k = b.k""",
)
def c03(t):
    def side(flag, name):
        return t["lineitem"].where(F.col("l_returnflag") == flag).groupBy(F.col("l_orderkey").alias("k")).agg(
            F.count(F.lit(1)).alias(name)
        )

    return side("A", "n_a").join(side("R", "n_r"), "k", "full").fillna(0, ["n_a", "n_r"])


@check(
    "C04_semi_join",
    """SELECT id, cfop FROM {reg_c170} WHERE cfop IN (SELECT co_cfop FROM {dm_cfop} WHERE operacao_mercantil = 'X')""",
)
def c04(t):
    return only_cfop(t["reg_c170"], marked_cfop(t["dm_cfop"])).select("id", "cfop")


@check(
    "C05_anti_join",
    "SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
)
def c05(t):
    lines = t["lineitem"].select(F.col("l_orderkey").alias("o_orderkey"))
    return t["orders"].join(lines, "o_orderkey", "left_anti").select("o_orderkey", "o_custkey")


@check(
    "C06_anti_join_text_key",
    """SELECT p_partkey, p_name, p_type FROM part WHERE NOT EXISTS (SELECT 1 FROM part q WHERE q.p_size > 45
         AND coalesce(q.p_name, '') = coalesce(part.p_name, '')
         AND (CASE WHEN q.p_type = 'PROMO' THEN '' ELSE q.p_type END) = (CASE WHEN part.p_type = 'PROMO' THEN '' ELSE part.p_type END))""",
)
def c06(t):
    kind = F.when(F.col("p_type") != "PROMO", F.col("p_type"))
    rows = t["part"].withColumn("kind", kind)
    return without(rows, rows.where("p_size > 45"), ["p_name", "kind"]).select("p_partkey", "p_name", "p_type")


@check(
    "C07_filter_join_without_fan_out",
    "SELECT id, cfop FROM {reg_c170} WHERE cfop IN (SELECT co_cfop FROM {dm_cfop})",
)
def c07(t):
    repeated = t["dm_cfop"].select("co_cfop").unionByName(t["dm_cfop"].select("co_cfop"))
    return only_cfop(t["reg_c170"], repeated).select("id", "cfop")


@check(
    "C08_parameter_table",
    """SELECT r.id, r.cnpj FROM {reg_0000} r JOIN (SELECT CAST(c_custkey AS VARCHAR) AS cnpj, CASE WHEN c_acctbal > 0 THEN DATE '1998-01-01'
         ELSE DATE '1999-01-01' END AS corte FROM customer) p ON p.cnpj = r.cnpj WHERE r.data_entrega <= p.corte""",
)
def c08(t):
    parameters = t["customer"].select(
        F.col("c_custkey").cast("string").alias("cnpj"),
        F.when(F.col("c_acctbal") > 0, "1998-01-01").otherwise("1999-01-01").cast("date").alias("corte"),
    )
    return t["reg_0000"].join(parameters, "cnpj").where("data_entrega <= corte").select("id", "cnpj")


@check(
    "C09_optional_taxpayer",
    "SELECT id, 'todos' AS modo FROM {reg_0000} UNION ALL SELECT id, 'um' FROM {reg_0000} WHERE cnpj = '42'",
)
def c09(t):
    files = t["reg_0000"]
    every = files.where(equals_if_given(F.col("cnpj"), None)).select("id", F.lit("todos").alias("modo"))
    return every.unionByName(one_taxpayer(files, "cnpj", "42").select("id", F.lit("um").alias("modo")))


_CLEAN = "trim(replace({}, '.', ''))"
_LEVELS = f"""
    LEFT JOIN (SELECT {_CLEAN.format("it_nu_cest")} AS k1, {_CLEAN.format("it_nu_ncm")} AS k2, MIN(it_co_sefin) AS v FROM {{sitafe_cest_ncm}} GROUP BY 1, 2) a
      ON a.k1 = p_type AND a.k2 = p_brand
    LEFT JOIN (SELECT {_CLEAN.format("cest")} AS k, MIN(`co-sefin`) AS v FROM {{sitafe_cest}} GROUP BY 1) b ON b.k = p_type
    LEFT JOIN (SELECT {_CLEAN.format("ncm")} AS k, MIN(`co-sefin`) AS v FROM {{sitafe_ncm}} GROUP BY 1) c ON c.k = p_brand"""


@check(
    "C10_prioritised_lookup",
    f"SELECT p_partkey, coalesce(a.v, b.v, c.v) AS co_sefin_inferido, a.v AS level1, b.v AS level2, c.v AS level3 FROM part {_LEVELS}",
)
def c10(t):
    items = t["part"].select("p_partkey", F.col("p_brand").alias("ncm"), F.col("p_type").alias("cest"))
    out = classify(items, classification_tables(t), keep_levels=True)
    return out.drop("ncm", "cest")


@check(
    "C10_bare_keys",
    "SELECT DISTINCT trim(replace(cest, '.', '')) AS cest FROM {reg_0200}",
)
def c10_keys(t):
    return t["reg_0200"].select(bare_key(F.col("cest")).alias("cest")).distinct()


@check(
    "C11_raw_lookup_with_names",
    """SELECT p_partkey, b.v AS co_sefin_inferido, CAST(NULL AS VARCHAR) AS descr_co_sefin_inferido, n.it_no_produto AS descr_sefin_extra FROM part
       LEFT JOIN (SELECT ncm AS k, MIN(`co-sefin`) AS v FROM {sitafe_ncm} GROUP BY 1) b ON b.k = p_brand
       LEFT JOIN {sitafe_produto_sefin} n ON n.it_co_sefin = p_brand""",
)
def c11(t):
    items = t["part"].select(
        "p_partkey", F.col("p_brand").alias("ncm"), F.col("p_type").alias("cest"), F.col("p_brand").alias("sefin_extra")
    )
    out = classify_goods(items, classification_tables(t), extra_code="sefin_extra")
    return out.select("p_partkey", "co_sefin_inferido", "descr_co_sefin_inferido", "descr_sefin_extra")


_REF = "strftime(coalesce(greatest(dhemi, dhsaient), dhemi, dhsaient), '%Y%m%d')"


@check(
    "C12_dated_lookup",
    f"""SELECT chave_acesso, seq_nitem, prod_cprod, {dbl("it_pc_mva")} , it_in_mva_ajustado FROM
        (SELECT *, {_REF} AS ref FROM {{invoice_lines}}) LEFT JOIN {{sitafe_produto_sefin_aux}}
        ON it_co_sefin = prod_ncm AND ref >= it_da_inicio AND (trim(it_da_final) = '' OR ref <= it_da_final)""",
)
def c12(t):
    rows = t["invoice_lines"].select("chave_acesso", "seq_nitem", "prod_cprod", "prod_ncm", "dhemi", "dhsaient")
    moment = reference_date(F.col("dhemi"), F.col("dhsaient"))
    out = dated_attributes(rows, t["sitafe_produto_sefin_aux"], "prod_ncm", moment, "x")
    return out.select(
        "chave_acesso",
        "seq_nitem",
        "prod_cprod",
        F.col("it_pc_mva_x").alias("it_pc_mva"),
        F.col("it_in_mva_ajustado_x").alias("it_in_mva_ajustado"),
    )


@check(
    "C13_bridge_join",
    f"""SELECT p_name AS chave_produto, l_returnflag AS unidade, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS valor
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""",
)
def c13(t):
    products = (
        t["part"]
        .groupBy(F.lit("0").alias("cnpj"), F.col("p_name").alias("chave_produto"))
        .agg(F.collect_set("p_partkey").alias("lista_chave_item_individualizado"))
    )
    bridge = units.product_bridge(products).select("chave_produto", F.col("__item").alias("l_partkey"))
    per_item = t["lineitem"].groupBy("l_partkey", F.col("l_returnflag").alias("unidade")).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("valor")
    )
    return per_item.join(bridge, "l_partkey").groupBy("chave_produto", "unidade").agg(F.sum("valor").alias("valor"))


# Amounts per product and unit; products 1000 and up have a chosen reference unit.
BASE_SQL = """
    SELECT '0' AS cnpj, cod_item AS chave_produto, unid AS unidade, CASE WHEN cod_item >= '001000' THEN 'A' END AS unid_padrao,
           SUM(CASE WHEN ind_mov = '0' THEN vl_item ELSE 0 END) AS ve, SUM(CASE WHEN ind_mov = '0' THEN qtd ELSE 0 END) AS qe,
           SUM(CASE WHEN ind_mov = '1' THEN vl_item ELSE 0 END) AS vs, SUM(CASE WHEN ind_mov = '1' THEN qtd ELSE 0 END) AS qs, count(*) AS n
    FROM {reg_c170} GROUP BY cod_item, unid"""
PRICED_SQL = f"""
    SELECT cnpj, chave_produto, unidade, unid_padrao, CAST(ve AS DOUBLE) AS ve, CAST(qe AS DOUBLE) AS qe, CAST(vs AS DOUBLE) AS vs, CAST(qs AS DOUBLE) AS qs,
           CASE WHEN qe > 0 THEN CAST(ve AS DOUBLE) / CAST(qe AS DOUBLE) ELSE 0 END AS pe, CASE WHEN qs > 0 THEN CAST(vs AS DOUBLE) / CAST(qs AS DOUBLE) ELSE 0 END AS ps,
           CAST(abs(qe) + abs(qs) AS DOUBLE) AS vol, n FROM ({BASE_SQL})"""
REF_SQL = f"""
    SELECT b.*, r.unidade AS unid_ref, r.pe AS re, r.ps AS rs, count(*) OVER (PARTITION BY b.chave_produto) AS units
    FROM ({PRICED_SQL}) b JOIN (SELECT chave_produto AS k, coalesce(max(unid_padrao), first(unidade ORDER BY vol DESC, unidade)) AS ref FROM ({PRICED_SQL}) GROUP BY 1) x
      ON x.k = b.chave_produto
    LEFT JOIN ({PRICED_SQL}) r ON r.chave_produto = b.chave_produto AND r.unidade = x.ref"""


def unit_base(t):
    """Product and unit totals of the ledger items, with prices."""
    entry = F.col("ind_mov") == "0"
    amount = lambda c, name: F.when(c, F.col(name)).otherwise(F.lit(0).cast("decimal(18,2)"))
    grouped = (
        t["reg_c170"]
        .withColumn("unid_padrao", F.when(F.col("cod_item") >= "001000", "A"))
        .groupBy(
            F.lit("0").alias("cnpj"), F.col("cod_item").alias("chave_produto"), F.col("unid").alias("unidade"), "unid_padrao"
        )
        .agg(
            F.sum(amount(entry, "vl_item")).alias("v_entr_total"),
            F.sum(amount(entry, "qtd")).alias("q_entr_total"),
            F.sum(amount(~entry, "vl_item")).alias("v_saida_total"),
            F.sum(amount(~entry, "qtd")).alias("q_saida_total"),
            F.lit(0.5).alias("score_confianca_produto"),
            F.count(F.lit(1)).alias("ocorrencias"),
        )
        .withColumns({"descricao": F.col("chave_produto"), "descricao_longa": F.col("chave_produto")})
    )
    return units.with_prices(grouped)


@check(
    "C14_join_to_reference_row",
    f"SELECT chave_produto, unidade, x AS unid_ref, re AS preco_ref_ent, rs AS preco_ref_sai FROM (SELECT *, coalesce(unid_ref, 'A') AS x FROM ({REF_SQL}))",
)
def c14(t):
    base = unit_base(t)
    joined = units.with_reference(base)
    return joined.select("chave_produto", "unidade", "unid_ref", "preco_ref_ent", "preco_ref_sai")


@check(
    "C15_manual_override",
    """SELECT CAST(p_partkey AS VARCHAR) AS chave_produto, p_brand AS unidade, CASE WHEN p_size > 25 THEN 9.5 ELSE CAST(p_size AS DOUBLE) END AS fator_de_conversao,
         CASE WHEN p_size > 25 THEN 'manual' ELSE 'automatico' END AS fonte_fator FROM part""",
)
def c15(t):
    factors = t["part"].select(
        F.col("p_partkey").cast("string").alias("chave_produto"),
        F.col("p_brand").alias("unidade"),
        F.col("p_size").cast("double").alias("fator_sugerido"),
    )
    manual = factors.where("fator_sugerido > 25").select(
        "chave_produto", "unidade", F.lit(9.5).alias("fator_conversao_manual")
    )
    return units.with_manual_factors(factors, manual, "fator_sugerido").drop("fator_sugerido")


@check(
    "C17_derived_key_join",
    """SELECT p.id, s.no_segmento FROM {reg_0200} p LEFT JOIN {dm_cest_segmento} s ON s.cod_segmento = regexp_extract(p.cest, '^[0-9]{2}')""",
)
def c17(t):
    segment = t["dm_cest_segmento"].withColumnRenamed("cod_segmento", "k")
    rows = t["reg_0200"].select("id", F.regexp_extract("cest", "^[0-9]{2}", 0).alias("k"))
    return rows.join(segment, "k", "left").select("id", "no_segmento")


@check(
    "C18_grouped_max_with_exclusions",
    """SELECT c_custkey, m.d AS ultima FROM customer LEFT JOIN (SELECT o_custkey AS k, MAX(CAST(o_orderdate AS VARCHAR)) AS d FROM orders
         WHERE CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END NOT IN ('1-URGENT', '2-HIGH') GROUP BY 1) m ON m.k = c_custkey""",
)
def c18(t):
    priority = F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority"))
    newest = (
        t["orders"]
        .where(~priority.isin("1-URGENT", "2-HIGH"))
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.max(F.col("o_orderdate").cast("string")).alias("ultima"))
    )
    return t["customer"].select("c_custkey").join(newest, "c_custkey", "left")


@check(
    "C01_ledger_slice",
    f"""SELECT i.id, c.chv_nfe, {dbl("i.vl_item")}, f.cnpj FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cnpj, dt_ini ORDER BY data_entrega DESC, id DESC) AS rn
          FROM {{reg_0000}} WHERE data_entrega <= DATE '2000-12-31') WHERE rn = 1) f
        JOIN {{reg_c100}} c ON c.reg_0000_id = f.id JOIN {{reg_c170}} i ON i.reg_c100_id = c.id AND i.reg_0000_id = c.reg_0000_id""",
)
def c01_slice(t):
    files = valid_files(t["reg_0000"].withColumnRenamed("id", "reg_0000_id"), "2000-12-31").select("reg_0000_id", "cnpj")
    header = t["reg_c100"].select(F.col("id").alias("reg_c100_id"), "reg_0000_id", "chv_nfe").join(files, "reg_0000_id")
    return t["reg_c170"].join(header, ["reg_c100_id", "reg_0000_id"]).select("id", "chv_nfe", "vl_item", "cnpj")
