"""Table-building jobs: items, descriptions, products, units, merges (I)."""

from __future__ import annotations

from pyspark.sql import functions as F

from fiscoframe.checks import check, lst
from fiscoframe.functions.keys import set_key
from fiscoframe.functions.text import normalize_description
from fiscoframe.operators.lookup import classify
from fiscoframe.plans import descriptions as ds
from fiscoframe.plans import items as it
from fiscoframe.plans import merge as mg
from fiscoframe.plans import products as pr
from fiscoframe.plans import units
from fiscoframe.plans.replay import replay_merges
from fiscoframe.session import stage, stage_by
from fiscoframe.sources.reference import MERCANTILE, STOCK_AUDIT, classification_tables, marked_cfop

_ALLOWED = "(SELECT co_cfop FROM {dm_cfop} WHERE operacao_mercantil = 'X')"
_NET = "prod_vprod + coalesce(prod_vfrete, 0) + coalesce(prod_vseg, 0) + coalesce(prod_voutro, 0) - coalesce(prod_vdesc, 0)"


def _invoice_sql(table: str, source: str) -> str:
    return f"""SELECT co_emitente AS cnpj, prod_cprod AS codigo, prod_xprod AS descricao, CAST(NULL AS VARCHAR) AS descr_compl, CAST(NULL AS VARCHAR) AS tipo_item, prod_ncm AS ncm,
        prod_cest AS cest, coalesce(nullif(prod_ceantrib, ''), prod_cean) AS gtin, prod_ucom AS unidade, '{source}' AS fonte, 0 AS ve, {_NET} AS vs, 0 AS qe, prod_qcom AS qs,
        CAST(year(dhemi) AS VARCHAR) AS ano FROM {{{table}}} WHERE co_tp_nf = 1 AND co_cfop IN {_ALLOWED}"""


_DOCUMENTS_SQL = f"""{_invoice_sql("nfe", "NFe")} UNION ALL {_invoice_sql("nfce", "NFCe")}
    UNION ALL SELECT cnpj, cod_item, descr_item, descr_compl, tipo_item, cod_ncm, cest, cod_barra, unid, 'C170', CASE ind_oper WHEN '0' THEN vl_item ELSE 0 END,
      CASE ind_oper WHEN '1' THEN vl_item ELSE 0 END, CASE ind_oper WHEN '0' THEN qtd ELSE 0 END, CASE ind_oper WHEN '1' THEN qtd ELSE 0 END, NULL FROM {{c170}} WHERE cfop IN {_ALLOWED}"""
# Totals of products are over the lines whose operation counts in stock audits.
_AUDITED_SQL = _DOCUMENTS_SQL.replace("operacao_mercantil = 'X'", "sisaudit_estoque = 'X'")
_TRANSACTIONS_SQL = f"""{_DOCUMENTS_SQL}
    UNION ALL SELECT cnpj, codigo_produto, descricao_produto, NULL, tipo_item, cod_ncm, cest, cod_barra, unidade_medida, 'bloco_h', 0, 0, 0, 0, NULL FROM {{bloco_h}}"""

_FIELDS = ("codigo", "descricao", "descr_compl", "tipo_item", "ncm", "cest", "gtin")
_KEY_SQL = "md5(concat_ws('|', " + ", ".join(f"upper(trim(coalesce({f}, '')))" for f in _FIELDS) + "))"
_YEAR_SQL = "(SELECT cnpj AS yk, CAST(MIN(year(dt_ini)) AS VARCHAR) AS y FROM {reg_0000} GROUP BY 1)"
_ITEMS_SQL = f"""
    SELECT cnpj, chave, {", ".join(_FIELDS)}, te, ts, qe, qs, unidades, fontes,
           CASE WHEN ledger THEN least(coalesce(ano, y), y) ELSE ano END AS ano FROM (
      SELECT cnpj, {_KEY_SQL} AS chave, {", ".join(f"min({f}) AS {f}" for f in _FIELDS)}, SUM(ve) AS te, SUM(vs) AS ts, SUM(qe) AS qe, SUM(qs) AS qs,
             list_sort(list_distinct(list(unidade))) AS unidades, list_sort(list_distinct(list(fonte))) AS fontes, min(ano) AS ano, bool_or(fonte IN ('C170', 'bloco_h')) AS ledger
      FROM ({_TRANSACTIONS_SQL}) GROUP BY cnpj, {_KEY_SQL}) JOIN {_YEAR_SQL} ON yk = cnpj"""
# A line counts for the item with its key, if the item table has that item.
_COUNTED_SQL = f"""SELECT * FROM (SELECT *, {_KEY_SQL} AS chave_linha FROM ({_AUDITED_SQL})) WHERE (cnpj, chave_linha) IN (SELECT (cnpj, chave) FROM ({_ITEMS_SQL}))"""
_N = "upper(strip_accents(trim({})))"
_NORMAL_SQL = f"""
    SELECT cnpj, chave, codigo, CASE WHEN ltrim(codigo, '0') = '' THEN '0' ELSE ltrim(codigo, '0') END AS cod_normalizado, {_N.format("descricao")} AS descricao,
           {_N.format("descr_compl")} AS descr_compl, {_N.format("tipo_item")} AS tipo_item, replace({_N.format("ncm")}, '.', '') AS ncm, replace({_N.format("cest")}, '.', '') AS cest,
           replace({_N.format("gtin")}, '.', '') AS gtin, te, ts, qe, qs, unidades, list_transform(fontes, lambda f: upper(f)) AS fontes, ano, sefin,
           regexp_replace({_N.format("descricao")}, '\\s+', ' ', 'g') AS dn
    FROM (SELECT i.*, coalesce(a.v, b.v, c.v) AS sefin FROM ({_ITEMS_SQL}) i
      LEFT JOIN (SELECT trim(replace(it_nu_cest, '.', '')) AS k1, it_nu_ncm AS k2, MIN(it_co_sefin) AS v FROM {{sitafe_cest_ncm}} GROUP BY 1, 2) a ON a.k1 = cest AND a.k2 = ncm
      LEFT JOIN (SELECT trim(cest) AS k, MIN(`co-sefin`) AS v FROM {{sitafe_cest}} GROUP BY 1) b ON b.k = cest
      LEFT JOIN (SELECT ncm AS k, MIN(`co-sefin`) AS v FROM {{sitafe_ncm}} GROUP BY 1) c ON c.k = ncm)"""


def _cfop(t):
    return marked_cfop(t["dm_cfop"])


def _documents(t, flag=MERCANTILE):
    return it.transactions(t, marked_cfop(t["dm_cfop"], flag), inventory=False)


def _items(t, located=False):
    """Aggregated items with the inferred code, as the later jobs read them."""
    rows = it.aggregate_items(it.transactions(t, _cfop(t)), t["reg_0000"], located)
    return classify(rows, classification_tables(t))


def _stored_items(t):
    """The same as a stored table, for jobs that read it more than once."""
    return stage_by(_items(t, located=True), "cnpj", it.PART)


def _normal(t, located=False):
    return it.normalize_items(_items(t, located))


_AMOUNTS = "CAST(te AS DOUBLE) AS total_entradas, CAST(ts AS DOUBLE) AS total_saidas"
_QUANTITIES = "CAST(qe AS DOUBLE) AS qtd_entradas, CAST(qs AS DOUBLE) AS qtd_saidas"
_LISTS = "array_to_string(unidades, '; ') AS lista_unidades, array_to_string(fontes, '; ') AS fonte"


@check(
    "I01_item_characteristics",
    f"""SELECT cnpj, concat('item_', row_number() OVER (PARTITION BY cnpj ORDER BY descricao NULLS LAST, codigo NULLS LAST, chave)) AS chave_item_individualizado, {", ".join(_FIELDS)},
          {_AMOUNTS}, {_QUANTITIES}, {_LISTS} FROM ({_ITEMS_SQL})""",
)
def i01(t):
    return it.item_characteristics(it.transactions(t, _cfop(t)), t["reg_0000"], version=1)


@check(
    "I02_item_characteristics_v2",
    f"""SELECT cnpj, concat('item_', row_number() OVER (PARTITION BY cnpj ORDER BY descricao NULLS LAST, codigo NULLS LAST, chave)) AS item_seq_id, chave AS chave_item_individualizado,
          {", ".join(_FIELDS)}, {_AMOUNTS}, {_QUANTITIES}, {_LISTS}, ano FROM ({_ITEMS_SQL})""",
)
def i02(t):
    return it.item_characteristics(it.transactions(t, _cfop(t)), t["reg_0000"])


@check(
    "I02_normalized_items",
    f"""SELECT cnpj, chave AS chave_item_individualizado, codigo, cod_normalizado, descricao, descr_compl, tipo_item, ncm, cest, gtin, {_AMOUNTS}, {_QUANTITIES}, {_LISTS}, ano,
          sefin AS co_sefin_inferido, dn AS descricao_normalizada FROM ({_NORMAL_SQL})""",
)
def i02_normal(t):
    return _normal(t)


@check("I03_classified_items", f"SELECT cnpj, chave AS chave_item_individualizado, sefin AS co_sefin_inferido FROM ({_NORMAL_SQL})")
def i03(t):
    rows = it.aggregate_items(it.transactions(t, _cfop(t)))
    return it.classify_items([rows], classification_tables(t))[0].select(
        "cnpj", "chave_item_individualizado", "co_sefin_inferido"
    )


_FLAT = "array_to_string(list_sort(list_distinct(flatten(list({})))), '; ')"
_SET_KEY = "md5(string_agg(DISTINCT chave, '' ORDER BY chave))"
_DEFAULTS_SQL = "min(ncm) AS ncm_padrao, min(cest) AS cest_padrao, min(nullif(gtin, '')) AS gtin_padrao, min(tipo_item) AS tipo_item_padrao, list_min(flatten(list(unidades))) AS unid_padrao"
_SUMS = "CAST(SUM(te) AS DOUBLE) AS total_entradas, CAST(SUM(ts) AS DOUBLE) AS total_saidas"
_SUMS_Q = "CAST(SUM(qe) AS DOUBLE) AS qtd_entradas, CAST(SUM(qs) AS DOUBLE) AS qtd_saidas"
_CODE_LISTS = ", ".join(
    f"{lst(c)} AS {n}"
    for c, n in (
        ("descr_compl", "lista_descr_compl"),
        ("tipo_item", "lista_tipo_item"),
        ("ncm", "lista_ncm"),
        ("cest", "lista_cest"),
        ("gtin", "lista_gtin"),
        ("sefin", "lista_co_sefin_inferido"),
    )
)


@check(
    "I04_descriptions",
    f"""SELECT cnpj, descricao, {lst("chave")} AS lista_chave_item_individualizado, {lst("cod_normalizado")} AS lista_cod_normalizado, {_SUMS}, {_CODE_LISTS},
          {_FLAT.format("unidades")} AS lista_unids, {_FLAT.format("fontes")} AS lista_fonte, {_DEFAULTS_SQL}, {_SET_KEY} AS chave_produto, false AS verificado,
          min(sefin) AS co_sefin_agr, count(DISTINCT sefin) > 1 AS co_sefin_agr_divergente FROM ({_NORMAL_SQL}) GROUP BY cnpj, descricao""",
)
def i04(t):
    return ds.descriptions(_normal(t, located=True))


def _mode_sql(column: str, name: str) -> str:
    return f"(SELECT cnpj AS k1_{name}, descricao AS k2_{name}, first(v ORDER BY n DESC, v) AS {name} FROM (SELECT cnpj, descricao, {column} AS v, count(*) AS n FROM x WHERE {column} <> '' GROUP BY 1, 2, 3) GROUP BY 1, 2)"


@check(
    "I04_descriptions_mode_over_rows",
    f"""WITH x AS ({_NORMAL_SQL}) SELECT d.cnpj, d.descricao, ncm_padrao, gtin_padrao, unid_padrao FROM (SELECT DISTINCT cnpj, descricao FROM x) d
        LEFT JOIN {_mode_sql("ncm", "ncm_padrao")} ON k1_ncm_padrao = d.cnpj AND k2_ncm_padrao = d.descricao
        LEFT JOIN {_mode_sql("gtin", "gtin_padrao")} ON k1_gtin_padrao = d.cnpj AND k2_gtin_padrao = d.descricao
        LEFT JOIN (SELECT cnpj AS k1, descricao AS k2, first(v ORDER BY n DESC, v) AS unid_padrao FROM
          (SELECT cnpj, descricao, v, count(*) AS n FROM (SELECT cnpj, descricao, unnest(unidades) AS v FROM x) GROUP BY 1, 2, 3) GROUP BY 1, 2) ON k1 = d.cnpj AND k2 = d.descricao""",
)
def i04_rows(t):
    return ds.descriptions(it.normalize_items(_stored_items(t)), mode_over="rows").select(
        "cnpj", "descricao", "ncm_padrao", "gtin_padrao", "unid_padrao"
    )


_REPRESENTATIVE = "first(descricao ORDER BY length(regexp_split_to_array(descricao, '\\s+')) DESC, descricao)"
_PRODUCTS_SQL = f"""
    SELECT cnpj, dn AS descricao_normalizada, {_SET_KEY} AS chave_produto, {lst("chave")} AS lista_chave_item_individualizado, {lst("codigo")} AS lista_codigos,
           {lst("descricao")} AS lista_descricoes_originais, {_SUMS}, {_SUMS_Q}, count(*) AS qtd_itens_origem, {_CODE_LISTS}, {_FLAT.format("unidades")} AS lista_unids,
           {_FLAT.format("fontes")} AS lista_fonte, {_REPRESENTATIVE} AS descricao_representativa, {_DEFAULTS_SQL}, min(codigo) AS codigo_padrao, false AS verificado,
           min(sefin) AS co_sefin_agr, count(DISTINCT sefin) > 1 AS co_sefin_agr_divergente, CAST(count(*) AS DOUBLE) / CAST(count(*) + 1 AS DOUBLE) AS score_consistencia
    FROM ({_NORMAL_SQL}) GROUP BY cnpj, dn"""


@check("I05_descriptions_v2", _PRODUCTS_SQL)
def i05(t):
    return ds.descriptions_v2(_normal(t, located=True))


@check(
    "I05_description_members",
    f"SELECT DISTINCT cnpj, dn AS descricao_normalizada, chave AS chave_item_individualizado FROM ({_NORMAL_SQL})",
)
def i05_members(t):
    return ds.description_members(_normal(t))


@check(
    "I06_codes_with_several_descriptions",
    f"""SELECT cnpj, cod_normalizado, string_agg(chave, '; ' ORDER BY descricao, chave) AS lista_chave_item_individualizado, string_agg(descricao, '; ' ORDER BY descricao, chave) AS lista_descricao,
          string_agg(concat(cod_normalizado, '__', r), '; ' ORDER BY r) AS cods_desagregados, count(DISTINCT descricao) AS qtd_descr
        FROM (SELECT *, row_number() OVER (PARTITION BY cnpj, cod_normalizado ORDER BY descricao, chave) AS r FROM ({_NORMAL_SQL})) GROUP BY 1, 2 HAVING count(DISTINCT descricao) > 1""",
)
def i06(t):
    return ds.codes_with_several_descriptions(_normal(t))


@check(
    "I07_consolidated_products",
    f"""SELECT cnpj, md5(chave_produto) AS chave_id, chave_produto, chave_produto AS lista_chave_produto, descricao_normalizada, descricao_representativa AS descricao_final,
          descricao_representativa AS descricao_padrao, codigo_padrao, ncm_padrao, cest_padrao, gtin_padrao, tipo_item_padrao, unid_padrao, co_sefin_agr AS co_sefin_padrao,
          co_sefin_agr_divergente AS co_sefin_divergente, lista_chave_item_individualizado, '' AS lista_item_seq_id, lista_codigos, lista_descricoes_originais, lista_ncm, lista_cest, lista_gtin,
          lista_tipo_item, lista_unids, lista_co_sefin_inferido, total_entradas, total_saidas, qtd_entradas, qtd_saidas, qtd_itens_origem, score_consistencia AS score_confianca,
          'automatico' AS origem_agregacao, 'pendente' AS status_revisao, false AS verificado_manualmente, CAST(NULL AS VARCHAR) AS usuario_verificacao,
          CAST(NULL AS VARCHAR) AS data_verificacao, CAST(NULL AS VARCHAR) AS observacao_revisor FROM ({_PRODUCTS_SQL})""",
)
def i07(t):
    return ds.consolidated_products(ds.descriptions_v2(_normal(t, located=True)))


_MOVEMENTS_SQL = f"""
    SELECT cnpj, codigo, descricao, descr_compl, tipo_item, ncm, cest, gtin, unidade AS unid, 0 AS compras, vs AS vendas
      FROM ({_invoice_sql("nfe", "NFe")} UNION ALL {_invoice_sql("nfce", "NFCe")})
    UNION ALL SELECT cnpj, cod_item, descr_item, descr_compl, tipo_item, cod_ncm, cest, cod_barra, unid, vl_item, 0 FROM {{c170}} WHERE ind_oper = '0' AND cfop IN {_ALLOWED}
    UNION ALL SELECT cnpj, codigo_produto, descricao_produto, NULL, tipo_item, cod_ncm, cest, cod_barra, unidade_medida, 0, 0 FROM {{bloco_h}}"""
_PLAIN_N = "nullif(regexp_replace(trim(upper(strip_accents(descricao))), '\\s+', ' ', 'g'), '')"


@check(
    "I08_unit_movements",
    f"SELECT * REPLACE (CAST(compras AS DOUBLE) AS compras, CAST(vendas AS DOUBLE) AS vendas) FROM ({_MOVEMENTS_SQL})",
)
def i08(t):
    return pr.unit_movements(t, _cfop(t))


_PRODUCT_TABLE_SQL = f"""
    SELECT cnpj, concat('id_produto_', row_number() OVER (PARTITION BY cnpj ORDER BY dn NULLS FIRST)) AS chave_produto, * EXCLUDE (cnpj, dn), dn AS descricao_normalizada FROM (
      SELECT cnpj, {_PLAIN_N} AS dn, min(descricao) AS descricao, {lst("descr_compl")} AS lista_desc_compl, {lst("codigo")} AS lista_codigos, {lst("tipo_item")} AS lista_tipo_item,
        {lst("ncm")} AS lista_ncm, {lst("cest")} AS lista_cest, {lst("gtin")} AS lista_gtin, {lst("unid")} AS lista_unid FROM ({_MOVEMENTS_SQL}) GROUP BY cnpj, {_PLAIN_N})"""


@check("I09_products", _PRODUCT_TABLE_SQL)
def i09(t):
    return pr.products(pr.unit_movements(t, _cfop(t)))


_LONGEST = "list_reduce(list_prepend('', string_split({0}, '; ')), lambda a, b: CASE WHEN length(b) > length(a) OR (length(b) = length(a) AND b < a) THEN b ELSE a END)"


@check(
    "I10_products_each_alone",
    f"""SELECT cnpj, replace(chave_produto, 'id_produto_', 'id_agrupado_') AS id_agrupado, chave_produto AS lista_chave_produto, descricao AS descr_padrao,
          nullif({_LONGEST.format("lista_ncm")}, '') AS ncm_padrao, nullif({_LONGEST.format("lista_cest")}, '') AS cest_padrao, nullif({_LONGEST.format("lista_gtin")}, '') AS gtin_padrao,
          lista_unid AS lista_unidades FROM ({_PRODUCT_TABLE_SQL})""",
)
def i10(t):
    return pr.grouped_products(pr.products(pr.unit_movements(t, _cfop(t))))


_ASSIGNED = "substr(descricao_normalizada, 1, 1) IN ('S', 'B')"
_GROUPS_SQL = f"""
    WITH p AS MATERIALIZED ({_PRODUCT_TABLE_SQL}), g AS (SELECT *, concat('G_', substr(descricao_normalizada, 1, 1)) AS id_agrupado FROM p WHERE {_ASSIGNED}),
      n AS (SELECT cnpj, count(DISTINCT id_agrupado) AS groups FROM g GROUP BY 1)
    SELECT cnpj, id_agrupado, string_agg(chave_produto, '; ' ORDER BY chave_produto) AS lista_chave_produto,
           array_to_string(list_sort(list_distinct(flatten(list(string_split(lista_unid, '; '))))), '; ') AS lista_unidades FROM g GROUP BY 1, 2
    UNION ALL SELECT p.cnpj, concat('id_agrupado_', coalesce(groups, 0) + row_number() OVER (PARTITION BY p.cnpj ORDER BY CAST(regexp_extract(chave_produto, '[0-9]+') AS BIGINT))),
           chave_produto, lista_unid FROM p LEFT JOIN n ON n.cnpj = p.cnpj WHERE NOT ({_ASSIGNED})"""


def _stored_products(t):
    """The product table, stored by its key: what joins products finds them there."""
    return stage_by(pr.products(pr.unit_movements(t, _cfop(t))), "cnpj", "chave_produto", moved=False)


def _assignment(products):
    return products.where(F.substring("descricao_normalizada", 1, 1).isin("S", "B")).select(
        "cnpj",
        F.concat(F.lit("G_"), F.substring("descricao_normalizada", 1, 1)).alias("id_agrupado"),
        "chave_produto",
    )


@check("I10_grouped_products", _GROUPS_SQL)
def i10_groups(t):
    products = _stored_products(t)
    grouped = pr.grouped_products(products, _assignment(products))
    return grouped.select("cnpj", "id_agrupado", "lista_chave_produto", "lista_unidades")


@check(
    "I10_group_defaults",
    f"""WITH p AS MATERIALIZED ({_PRODUCT_TABLE_SQL}), g AS (SELECT *, concat('G_', substr(descricao_normalizada, 1, 1)) AS id_agrupado,
          CASE WHEN lista_ncm = '' THEN 0 ELSE 1 END + CASE WHEN lista_cest = '' THEN 0 ELSE 1 END + CASE WHEN lista_gtin = '' THEN 0 ELSE 1 END AS cheias FROM p WHERE {_ASSIGNED}),
        d AS (SELECT cnpj, id_agrupado, first(v ORDER BY n DESC, f DESC, length(v) DESC, v) AS descr_padrao FROM (SELECT cnpj, id_agrupado, trim(descricao) AS v, count(*) AS n,
                arg_min(cheias, CAST(regexp_extract(chave_produto, '[0-9]+') AS BIGINT)) FILTER (WHERE trim(descricao) = descricao) AS f FROM g GROUP BY 1, 2, 3) GROUP BY 1, 2),
        m AS (SELECT cnpj, id_agrupado, first(v ORDER BY n DESC, length(v) DESC, v) AS ncm_padrao FROM (SELECT cnpj, id_agrupado, v, count(*) AS n FROM
                (SELECT cnpj, id_agrupado, unnest(string_split(lista_ncm, '; ')) AS v FROM g) WHERE v <> '' GROUP BY 1, 2, 3) GROUP BY 1, 2)
        SELECT d.cnpj, d.id_agrupado, descr_padrao, ncm_padrao FROM d LEFT JOIN m ON m.cnpj = d.cnpj AND m.id_agrupado = d.id_agrupado""",
)
def i10_defaults(t):
    products = _stored_products(t)
    grouped = pr.grouped_products(products, _assignment(products))
    return grouped.where(F.col("id_agrupado").startswith("G_")).select("cnpj", "id_agrupado", "descr_padrao", "ncm_padrao")


@check(
    "I10_group_members",
    f"""SELECT cnpj, chave_produto, replace(chave_produto, 'id_produto_', 'id_agrupado_') AS id_agrupado, descricao_normalizada, lista_codigos FROM ({_PRODUCT_TABLE_SQL})""",
)
def i10_members(t):
    products = _stored_products(t)
    members = pr.group_members(pr.grouped_products(products), products)
    return members.select("cnpj", "chave_produto", "id_agrupado", "descricao_normalizada", "lista_codigos")


# Every transaction finds its item, so a product's amounts are those of its description.
_BASE_SQL = f"""
    SELECT b.*, chave_produto, unid_padrao, score, CASE WHEN qe > 0 THEN ve / qe ELSE 0 END AS pe, CASE WHEN qs > 0 THEN vs / qs ELSE 0 END AS ps, abs(qe) + abs(qs) AS vol,
           max(longa) OVER (PARTITION BY b.cnpj, b.dn) AS longa_produto, count(*) OVER (PARTITION BY b.cnpj, b.dn) AS units FROM (
      SELECT cnpj, dn, unidade, CAST(SUM(ve) AS DOUBLE) AS ve, CAST(SUM(qe) AS DOUBLE) AS qe, CAST(SUM(vs) AS DOUBLE) AS vs, CAST(SUM(qs) AS DOUBLE) AS qs, count(*) AS n,
             min(d) AS descricao, max(d) AS longa FROM (SELECT *, {_N.format("descricao")} AS d, regexp_replace({_N.format("descricao")}, '\\s+', ' ', 'g') AS dn FROM ({_DOCUMENTS_SQL}))
      GROUP BY 1, 2, 3) b
    JOIN (SELECT cnpj, dn, {_SET_KEY} AS chave_produto, list_min(flatten(list(unidades))) AS unid_padrao, CAST(count(*) AS DOUBLE) / CAST(count(*) + 1 AS DOUBLE) AS score
          FROM ({_NORMAL_SQL}) GROUP BY 1, 2) p ON p.cnpj = b.cnpj AND p.dn = b.dn"""
_FACTOR_SQL = f"""
    WITH base AS MATERIALIZED ({_BASE_SQL}) SELECT b.*, CASE WHEN b.unidade = b.unid_padrao THEN 1.0::DOUBLE WHEN r.pe > 0 AND b.pe > 0 THEN r.pe / b.pe WHEN r.ps > 0 AND b.ps > 0 THEN r.ps / b.ps
      ELSE 0.0::DOUBLE END AS f, b.vol / (b.vol + 1::DOUBLE) * 0.6::DOUBLE + b.score * 0.4::DOUBLE AS s FROM base b
    LEFT JOIN base r ON r.cnpj = b.cnpj AND r.chave_produto = b.chave_produto AND r.unidade = b.unid_padrao"""
_TOTALS = "ve AS v_entr_total, vs AS v_saida_total"
_PRICES = "pe AS preco_medio_entrada, ps AS preco_medio_saida"


def _base(t):
    items = _stored_items(t)
    products = ds.consolidated_products(ds.descriptions_v2(it.normalize_items(items), located=True))
    return units.conversion_base(_documents(t), products, items)


@check(
    "I11_conversion_factors",
    f"""SELECT cnpj, chave_produto, longa_produto AS descricao, unidade, unid_padrao, {_TOTALS}, {_PRICES}, f AS fator_de_conversao,
          CASE WHEN f <= 0 THEN 'Erro: Fator <= 0' WHEN f > 1000 OR f < 0.001 THEN 'Alerta: Fator Extremo' WHEN units > 5 THEN 'Alerta: Fragmentação' ELSE 'OK' END AS status_qualidade,
          'automático' AS fonte_fator FROM ({_FACTOR_SQL}) WHERE units > 1""",
)
def i11(t):
    return units.conversion_factors(_base(t))


_STATUS_SQL = """CASE WHEN f <= 0 THEN 'erro' WHEN f > 1000 OR f < 0.001 THEN 'extremo' WHEN s >= 0.85 THEN 'auto_aprovavel' WHEN s >= 0.65 THEN 'revisar' ELSE 'baixa_confianca' END"""
_V2_SQL = f"""
    SELECT cnpj, chave_produto, descricao, unidade, unid_padrao, ve AS v_entr_total, qe AS q_entr_total, vs AS v_saida_total, qs AS q_saida_total, {_PRICES}, vol AS volume_total,
           f AS fator_sugerido, s AS score_confianca, {_STATUS_SQL} AS status_validacao, f AS fator_de_conversao, 'automatico' AS fonte_fator FROM ({_FACTOR_SQL})"""


@check("I12_conversion_factors_v2", _V2_SQL)
def i12(t):
    return units.conversion_factors_v2(_base(t))


@check(
    "I12_conversion_base",
    f"""SELECT cnpj, chave_produto, unidade, unid_padrao, ve AS v_entr_total, qe AS q_entr_total, vs AS v_saida_total, qs AS q_saida_total, n AS ocorrencias, vol AS volume_total FROM ({_BASE_SQL})""",
)
def i12_base(t):
    return _base(t).select(
        "cnpj", "chave_produto", "unidade", "unid_padrao", "v_entr_total", "q_entr_total", "v_saida_total", "q_saida_total", "ocorrencias", "volume_total"
    )


@check("I12_factors_of_two_periods", _V2_SQL)
def i12_periods(t):
    """Totals of each period are stored on their own; the factors come from the totals alone and equal those of all rows."""
    items = _stored_items(t)
    products = ds.consolidated_products(ds.descriptions_v2(it.normalize_items(items), located=True))
    rows, odd = _documents(t), F.coalesce(F.col("ano").try_cast("int") % 2 == 1, F.lit(False))
    located = it.in_parts(items, products)
    periods = [stage(units.item_unit_totals(rows.where(part), located)) for part in (odd, ~odd)]
    return units.conversion_factors_v2(units.base_of_totals(units.merge_unit_totals(*periods), products, items))


@check(
    "I12_review_queue",
    f"SELECT * FROM ({_V2_SQL}) WHERE status_validacao <> 'auto_aprovavel' OR fator_de_conversao <= 0 OR fator_de_conversao > 1000 OR fator_de_conversao < 0.001",
)
def i12_queue(t):
    return units.review_queue(units.conversion_factors_v2(_base(t)))


@check(
    "I13_legacy_factors",
    f"""WITH mv AS (SELECT *, {_PLAIN_N} AS dn FROM ({_MOVEMENTS_SQL})),
          prices AS (SELECT cnpj, dn, unid, count(*) AS n, coalesce(CAST(SUM(compras) FILTER (WHERE compras > 0) AS DOUBLE) / CAST(count(*) FILTER (WHERE compras > 0) AS DOUBLE), 0) AS pc,
                       coalesce(CAST(SUM(vendas) FILTER (WHERE vendas > 0) AS DOUBLE) / CAST(count(*) FILTER (WHERE vendas > 0) AS DOUBLE), 0) AS pv FROM mv GROUP BY 1, 2, 3),
          refs AS (SELECT cnpj, dn, first(unid ORDER BY n DESC, unid) AS ref, count(*) AS units FROM prices GROUP BY 1, 2),
          j AS (SELECT p.*, r.ref, x.pc AS rc, x.pv AS rv FROM prices p JOIN refs r ON r.cnpj = p.cnpj AND r.dn = p.dn JOIN prices x ON x.cnpj = r.cnpj AND x.dn = r.dn AND x.unid = r.ref WHERE r.units > 1)
        SELECT j.cnpj, t.chave_produto AS id_produtos, t.descricao AS descr_padrao, unid, ref AS unid_ref,
          CASE WHEN unid = ref THEN 1.0::DOUBLE WHEN pc > 0 AND rc > 0 THEN pc / rc ELSE pv / rv END AS fator
        FROM j JOIN ({_PRODUCT_TABLE_SQL}) t ON t.cnpj = j.cnpj AND t.descricao_normalizada = j.dn WHERE unid = ref OR (pc > 0 AND rc > 0) OR (pv > 0 AND rv > 0)""",
)
def i13(t):
    movements = pr.unit_movements(t, _cfop(t))
    movements = stage(movements)
    return units.legacy_factors(pr.products(movements), movements)


@check(
    "I14_editable_table",
    f"""SELECT cnpj, descricao, {_SET_KEY} AS chave_produto, {_SET_KEY} AS chave_id, {_SET_KEY} AS lista_chave_produto, false AS verificado FROM ({_NORMAL_SQL}) GROUP BY cnpj, descricao""",
)
def i14(t):
    return mg.editable_table(ds.descriptions(_normal(t, located=True))).select(
        "cnpj", "descricao", "chave_produto", "chave_id", "lista_chave_produto", "verificado"
    )


# Merge: all products of a taxpayer whose description starts with the same letter.
_ROWS_SQL = f"""SELECT cnpj, descricao, {_SET_KEY} AS chave, SUM(te) AS te, SUM(ts) AS ts, list_sort(list_distinct(list(ncm))) AS ncms, list_sort(list_distinct(flatten(list(unidades)))) AS unids,
    list_sort(list_distinct(list(chave))) AS itens, list_sort(list_distinct(list(cod_normalizado))) AS codigos, list(DISTINCT sefin) FILTER (WHERE sefin IS NOT NULL) AS sefins
    FROM ({_NORMAL_SQL}) GROUP BY cnpj, descricao"""
_MERGE_SQL = f"WITH r AS MATERIALIZED (SELECT *, substr(descricao, 1, 1) AS grupo, count(*) OVER (PARTITION BY cnpj, substr(descricao, 1, 1)) AS n FROM ({_ROWS_SQL}))"


def _natural(v: str) -> str:
    return f"coalesce(regexp_extract({v}, '^[^0-9]*'), ''), coalesce(TRY_CAST(regexp_extract({v}, '[0-9]+') AS BIGINT), -1), {v}"


def _merge_input(t):
    return _letters(mg.editable_table(ds.descriptions(_normal(t, located=True), located=True)))


def _letters(editable):
    """The table, stored by the parts of its products, and the assignment of its products by their first letter."""
    editable = stage_by(editable, "cnpj", it.PART)
    return editable, editable.select("cnpj", it.PART, F.substring("descricao", 1, 1).alias("grupo"), "chave_produto")


@check(
    "I15_merged_products",
    f"""{_MERGE_SQL}, u AS (SELECT cnpj, grupo, v, count(*) AS k FROM (SELECT cnpj, grupo, unnest(ncms) AS v FROM r WHERE n > 1) GROUP BY 1, 2, 3),
          c AS (SELECT cnpj, grupo, v, count(*) AS k FROM (SELECT cnpj, grupo, unnest(codigos) AS v FROM r WHERE n > 1) GROUP BY 1, 2, 3)
        SELECT a.*, b.ncm_padrao, d.codigo_padrao, d.lista_codigos FROM
          (SELECT cnpj, grupo, md5(string_agg(chave, '' ORDER BY chave)) AS chave_id, min(descricao) AS descricao, count(*) AS itens_unificados,
             CAST(SUM(te) AS DOUBLE) AS total_entradas, CAST(SUM(ts) AS DOUBLE) AS total_saidas, true AS verificado,
             array_to_string(list_sort(list_distinct(flatten(list(itens)))), '; ') AS lista_chave_item_individualizado,
             first(descricao ORDER BY length(regexp_split_to_array(descricao, '\\s+')) DESC, chave) AS descricao_padrao,
             length(list_distinct(flatten(list(sefins)))) > 1 AS co_sefin_agr_divergente FROM r WHERE n > 1 GROUP BY 1, 2) a
        LEFT JOIN (SELECT cnpj, grupo, first(v ORDER BY k DESC, {_natural("v")}) AS ncm_padrao FROM u GROUP BY 1, 2) b ON b.cnpj = a.cnpj AND b.grupo = a.grupo
        LEFT JOIN (SELECT cnpj, grupo, first(v ORDER BY k DESC, {_natural("v")}) AS codigo_padrao,
                     string_agg(concat('[', v, '; 1]'), '; ' ORDER BY {_natural("v")}) AS lista_codigos FROM c GROUP BY 1, 2) d ON d.cnpj = a.cnpj AND d.grupo = a.grupo""",
)
def i15(t):
    editable, assignment = _merge_input(t)
    merged = mg.merged_rows(mg.selected_rows(editable, assignment))
    return merged.select(
        "cnpj", "grupo", "chave_id", "descricao", "itens_unificados", "total_entradas", "total_saidas", "verificado",
        "lista_chave_item_individualizado", "descricao_padrao", "co_sefin_agr_divergente", "ncm_padrao", "codigo_padrao", "lista_codigos",
    )


@check(
    "I16_apply_merge",
    f"""{_MERGE_SQL} SELECT cnpj, descricao, chave AS chave_produto, CAST(te AS DOUBLE) AS total_entradas, CAST(ts AS DOUBLE) AS total_saidas, false AS verificado FROM r WHERE n = 1
        UNION ALL SELECT cnpj, min(descricao), md5(string_agg(chave, '' ORDER BY chave)), CAST(SUM(te) AS DOUBLE), CAST(SUM(ts) AS DOUBLE), true FROM r WHERE n > 1 GROUP BY cnpj, grupo""",
)
def i16(t):
    changed, _ = mg.apply_merge(*_merge_input(t))
    return changed.select("cnpj", "descricao", "chave_produto", "total_entradas", "total_saidas", "verificado")


@check(
    "I16_replayed_log",
    f"""WITH r AS MATERIALIZED ({_ROWS_SQL}),
        a AS (SELECT cnpj, substr(descricao, 1, 2) AS g, CASE WHEN count(*) = 1 THEN min(chave) ELSE md5(string_agg(chave, '' ORDER BY chave)) END AS chave,
                min(descricao) AS descricao, SUM(te) AS te, SUM(ts) AS ts, count(*) AS n FROM r GROUP BY 1, 2)
        SELECT cnpj, min(descricao) AS descricao, CASE WHEN count(*) = 1 THEN min(chave) ELSE md5(string_agg(chave, '' ORDER BY chave)) END AS chave_produto,
          CAST(SUM(te) AS DOUBLE) AS total_entradas, CAST(SUM(ts) AS DOUBLE) AS total_saidas, SUM(n) > 1 AS verificado FROM a GROUP BY cnpj, substr(g, 1, 1)""",
)
def i16_replay(t):
    """Merges by two letters, then of their results by one letter; some taxpayers then name the first products again, to no effect."""
    editable = stage_by(mg.editable_table(ds.descriptions(_normal(t, located=True), located=True)), "cnpj", it.PART)
    rows = editable.select("cnpj", "chave_produto", F.substring("descricao", 1, 2).alias("g"), F.substring("descricao", 1, 1).alias("l"))
    first = rows.select("cnpj", F.lit(1).alias("ordem"), F.col("g").alias("grupo"), "chave_produto")
    keys = F.collect_set("chave_produto")
    results = rows.groupBy("cnpj", "g", "l").agg(F.when(F.size(keys) == 1, F.get(keys, F.lit(0))).otherwise(set_key(keys)).alias("chave_produto"))
    second = results.select("cnpj", F.lit(2).alias("ordem"), F.col("l").alias("grupo"), "chave_produto")
    again = rows.where(F.substring("cnpj", -1, 1).isin("0", "2", "4")).select("cnpj", F.lit(3).alias("ordem"), F.col("l").alias("grupo"), "chave_produto")
    changed, _ = replay_merges(editable, first.union(second).union(again))
    return changed.select("cnpj", "descricao", "chave_produto", "total_entradas", "total_saidas", "verificado")


_MERGED_TOTALS = """LEFT JOIN (SELECT m.cnpj AS {c}_c, m.chave AS {c}_k, string_agg(concat('[', unidade, '; ', CAST(floor(v) AS BIGINT), ']'), '; ' ORDER BY unidade) AS {c} FROM
      (SELECT k.cnpj, k.chave, d.unidade, SUM(d.{v}) AS v FROM k JOIN (SELECT cnpj, {n} AS descricao, unidade, SUM(ve) AS ve, SUM(vs) AS vs FROM ({lines}) GROUP BY 1, 2, 3) d
         ON d.cnpj = k.cnpj AND d.descricao = k.descricao GROUP BY 1, 2, 3) m WHERE v > 0 GROUP BY 1, 2) ON {c}_c = g.cnpj AND {c}_k = g.chave"""


def _merged_totals(name: str, column: str) -> str:
    return _MERGED_TOTALS.format(c=name, v=column, n=_N.format("descricao"), lines=_COUNTED_SQL)


_KEYED_SQL = f"""{_MERGE_SQL}, k AS MATERIALIZED (SELECT r.cnpj, r.descricao, r.grupo, r.n, CASE WHEN n = 1 THEN r.chave ELSE md5(s.chaves) END AS chave FROM r
      JOIN (SELECT cnpj, grupo, string_agg(chave, '' ORDER BY chave) AS chaves FROM r GROUP BY 1, 2) s ON s.cnpj = r.cnpj AND s.grupo = r.grupo),
    g AS (SELECT cnpj, chave, min(descricao) AS descricao, count(*) AS n FROM k GROUP BY 1, 2)"""


def _merged(t):
    items = _stored_items(t)
    editable, assignment = _letters(mg.editable_table(ds.descriptions(it.normalize_items(items), located=True)))
    return mg.merge_and_total(editable, assignment, _documents(t, STOCK_AUDIT), items, "2024-01-02T03:04:05")


@check(
    "I16_merge_with_totals",
    f"""{_KEYED_SQL} SELECT g.cnpj, g.chave AS chave_produto, g.descricao, coalesce(e, '') AS tot_v_entradas, coalesce(s, '') AS tot_v_saidas
        FROM g {_merged_totals("e", "ve")} {_merged_totals("s", "vs")}""",
)
def i16_totals(t):
    return _merged(t)[0].select("cnpj", "chave_produto", "descricao", "tot_v_entradas", "tot_v_saidas")


@check(
    "I16_merge_log",
    f"""{_KEYED_SQL} SELECT '2024-01-02T03:04:05' AS timestamp, g.cnpj, g.chave AS chave_produto, g.descricao, coalesce(e, '') AS tot_v_entradas, coalesce(s, '') AS tot_v_saidas,
          g.n AS itens_unificados FROM g {_merged_totals("e", "ve")} {_merged_totals("s", "vs")} WHERE g.n > 1""",
)
def i16_log(t):
    return _merged(t)[1].select("timestamp", "cnpj", "chave_produto", "descricao", "tot_v_entradas", "tot_v_saidas", "itens_unificados")


def _row_mode(column: str, name: str) -> str:
    return f"""LEFT JOIN (SELECT cnpj AS c_{name}, descricao AS d_{name}, first(v ORDER BY n DESC, {_natural("v")}) AS {name} FROM
        (SELECT cnpj, descricao, {column} AS v, count(*) AS n FROM x WHERE {column} <> '' GROUP BY 1, 2, 3) GROUP BY 1, 2) ON c_{name} = p.cnpj AND d_{name} = p.descricao"""


@check(
    "I17_recomputed_defaults",
    f"""WITH x AS MATERIALIZED ({_NORMAL_SQL}) SELECT p.cnpj, p.chave_produto, ncm_padrao, cest_padrao, tipo_item_padrao, co_sefin_agr FROM
          (SELECT cnpj, descricao, {_SET_KEY} AS chave_produto FROM x GROUP BY 1, 2) p
          {_row_mode("ncm", "ncm_padrao")} {_row_mode("cest", "cest_padrao")} {_row_mode("tipo_item", "tipo_item_padrao")} {_row_mode("sefin", "co_sefin_agr")}""",
)
def i17(t):
    items = it.normalize_items(_stored_items(t))
    out = mg.recompute_defaults(mg.editable_table(ds.descriptions(items, located=True)), items)
    return out.select("cnpj", "chave_produto", "ncm_padrao", "cest_padrao", "tipo_item_padrao", "co_sefin_agr")


def _totals_sql(column: str) -> str:
    return f"""(SELECT cnpj, descricao, string_agg(concat('[', unidade, '; ', CAST(floor(v) AS BIGINT), ']'), '; ' ORDER BY unidade) AS texto FROM
        (SELECT cnpj, {_N.format("descricao")} AS descricao, unidade, SUM({column}) AS v FROM ({_COUNTED_SQL}) GROUP BY 1, 2, 3) WHERE v > 0 GROUP BY 1, 2)"""


@check(
    "I18_recomputed_totals",
    f"""SELECT p.cnpj, p.chave_produto, coalesce(e.texto, '') AS tot_v_entradas, coalesce(s.texto, '') AS tot_v_saidas FROM
          (SELECT cnpj, descricao, {_SET_KEY} AS chave_produto FROM ({_NORMAL_SQL}) GROUP BY 1, 2) p
        LEFT JOIN {_totals_sql("ve")} e ON e.cnpj = p.cnpj AND e.descricao = p.descricao LEFT JOIN {_totals_sql("vs")} s ON s.cnpj = p.cnpj AND s.descricao = p.descricao""",
)
def i18(t):
    items = _stored_items(t)
    editable = mg.editable_table(ds.descriptions(it.normalize_items(items), located=True))
    out = mg.with_value_totals(editable, _documents(t, STOCK_AUDIT), items)
    return out.select("cnpj", "chave_produto", "tot_v_entradas", "tot_v_saidas")


@check(
    "I20_applied_conversion",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity * f AS quantidade_convertida, CASE WHEN l_quantity * f = 0 THEN NULL ELSE l_extendedprice / (l_quantity * f) END AS preco_convertido,
         coalesce(ref, l_returnflag) AS unidade_convertida FROM (SELECT lineitem.*, CASE WHEN p_size > 10 AND l_returnflag = 'A' THEN CAST(p_size AS DOUBLE) ELSE 1.0::DOUBLE END AS f,
         CASE WHEN l_returnflag = 'A' THEN 'UN' END AS ref FROM lineitem JOIN part ON l_partkey = p_partkey)""",
)
def i20(t):
    movements = t["lineitem"].select(
        "*",
        F.lit("0").alias("cnpj"),
        F.col("l_partkey").cast("string").alias("chave_produto"),
        F.col("l_returnflag").alias("unidade"),
        F.col("l_quantity").alias("quantidade"),
        F.col("l_extendedprice").alias("valor"),
    )
    factors = t["part"].select(
        F.lit("0").alias("cnpj"),
        F.col("p_partkey").cast("string").alias("chave_produto"),
        F.lit("A").alias("unidade"),
        F.when(F.col("p_size") > 10, F.col("p_size").cast("double")).otherwise(F.lit(0.0)).alias("fator_de_conversao"),
        F.lit("UN").alias("unid_padrao"),
    )
    return units.apply_conversion(movements, factors).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "quantidade_convertida", "preco_convertido", "unidade_convertida"
    )


@check(
    "I21_movements_without_repeats",
    "SELECT l_orderkey AS chave_acesso, l_linenumber AS num_item, MIN(l_partkey) AS l_partkey FROM lineitem GROUP BY 1, 2",
)
def i21(t):
    rows = t["lineitem"].select(F.col("l_orderkey").alias("chave_acesso"), F.col("l_linenumber").alias("num_item"), "l_partkey")
    return units.deduplicate_movements(rows)


@check(
    "I22_price_volatility",
    """SELECT CAST(l_partkey AS VARCHAR) AS chave_produto, l_returnflag AS unidade, count(*) AS movimentos, round(stddev_samp(l_discount) / avg(l_discount), 6) AS coef_variacao,
         coalesce(round(stddev_samp(l_discount) / avg(l_discount), 9) > 0.5, false) AS volatil FROM lineitem GROUP BY 1, 2""",
)
def i22(t):
    rows = t["lineitem"].select(
        F.lit("0").alias("cnpj"),
        F.col("l_partkey").cast("string").alias("chave_produto"),
        F.col("l_returnflag").alias("unidade"),
        F.col("l_discount").alias("preco"),
    )
    out = units.price_volatility(rows, 0.5)
    return out.select("chave_produto", "unidade", "movimentos", F.round("coef_variacao", 6).alias("coef_variacao"), "volatil")


@check("I09_normalized_movement_text", f"SELECT cnpj, codigo, unid, {_PLAIN_N} AS descricao_normalizada FROM ({_MOVEMENTS_SQL})")
def i09_text(t):
    return pr.unit_movements(t, _cfop(t)).select(
        "cnpj", "codigo", "unid", normalize_description(F.col("descricao")).alias("descricao_normalizada")
    )
