"""Scalar functions (H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from fiscoframe.checks import check, dbl
from fiscoframe.checks.joins import REF_SQL, unit_base
from fiscoframe.functions import tax, text, values
from fiscoframe.functions.keys import item_key, set_key
from fiscoframe.functions.xml import invoice_items
from fiscoframe.plans import units

# White space removed by the reference of the comparison.
_WS = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13), chr(160))"
_H1 = f"trim(upper(replace(strip_accents(text), 'ß', 'ss')), {_WS})"
_STOP = ", ".join(f"'{w}'" for w in text.STOP_WORDS)


@check("H01_normalized_text", f"SELECT doc_id, md5({_H1}) AS texto, length({_H1}) AS tamanho FROM documents")
def h01(t):
    value = text.normalize(F.col("text"))
    return t["documents"].select("doc_id", F.md5(value).alias("texto"), F.length(value).alias("tamanho"))


@check(
    "H02_normalized_description",
    f"SELECT doc_id, md5(trim(regexp_replace({_H1}, '[\\s\\x0b\\x{{a0}}]+', ' ', 'g'))) AS texto FROM documents",
)
def h02(t):
    return t["documents"].select("doc_id", F.md5(text.normalize_description(F.col("text"))).alias("texto"))


_CODE = "CASE WHEN p_size = 1 THEN '000' WHEN p_size > 40 THEN NULL ELSE concat(' 00', CAST(p_partkey AS VARCHAR), 'ç.', CAST(p_size AS VARCHAR)) END"
_CODE_SPARK = _CODE.replace("VARCHAR", "STRING")


@check(
    "H03_normalized_code",
    f"""SELECT p_partkey, CASE WHEN c IS NULL THEN NULL WHEN ltrim(c, '0') = '' THEN '0' ELSE ltrim(c, '0') END AS codigo
        FROM (SELECT p_partkey, trim(upper(strip_accents({_CODE}))) AS c FROM part)""",
)
def h03(t):
    return t["part"].select("p_partkey", text.normalize_code(F.expr(_CODE_SPARK)).alias("codigo"))


@check("H04_without_dots", f"SELECT p_partkey, replace(trim(upper(strip_accents({_CODE}))), '.', '') AS codigo FROM part")
def h04(t):
    return t["part"].select("p_partkey", text.remove_dots(F.expr(_CODE_SPARK)).alias("codigo"))


@check(
    "H05_normalized_elements",
    "SELECT p_partkey, concat(upper(p_name), '; ', upper(p_brand)) AS lista FROM part",
)
def h05(t):
    lists = F.array(F.concat(F.lit("  "), F.replace("p_name", F.lit("a"), F.lit("à"))), F.lower("p_brand"))
    return t["part"].select("p_partkey", text.normalize_elements(lists).alias("lista"))


@check(
    "H06_search_text",
    f"""SELECT doc_id, md5(array_to_string(list_filter(string_split(regexp_replace(upper(replace(strip_accents(text), 'ß', 'ss')), '[^A-Z0-9]+', ' ', 'g'), ' '),
          lambda w: w <> '' AND w NOT IN ({_STOP})), ' ')) AS texto FROM documents""",
)
def h06(t):
    return t["documents"].select("doc_id", F.md5(text.search_text(F.col("text"))).alias("texto"))


@check(
    "H07_item_key",
    """SELECT DISTINCT md5(concat_ws('|', upper(trim(concat(' ', CAST(p_size AS VARCHAR)))), upper(trim(p_name)), '', upper(p_type), upper(p_brand), '', '')) AS chave FROM part""",
)
def h07(t):
    rows = t["part"].select(
        F.concat(F.lit(" "), F.col("p_size").cast("string")).alias("codigo"),
        F.col("p_name").alias("descricao"),
        F.lit(None).cast("string").alias("descr_compl"),
        F.col("p_type").alias("tipo_item"),
        F.lower("p_brand").alias("ncm"),
        F.lit("").alias("cest"),
        F.lit(None).cast("string").alias("gtin"),
    )
    return rows.select(item_key().alias("chave")).distinct()


@check(
    "H08_set_key",
    "SELECT p_name, md5(string_agg(DISTINCT p_brand, '' ORDER BY p_brand)) AS chave, '' AS vazia FROM part GROUP BY p_name",
)
def h08(t):
    lists = t["part"].groupBy("p_name").agg(F.collect_set("p_brand").alias("l"))
    return lists.select("p_name", set_key(F.col("l")).alias("chave"), set_key(F.array().cast("array<string>")).alias("vazia"))


@check(
    "H09_preferred_gtin",
    "SELECT chave_acesso, seq_nitem, prod_cprod, coalesce(nullif(prod_ceantrib, ''), prod_cean) AS gtin FROM {invoice_lines}",
)
def h09(t):
    rows = t["invoice_lines"]
    return rows.select("chave_acesso", "seq_nitem", "prod_cprod", values.preferred_gtin(rows).alias("gtin"))


@check(
    "H10_net_item_value",
    """SELECT chave_acesso, seq_nitem, prod_cprod, CAST(prod_vprod + coalesce(prod_vfrete, 0) + coalesce(prod_vseg, 0) + coalesce(prod_voutro, 0)
         - coalesce(prod_vdesc, 0) AS DOUBLE) AS valor FROM {invoice_lines}""",
)
def h10(t):
    rows = t["invoice_lines"]
    return rows.select("chave_acesso", "seq_nitem", "prod_cprod", values.net_item_value(rows).alias("valor"))


_MVA_INPUT = """
    SELECT id, CASE unid WHEN 'A' THEN 'S ' WHEN 'R' THEN 'N' END AS flag, CAST(qtd AS DOUBLE) AS mva, 17.5 + num_item AS interna, 12.0 AS inter,
           CASE WHEN num_item > 5 THEN 'RO' ELSE 'SP' END AS emit, 'RO ' AS dest, vl_item, qtd FROM {reg_c170}"""
_MVA = """CASE WHEN trim(flag) = 'S' AND trim(emit) <> 'RO' AND trim(dest) = 'RO'
          THEN (1::DOUBLE + mva / 100::DOUBLE) * (1::DOUBLE - CAST(inter AS DOUBLE) / 100::DOUBLE) / (1::DOUBLE - CAST(interna AS DOUBLE) / 100::DOUBLE) - 1::DOUBLE END"""


def _mva_input(t):
    line = t["reg_c170"]
    return line.select(
        "id",
        F.when(F.col("unid") == "A", "S ").when(F.col("unid") == "R", "N").alias("flag"),
        F.col("qtd").cast("double").alias("mva"),
        (F.lit(17.5) + F.col("num_item")).alias("interna"),
        F.lit(12.0).alias("inter"),
        F.when(F.col("num_item") > 5, "RO").otherwise("SP").alias("emit"),
        F.lit("RO ").alias("dest"),
        "vl_item",
        "qtd",
    )


def _adjusted():
    return tax.adjusted_mva(*[F.col(c) for c in ("flag", "mva", "interna", "inter", "emit", "dest")])


@check("H11_adjusted_margin", f"SELECT id, {_MVA} AS mva_ajustado FROM ({_MVA_INPUT})")
def h11(t):
    return _mva_input(t).select("id", _adjusted().alias("mva_ajustado"))


@check(
    "H12_substitution_base",
    f"""SELECT id, (CAST(vl_item AS DOUBLE) + CAST(qtd AS DOUBLE) - CAST(1.5 AS DOUBLE)) * (CAST(1 AS DOUBLE) + coalesce(a, mva / CAST(100 AS DOUBLE))) AS vbc_st
        FROM (SELECT *, {_MVA} AS a FROM ({_MVA_INPUT}))""",
)
def h12(t):
    nothing = F.lit(None).cast("double")
    base = tax.st_base(
        F.col("vl_item"), nothing, nothing, F.col("qtd"), F.lit(1.5), nothing, F.col("mva"), _adjusted()
    )
    return _mva_input(t).select("id", base.alias("vbc_st"))


_FACTOR = """CASE WHEN unidade = coalesce(unid_ref, 'A') THEN 1.0 WHEN re > 0 AND pe > 0 THEN re / pe WHEN rs > 0 AND ps > 0 THEN rs / ps ELSE 0.0 END"""


def _factors(t):
    base = unit_base(t)
    return units.with_reference(base)


@check("H13_unit_factor", f"SELECT chave_produto, unidade, {_FACTOR} AS fator FROM ({REF_SQL})")
def h13(t):
    return _factors(t).select("chave_produto", "unidade", units.unit_factor("unidade", "unid_ref").alias("fator"))


@check(
    "H14_unit_over_reference_factor",
    f"""SELECT chave_produto, unidade, CASE WHEN unidade = coalesce(unid_ref, 'A') THEN 1.0 WHEN re > 0 AND pe > 0 THEN pe / re
          WHEN rs > 0 AND ps > 0 THEN ps / rs ELSE 0.0 END AS fator FROM ({REF_SQL})""",
)
def h14(t):
    factor = units.unit_factor("unidade", "unid_ref", units.UNIT_OVER_REFERENCE)
    return _factors(t).select("chave_produto", "unidade", factor.alias("fator"))


_WIDE = "CAST(p_size AS DOUBLE) * (p_retailprice - 950) / 4"


@check(
    "H15_quality_status",
    f"""SELECT p_partkey, CASE WHEN f <= 0 THEN 'Erro: Fator <= 0' WHEN f > 1000 OR f < 0.001 THEN 'Alerta: Fator Extremo'
          WHEN p_size > 5 THEN 'Alerta: Fragmentação' ELSE 'OK' END AS status FROM (SELECT p_partkey, p_size, {_WIDE} AS f FROM part)""",
)
def h15(t):
    return t["part"].select("p_partkey", units.quality_status(F.expr(_WIDE), F.col("p_size")).alias("status"))


@check(
    "H16_confidence_and_validation",
    f"""SELECT p_partkey, s AS score, CASE WHEN f <= 0 THEN 'erro' WHEN f > 1000 OR f < 0.001 THEN 'extremo' WHEN s >= 0.85 THEN 'auto_aprovavel'
          WHEN s >= 0.65 THEN 'revisar' ELSE 'baixa_confianca' END AS status
        FROM (SELECT p_partkey, {_WIDE} AS f, CAST(p_size AS DOUBLE) / (CAST(p_size AS DOUBLE) + CAST(1.0 AS DOUBLE)) * CAST(0.6 AS DOUBLE)
                + coalesce(CASE WHEN p_size > 10 THEN CAST(p_size AS DOUBLE) / CAST(50 AS DOUBLE) END, 0) * CAST(0.4 AS DOUBLE) AS s FROM part)""",
)
def h16(t):
    volume = F.col("p_size").cast("double")
    score = units.confidence(volume, F.when(volume > 10, volume / 50.0))
    return t["part"].select(
        "p_partkey", score.alias("score"), units.validation_status(F.expr(_WIDE), score).alias("status")
    )


@check("H17_consistency_score", "SELECT p_name, CAST(n AS DOUBLE) / (CAST(n AS DOUBLE) + 1) AS score FROM (SELECT p_name, count(*) AS n FROM part GROUP BY 1)")
def h17(t):
    n = F.count(F.lit(1))
    return t["part"].groupBy("p_name").agg((n / (n + 1.0)).alias("score"))


@check(
    "H18_null_handling",
    f"SELECT id, {dbl('a')}, b FROM (SELECT id, coalesce(vl_icms, 0) AS a, coalesce(nullif(descr_compl, 'lote A'), 'sem') AS b FROM {{reg_c170}})",
)
def h18(t):
    return t["reg_c170"].select(
        "id",
        F.coalesce("vl_icms", F.lit(0)).alias("a"),
        F.coalesce(F.nullif(F.col("descr_compl"), F.lit("lote A")), F.lit("sem")).alias("b"),
    )


@check(
    "H19_guarded_dates",
    """SELECT id, CAST(CASE WHEN regexp_full_match(dt_e_s, '[0-9]{8}') THEN CAST(TRY_STRPTIME(dt_e_s, '%d%m%Y') AS DATE) END AS VARCHAR) AS dt_e_s,
         concat(substr(dt_doc, 5, 4), '/', substr(dt_doc, 3, 2)) AS periodo, concat(substr(dt_doc, 3, 2), '/', substr(dt_doc, 5, 4)) AS mes,
         CAST(substr(dt_doc, 5, 4) AS INTEGER) AS ano FROM {reg_c100}""",
)
def h19(t):
    day = values.ddmmyyyy(F.col("dt_doc"))
    return t["reg_c100"].select(
        "id",
        values.ddmmyyyy(F.col("dt_e_s")).alias("dt_e_s"),
        values.period(day).alias("periodo"),
        values.period(day, "MM/yyyy").alias("mes"),
        F.year(day).alias("ano"),
    )


_SAME_DAY = "(day(a) = day(b) OR (a = last_day(a) AND b = last_day(b)))"
_MONTHS = f"""CASE WHEN {_SAME_DAY} THEN CAST((year(b) - year(a)) * 12 + month(b) - month(a) AS DOUBLE)
              ELSE CAST((year(b) - year(a)) * 12 + month(b) - month(a) AS DOUBLE) + (day(b) - day(a)) / 31.0 END"""


@check(
    "H19_months_of_activity",
    f"""SELECT co_cnpj_cpf, CAST(CASE WHEN m >= 0 THEN floor(m * 100) ELSE ceil(m * 100) END / 100 AS DOUBLE) AS meses
        FROM (SELECT co_cnpj_cpf, {_MONTHS} AS m FROM (SELECT co_cnpj_cpf, da_inicio_atividade AS a, DATE '1994-02-28' AS b FROM {{dm_pessoa}}))""",
)
def h19_months(t):
    months = values.months_between_2dp(F.lit("1994-02-28").cast("date"), F.col("da_inicio_atividade"))
    return t["dm_pessoa"].select("co_cnpj_cpf", months.cast("double").alias("meses"))


_PAGE = "".join(text._windows_1252())


_BYTES = """CASE WHEN unicode(c) < 2048 THEN [192 + unicode(c) // 64, 128 + unicode(c) % 64]
      WHEN unicode(c) < 65536 THEN [224 + unicode(c) // 4096, 128 + unicode(c) // 64 % 64, 128 + unicode(c) % 64]
      ELSE [240 + unicode(c) // 262144, 128 + unicode(c) // 4096 % 64, 128 + unicode(c) // 64 % 64, 128 + unicode(c) % 64] END"""


@check(
    "H20_code_page",
    f"""SELECT doc_id, array_to_string(list_transform(string_split(text, ''), lambda c: CASE WHEN unicode(c) < 128 THEN c ELSE array_to_string(list_transform({_BYTES},
          lambda b: CASE WHEN b < 160 THEN substr('{_PAGE}', CAST(b - 127 AS INTEGER), 1) ELSE chr(CAST(b AS INTEGER)) END), '') END), '') AS lido FROM (
          SELECT doc_id, concat(text, ' ‘’“”–—…€™ 漢字 😀 􏿿 ', doc_id) AS text FROM documents)""",
)
def h20_code_page(t):
    """All documents, each with typographic marks and characters of three and four bytes behind it."""
    shown = F.concat("text", F.lit(" ‘’“”–—…€™ 漢字 😀 􏿿 "), F.col("doc_id").cast("string"))
    return t["documents"].select("doc_id", text.read_as_windows_1252(shown).alias("lido"))


@check(
    "H20_text_functions",
    """SELECT id, regexp_replace(ltrim(cod_item, '0'), '[ .-]', '', 'g') AS cod, upper(descr_item) NOT LIKE 'SM%' AS outro, rtrim(concat(descr_item, '  ')) AS d,
         substr(cest, 4, 3) AS parte FROM {reg_0200}""",
)
def h20(t):
    return t["reg_0200"].select(
        "id",
        text.clean_item_code(F.col("cod_item")).alias("cod"),
        (~F.upper("descr_item").startswith("SM")).alias("outro"),
        F.rtrim(F.concat("descr_item", F.lit("  "))).alias("d"),
        F.substring("cest", 4, 3).alias("parte"),
    )


@check(
    "H21_regular_expressions",
    """SELECT id, regexp_replace(cest, '[^[:alnum:]]', '', 'g') AS limpo, regexp_extract(cest, '^[0-9][0-9]') AS segmento, regexp_full_match(cod_item, '[0-9]{6}') AS seis
       FROM {reg_0200}""",
)
def h21(t):
    return t["reg_0200"].select(
        "id",
        F.regexp_replace("cest", "[^\\p{Alnum}]", "").alias("limpo"),
        F.regexp_extract("cest", "^[0-9]{2}", 0).alias("segmento"),
        F.col("cod_item").rlike("^[0-9]{6}$").alias("seis"),
    )


@check(
    "H22_case_greatest_and_lists",
    """SELECT chave_acesso, seq_nitem, prod_cprod, CAST(coalesce(greatest(dhemi, dhsaient), dhemi) AS VARCHAR) AS referencia,
         CASE WHEN prod_ncm = prod_ucom THEN 1 ELSE 2 END AS tamanho FROM {invoice_lines}""",
)
def h22(t):
    pair = F.array_distinct(F.array("prod_ncm", "prod_ucom"))
    return t["invoice_lines"].select(
        "chave_acesso", "seq_nitem", "prod_cprod", F.greatest("dhemi", "dhsaient").alias("referencia"), F.size(pair).alias("tamanho")
    )


@check(
    "H23_xml_items",
    f"""SELECT chave_acesso, seq_nitem AS prod_nitem, prod_cprod, CASE WHEN prod_ucom = 'A' THEN 0 ELSE CAST(icms_vbcst AS DOUBLE) END AS icms_vbcst,
          CASE WHEN prod_ucom = 'A' THEN 0 ELSE CAST(icms_vicmsst AS DOUBLE) END AS icms_vicmsst, CAST(0 AS DOUBLE) AS icms_vfcpst FROM {{fato_nfe_detalhe}}""",
)
def h23(t):
    return invoice_items(t["nfe_xml"], "xml", "chave_acesso").select(
        "chave_acesso", "prod_nitem", "prod_cprod", "icms_vbcst", "icms_vicmsst", "icms_vfcpst"
    )


@check(
    "H24_list_coercion",
    """SELECT p_partkey, CASE WHEN p_size > 30 THEN 'a; b' ELSE '' END AS lista, CASE WHEN p_size > 10 THEN p_name ELSE '' END AS escalar FROM part""",
)
def h24(t):
    listed = F.when(F.col("p_size") > 30, F.array(F.lit("a"), F.lit(None), F.lit(""), F.lit("b")))
    scalar = F.when(F.col("p_size") > 10, F.concat(F.lit(" "), "p_name"))
    return t["part"].select(
        "p_partkey", values.as_list(listed, True).alias("lista"), values.as_list(scalar, False).alias("escalar")
    )
