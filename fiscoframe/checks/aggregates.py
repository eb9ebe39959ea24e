"""Aggregations (D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from fiscoframe.checks import check
from fiscoframe.checks.joins import PRICED_SQL, unit_base
from fiscoframe.operators import aggregates as ag
from fiscoframe.plans import units
from fiscoframe.plans.ledger import OWN_CREDIT_CODES, WITHHELD_CODES

_PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"


def _price():
    return F.col("l_extendedprice").cast("decimal(18,2)")


@check(
    "D01_group_sum_count_max",
    f"""SELECT l_suppkey, CAST(SUM({_PRICE}) AS DOUBLE) AS total, count(*) AS n, MAX(l_quantity) AS maior FROM lineitem GROUP BY l_suppkey""",
)
def d01(t):
    return t["lineitem"].groupBy("l_suppkey").agg(
        F.sum(_price()).alias("total"), F.count(F.lit(1)).alias("n"), F.max("l_quantity").alias("maior")
    )


@check(
    "D02_first_non_null",
    """SELECT o_custkey, arg_min(v, k) AS primeiro FROM (SELECT o_custkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS v,
         o_orderkey AS k FROM orders) WHERE v IS NOT NULL GROUP BY 1
       UNION ALL SELECT o_custkey, NULL FROM orders GROUP BY 1 HAVING count(*) FILTER (WHERE o_orderstatus <> 'P') = 0""",
)
def d02(t):
    value = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    return t["orders"].groupBy("o_custkey").agg(ag.first_non_null(value, F.col("o_orderkey")).alias("primeiro"))


@check(
    "D03_sorted_distinct_list",
    """SELECT p_name, string_agg(DISTINCT p_brand, '; ' ORDER BY p_brand) AS lista FROM part GROUP BY p_name""",
)
def d03(t):
    return t["part"].groupBy("p_name").agg(ag.sorted_distinct(F.col("p_brand")).alias("lista"))


@check(
    "D04_flattened_distinct_list",
    """SELECT p_name, string_agg(DISTINCT v, '; ' ORDER BY v) AS lista FROM (SELECT p_name, p_brand AS v FROM part UNION ALL SELECT p_name, p_type FROM part) GROUP BY p_name""",
)
def d04(t):
    rows = t["part"].withColumn("l", F.array("p_brand", "p_type", F.lit(None).cast("string")))
    return rows.groupBy("p_name").agg(ag.sorted_distinct_flat(F.col("l")).alias("lista"))


def _mode_sql(tie: str) -> str:
    return f"""SELECT p_name, first(v ORDER BY n DESC, {tie}) AS moda FROM (SELECT p_name, trim(p_brand) AS v, count(*) AS n FROM part
               WHERE p_brand <> 'Brand#9' GROUP BY 1, 2) GROUP BY p_name"""


def _brands(t):
    return t["part"].select(
        "p_name", F.when(F.col("p_brand") == "Brand#9", F.lit("  ")).otherwise(F.concat(F.lit(" "), "p_brand")).alias("b")
    )


@check("D05_mode_alphabetical", _mode_sql("v"))
def d05(t):
    return ag.modes(_brands(t), ["p_name"], {"moda": "b"}, ag.ALPHABETICAL)


@check("D06_mode_natural", _mode_sql("CAST(substr(v, 7) AS INTEGER)"))
def d06(t):
    return ag.modes(_brands(t), ["p_name"], {"moda": "b"}, ag.NATURAL)


@check("D07_mode_longest", _mode_sql("length(v) DESC, v"))
def d07(t):
    return ag.modes(_brands(t), ["p_name"], {"moda": "b"}, ag.LONGEST)


@check("D05_mode_of_list", _mode_sql("v"))
def d05_list(t):
    lists = _brands(t).groupBy("p_name").agg(F.collect_list("b").alias("l"))
    return lists.select("p_name", ag.mode_of_list(F.col("l")).alias("moda"))


@check(
    "D08_best_description",
    """SELECT p_brand, first(v ORDER BY n DESC, f DESC, length(v) DESC, v) AS melhor FROM
       (SELECT p_brand, p_name AS v, count(*) AS n, arg_min(CASE WHEN p_size > 20 THEN 1 ELSE 0 END + CASE WHEN p_type = 'PROMO' THEN 0 ELSE 1 END, p_partkey) AS f
        FROM part GROUP BY 1, 2) GROUP BY p_brand""",
)
def d08(t):
    rows = t["part"].withColumns(
        {
            "l1": F.when(F.col("p_size") > 20, F.array("p_type")),
            "l2": F.when(F.col("p_type") != "PROMO", F.array("p_type")).otherwise(F.array().cast("array<string>")),
        }
    )
    filled = ag.filled_lists(F.col("l1"), F.col("l2"))
    return ag.best_description(rows, ["p_brand"], "p_name", filled, F.col("p_partkey"), "melhor")


_PHRASE = "CASE WHEN p_size > 40 THEN concat(p_name, ' ', p_type, ' x') WHEN p_size > 20 THEN concat(p_name, '  ', p_type) ELSE p_name END"
_WORDS = "length(regexp_split_to_array(trim(v), '\\s+'))"


@check(
    "D09_representative_description",
    f"""SELECT p_brand, first(v ORDER BY {_WORDS} DESC, v) AS representativa FROM (SELECT p_brand, {_PHRASE} AS v FROM part) GROUP BY p_brand""",
)
def d09(t):
    lists = t["part"].groupBy("p_brand").agg(F.collect_set(F.expr(_PHRASE)).alias("l"))
    return lists.select("p_brand", ag.most_words_of_list(F.col("l")).alias("representativa"))


@check(
    "D10_most_words_first_wins",
    f"""SELECT p_brand, first(v ORDER BY {_WORDS} DESC, p_partkey) AS descricao FROM (SELECT p_brand, p_partkey, {_PHRASE} AS v FROM part) GROUP BY p_brand""",
)
def d10(t):
    return t["part"].groupBy("p_brand").agg(ag.most_words(F.expr(_PHRASE), F.col("p_partkey")).alias("descricao"))


@check(
    "D11_longest_description",
    "SELECT p_brand, first(p_name ORDER BY length(p_name) DESC, p_name) AS descricao FROM part GROUP BY p_brand",
)
def d11(t):
    return t["part"].groupBy("p_brand").agg(ag.longest(F.col("p_name")).alias("descricao"))


@check(
    "D12_unit_with_largest_volume",
    """SELECT l_partkey, first(u ORDER BY v DESC, u) AS unidade FROM (SELECT l_partkey, l_returnflag AS u, SUM(l_quantity) AS v FROM lineitem GROUP BY 1, 2) GROUP BY 1""",
)
def d12(t):
    volumes = t["lineitem"].groupBy("l_partkey", "l_returnflag").agg(F.sum("l_quantity").alias("v"))
    return volumes.groupBy("l_partkey").agg(ag.largest_unit(F.col("l_returnflag"), F.col("v")).alias("unidade"))


@check(
    "D13_most_frequent_unit",
    """SELECT d AS descricao_normalizada, first(u ORDER BY n DESC, u) AS unid_ref FROM (SELECT p_name AS d, l_returnflag AS u, count(*) AS n
         FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2) GROUP BY 1""",
)
def d13(t):
    return units.most_used_unit(units.mean_unit_prices(_movements(t))).drop("cnpj")


def _movements(t):
    return t["lineitem"].join(t["part"], F.col("l_partkey") == F.col("p_partkey")).select(
        F.lit("0").alias("cnpj"),
        F.col("p_name").alias("descricao_normalizada"),
        F.col("l_returnflag").alias("unid"),
        F.when(F.col("l_linestatus") == "O", _price()).otherwise(F.lit(0)).alias("compras"),
        F.when(F.col("l_linestatus") == "F", _price()).otherwise(F.lit(0)).alias("vendas"),
    )


@check(
    "D14_guarded_mean_price_and_volume",
    f"SELECT chave_produto, unidade, pe AS preco_medio_entrada, ps AS preco_medio_saida, vol AS volume_total, n AS ocorrencias FROM ({PRICED_SQL})",
)
def d14(t):
    return unit_base(t).select(
        "chave_produto",
        "unidade",
        "preco_medio_entrada",
        "preco_medio_saida",
        "volume_total",
        "ocorrencias",
    )


@check(
    "D15_mean_of_positive_rows",
    f"""SELECT p_name AS descricao_normalizada, l_returnflag AS unid,
          coalesce(CAST(SUM({_PRICE}) FILTER (WHERE l_linestatus = 'O') AS DOUBLE) / count(*) FILTER (WHERE l_linestatus = 'O'), 0) AS preco_medio_compra,
          coalesce(CAST(SUM({_PRICE}) FILTER (WHERE l_linestatus = 'F') AS DOUBLE) / count(*) FILTER (WHERE l_linestatus = 'F'), 0) AS preco_medio_venda
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""",
)
def d15(t):
    return units.mean_unit_prices(_movements(t)).drop("cnpj", "movimentos")


@check(
    "D16_conditional_sums",
    """SELECT reg_0000_id, CAST(SUM(CASE WHEN cod_aj_apur IN ('RO020023', 'RO020049') THEN vl_aj_apur ELSE 0 END) AS DOUBLE) AS proprio,
         CAST(SUM(CASE WHEN cod_aj_apur IN ('RO020022', 'RO020047') THEN vl_aj_apur ELSE 0 END) AS DOUBLE) AS retido FROM {reg_e111} GROUP BY 1""",
)
def d16(t):
    code, amount = F.col("cod_aj_apur"), F.col("vl_aj_apur")
    return t["reg_e111"].groupBy("reg_0000_id").agg(
        ag.conditional_sum(code, OWN_CREDIT_CODES, amount).alias("proprio"),
        ag.conditional_sum(code, WITHHELD_CODES, amount).alias("retido"),
    )


@check(
    "D17_sum_of_products_by_month",
    """SELECT CAST(date_trunc('month', l_shipdate) AS VARCHAR)[1:10] AS mes, count(*) AS n,
         CAST(SUM(coalesce(CAST(l_quantity AS DECIMAL(18,2)), 0) * coalesce(CASE WHEN l_returnflag = 'A' THEN NULL ELSE CAST(l_tax AS DECIMAL(18,2)) END, 0)) AS DOUBLE) AS valor
       FROM lineitem GROUP BY 1""",
)
def d17(t):
    tax = F.when(F.col("l_returnflag") != "A", F.col("l_tax").cast("decimal(18,2)"))
    product = F.coalesce(F.col("l_quantity").cast("decimal(18,2)"), F.lit(0)) * F.coalesce(tax, F.lit(0))
    return t["lineitem"].groupBy(F.trunc("l_shipdate", "MM").alias("mes")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(product).alias("valor")
    )


@check(
    "D18_distinct_count",
    "SELECT l_suppkey, count(DISTINCT l_partkey) AS produtos FROM lineitem GROUP BY l_suppkey",
)
def d18(t):
    return t["lineitem"].groupBy("l_suppkey").agg(F.count_distinct("l_partkey").alias("produtos"))


@check("D18_distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linenumber FROM lineitem")
def d18_rows(t):
    return t["lineitem"].select("l_suppkey", "l_returnflag", "l_linenumber").distinct()


@check(
    "D19_divergence_flag",
    "SELECT p_name, p_brand, count(DISTINCT nullif(CASE WHEN p_size > 25 THEN '' ELSE p_type END, '')) > 1 AS divergente FROM part GROUP BY 1, 2",
)
def d19(t):
    value = F.when(F.col("p_size") > 25, F.lit("")).otherwise(F.col("p_type"))
    return t["part"].groupBy("p_name", "p_brand").agg(ag.is_divergent(value).alias("divergente"))


@check(
    "D20_formatted_totals",
    f"""SELECT l_partkey, string_agg(concat('[', u, '; ', CAST(floor(v) AS BIGINT), ']'), '; ' ORDER BY u) AS totais FROM (SELECT l_partkey, l_returnflag AS u,
          SUM(CASE WHEN l_linestatus = 'O' THEN {_PRICE} ELSE 0 END) AS v FROM lineitem GROUP BY 1, 2) WHERE v > 0 GROUP BY 1""",
)
def d20(t):
    rows = t["lineitem"].withColumn("v", F.when(F.col("l_linestatus") == "O", _price()).otherwise(F.lit(0)))
    return ag.formatted_totals(rows, ["l_partkey"], "l_returnflag", {"totais": "v"})


@check(
    "D21_header_by_max",
    """SELECT chave_acesso, max(nnf) AS nota, max(co_emitente) AS emitente, CAST(max(dhemi) AS VARCHAR) AS emissao FROM {invoice_lines} GROUP BY 1""",
)
def d21(t):
    return t["invoice_lines"].groupBy("chave_acesso").agg(
        F.max("nnf").alias("nota"), F.max("co_emitente").alias("emitente"), F.max("dhemi").alias("emissao")
    )


_NATURAL = "lower(regexp_extract(c, '^[^0-9]*')), coalesce(TRY_CAST(regexp_extract(c, '[0-9]+') AS BIGINT), -1), c"


@check(
    "D22_code_frequency",
    f"""SELECT p_name, first(c ORDER BY s DESC, {_NATURAL}) AS codigo_padrao, string_agg(concat('[', c, '; ', m, ']'), '; ' ORDER BY {_NATURAL}) AS lista_codigos
        FROM (SELECT p_name, c, CAST(SUM(n) AS BIGINT) AS s, MAX(n) AS m FROM (SELECT p_name, p_brand AS c, p_size AS n FROM part UNION ALL SELECT p_name, p_type, 1 FROM part)
              GROUP BY 1, 2) GROUP BY 1""",
)
def d22(t):
    entry = F.concat(F.lit("["), "p_brand", F.lit("; "), F.col("p_size").cast("string"), F.lit("]"))
    rows = t["part"].select("p_name", F.array(entry, "p_type").alias("codes"))
    return ag.code_frequencies(rows, ["p_name"], "codes")


@check(
    "D23_ordered_parallel_lists",
    """SELECT p_name, string_agg(CAST(p_partkey AS VARCHAR), '; ' ORDER BY p_brand, p_partkey) AS chaves, string_agg(p_brand, '; ' ORDER BY p_brand, p_partkey) AS marcas
       FROM part GROUP BY 1""",
)
def d23(t):
    lists = t["part"].groupBy("p_name").agg(F.sort_array(F.collect_list(F.struct("p_brand", "p_partkey"))).alias("l"))
    return lists.select(
        "p_name",
        F.transform("l", lambda e: e["p_partkey"]).alias("chaves"),
        F.transform("l", lambda e: e["p_brand"]).alias("marcas"),
    )


@check(
    "D24_groups_with_several_rows",
    "SELECT p_partkey, p_name, p_brand FROM part WHERE (p_name, p_brand) IN (SELECT (p_name, p_brand) FROM part GROUP BY p_name, p_brand HAVING count(*) > 1)",
)
def d24(t):
    return ag.groups_with_several(t["part"], ["p_name", "p_brand"]).select("p_partkey", "p_name", "p_brand")
