"""Versions, numbering, ordering and set operations (E, F, G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from fiscoframe.checks import check, dbl
from fiscoframe.functions.text import natural_key
from fiscoframe.operators import sets
from fiscoframe.operators.aggregates import with_distinct_count, with_group_size
from fiscoframe.operators.paging import get_page, page_total, last_rows, page_rows
from fiscoframe.operators.predicates import Condition
from fiscoframe.operators.ranking import nulls_last, number_rows, numbered_id
from fiscoframe.operators.versioning import (
    all_versions,
    last_event,
    last_notification,
    last_pendency,
    latest,
    valid_files,
)
from fiscoframe.plans.descriptions import code_suffixes
from fiscoframe.plans.ledger import declared_files_in_force
from fiscoframe.plans.parameters import Params

_NEWEST = "row_number() OVER (PARTITION BY cnpj, dt_ini ORDER BY data_entrega DESC, id DESC)"


@check(
    "E01_latest_version_at_cut_off",
    f"""SELECT id AS reg_0000_id, cnpj, CAST(dt_ini AS VARCHAR) AS dt_ini FROM (SELECT *, {_NEWEST} AS rn FROM {{reg_0000}}
        WHERE data_entrega <= DATE '1999-06-30') WHERE rn = 1""",
)
def e01(t):
    files = t["reg_0000"].withColumnRenamed("id", "reg_0000_id")
    return valid_files(files, "1999-06-30").select("reg_0000_id", "cnpj", "dt_ini")


@check(
    "E02_latest_declared_version",
    """SELECT arg_max(reg_0000_id, (da_entrega_arquivo, reg_0000_id)) AS reg_0000_id, co_cnpj_cpf_declarante AS cnpj, CAST(da_inicio_arquivo AS VARCHAR) AS dt_ini
       FROM {dm_efd_arquivo_valido} WHERE da_entrega_arquivo <= DATE '1999-06-30' GROUP BY co_cnpj_cpf_declarante, da_inicio_arquivo""",
)
def e02(t):
    return declared_files_in_force(t, Params(cut_off="1999-06-30")).select("reg_0000_id", "cnpj", "dt_ini")


@check(
    "E03_all_versions_ranked",
    f"""SELECT id AS reg_0000_id, {_NEWEST} AS ordem, count(*) OVER (PARTITION BY cnpj, dt_ini) AS qtd_envios FROM {{reg_0000}}
        WHERE data_entrega < DATE '1999-06-30' + INTERVAL 1 DAY""",
)
def e03(t):
    files = t["reg_0000"].withColumnRenamed("id", "reg_0000_id")
    return all_versions(files, "1999-06-30").select("reg_0000_id", "ordem", "qtd_envios")


@check(
    "E04_last_event",
    """SELECT chave_acesso, concat(evento_descevento, ' (', strftime(evento_dhevento, '%d/%m/%y %H:%M'), ')') AS desc_evento
       FROM (SELECT *, row_number() OVER (PARTITION BY chave_acesso ORDER BY nsu DESC, evento_dhevento DESC) AS rn FROM {dm_eventos}) WHERE rn = 1""",
)
def e04(t):
    return last_event(t["dm_eventos"])


@check(
    "E05_last_pendency",
    """SELECT id AS id_pendencia, cpf_cnpj, malhas_id FROM (SELECT *, row_number() OVER (PARTITION BY cpf_cnpj, malhas_id, referencia_malhas_id ORDER BY id DESC) AS rn
       FROM {pendencias}) WHERE rn = 1""",
)
def e05(t):
    rows = t["pendencias"].withColumnRenamed("id", "id_pendencia")
    return last_pendency(rows).select("id_pendencia", "cpf_cnpj", "malhas_id")


@check(
    "E05_last_notification",
    """SELECT id_fisconforme, id_notificacao FROM (SELECT *, row_number() OVER (PARTITION BY co_cnpj_notif, id_fisconforme
         ORDER BY coalesce(dt_envio, dt_ciencia) DESC NULLS FIRST, id_notificacao DESC) AS rn FROM {fato_det_notificacao}) WHERE rn = 1""",
)
def e05_notice(t):
    return last_notification(t["fato_det_notificacao"]).select("id_fisconforme", "id_notificacao")


@check(
    "E06_newest_nulls_last",
    """SELECT id_fisconforme, id_notificacao, CAST(dt_ciencia AS VARCHAR) AS dt_ciencia FROM (SELECT *, row_number() OVER (PARTITION BY id_fisconforme
         ORDER BY dt_ciencia DESC NULLS LAST, id_notificacao DESC) AS rn FROM {fato_det_notificacao}) WHERE rn = 1""",
)
def e06(t):
    order = [F.col("dt_ciencia").desc_nulls_last(), F.col("id_notificacao").desc()]
    return latest(t["fato_det_notificacao"], ["id_fisconforme"], order).select(
        "id_fisconforme", "id_notificacao", "dt_ciencia"
    )


@check(
    "E07_distinct_count_over_group",
    """SELECT p_partkey, p_name, n FROM part JOIN (SELECT p_name AS k, count(DISTINCT CASE WHEN p_size > 25 THEN p_brand END) + max(CASE WHEN p_size > 25 THEN 0 ELSE 1 END) AS n
         FROM part GROUP BY 1) ON k = p_name WHERE n > 1""",
)
def e07(t):
    rows = t["part"].withColumn("v", F.when(F.col("p_size") > 25, F.col("p_brand")))
    return with_distinct_count(rows, ["p_name"], "v", "n").where("n > 1").select("p_partkey", "p_name", "n")


def _items(t):
    return t["part"].select(
        F.lit("0").alias("cnpj"),
        F.col("p_brand").alias("cod_normalizado"),
        F.when(F.col("p_size") > 5, F.col("p_name")).alias("descricao"),
        F.lpad(F.col("p_partkey").cast("string"), 8, "0").alias("chave_item_individualizado"),
    )


@check(
    "E08_running_suffix",
    """SELECT chave AS chave_item_individualizado, concat(p_brand, '__', row_number() OVER (PARTITION BY p_brand ORDER BY d NULLS FIRST, chave)) AS cods_desagregados
       FROM (SELECT p_brand, CASE WHEN p_size > 5 THEN p_name END AS d, lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS chave FROM part)""",
)
def e08(t):
    return code_suffixes(_items(t)).select("chave_item_individualizado", "cods_desagregados")


@check(
    "E09_sequential_id",
    """SELECT o_orderkey, concat('item_', row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END
         NULLS LAST, o_orderkey)) AS item_seq_id FROM orders""",
)
def e09(t):
    text = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    rows = t["orders"].withColumn("d", text)
    numbered = number_rows(rows, ["o_custkey"], [*nulls_last(F.col("d")), F.col("o_orderkey")])
    return numbered.select("o_orderkey", numbered_id("item_").alias("item_seq_id"))


@check(
    "E09_sequential_id_of_one_large_group",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_partkey, l_suppkey, l_linenumber) AS seq FROM lineitem",
)
def e09_large(t):
    order = ["l_shipdate", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    rows = t["lineitem"].select(F.lit("0").alias("cnpj"), *order)
    return number_rows(rows, ["cnpj"], [F.col(c) for c in order]).drop("cnpj", "l_shipdate")


@check("E10_group_size", "SELECT p_partkey, count(*) OVER (PARTITION BY p_name) AS unidades FROM part")
def e10(t):
    return with_group_size(t["part"], ["p_name"], "unidades").select("p_partkey", "unidades")


@check(
    "F01_multi_key_sort_nulls_last",
    """SELECT p_partkey, row_number() OVER (ORDER BY CASE WHEN p_size > 10 THEN p_name END NULLS LAST, p_brand NULLS LAST, p_partkey) AS posicao FROM part""",
)
def f01(t):
    rows = t["part"].withColumns({"g": F.lit(0), "d": F.when(F.col("p_size") > 10, F.col("p_name"))})
    order = [*nulls_last(F.col("d")), *nulls_last(F.col("p_brand")), F.col("p_partkey")]
    return number_rows(rows, ["g"], order, "posicao").select("p_partkey", "posicao")


@check(
    "F02_sort_by_expressions",
    """SELECT l_orderkey, l_partkey, l_suppkey, n, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN n IS NULL THEN 1 ELSE 2 END,
         CAST(n AS BIGINT), l_partkey DESC, l_suppkey) AS posicao FROM (SELECT *, CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(l_linenumber * 7 AS VARCHAR) END AS n FROM lineitem)""",
)
def f02(t):
    rows = t["lineitem"].withColumn("n", F.when(F.col("l_returnflag") != "N", (F.col("l_linenumber") * 7).cast("string")))
    order = [
        F.when(F.col("n").isNull(), 1).otherwise(2),
        F.col("n").try_cast("bigint"),
        -F.col("l_partkey"),
        F.col("l_suppkey"),
    ]
    return number_rows(rows, ["l_orderkey"], order, "posicao").select("l_orderkey", "l_partkey", "l_suppkey", "n", "posicao")


@check("F03_page", "SELECT p_partkey, p_name FROM part WHERE p_size >= 10 ORDER BY p_name, p_partkey LIMIT 200 OFFSET 400")
def f03(t):
    page = get_page(t["part"], [Condition("p_size", ">=", "10")], ["p_name", "p_partkey"], 3, columns=["p_partkey", "p_name"])
    return page.rows


@check(
    "F03_page_total",
    "SELECT count(*) AS total FROM part WHERE p_size >= 10",
)
def f03_total(t):
    return page_total(t["part"], [Condition("p_size", ">=", "10")])


@check("F03_page_total_of_nothing", "SELECT count(*) AS total FROM part WHERE p_size > 100000")
def f03_total_of_nothing(t):
    return page_total(t["part"], [Condition("p_size", ">", "100000")])


@check(
    "F04_last_page",
    """SELECT c_custkey FROM customer ORDER BY c_custkey OFFSET (SELECT ((count(*) - 1) // 200) * 200 FROM customer)""",
)
def f04(t):
    return get_page(t["customer"], [], ["c_custkey"], 10**6, columns=["c_custkey"], clamp=True).rows


@check(
    "F05_natural_order",
    """SELECT p_brand, row_number() OVER (ORDER BY CAST(substr(p_brand, 7) AS INTEGER)) AS posicao FROM (SELECT DISTINCT p_brand FROM part)""",
)
def f05(t):
    brands = t["part"].select("p_brand").distinct().withColumn("g", F.lit(0))
    return number_rows(brands, ["g"], [natural_key(F.col("p_brand"))], "posicao").select("p_brand", "posicao")


@check("F06_last_rows", f"SELECT o_orderkey, {dbl('o_totalprice')} FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 200")
def f06(t):
    rows = t["orders"].select("o_orderkey", "o_totalprice")
    return last_rows(rows, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 200)


@check("F06_first_page_of_all", "SELECT n_nationkey, n_name FROM nation ORDER BY n_name, n_nationkey LIMIT 10")
def f06_page(t):
    return page_rows(t["nation"], ["n_name", "n_nationkey"], 0, 10, ["n_nationkey", "n_name"])


@check(
    "G01_diagonal_union",
    "SELECT p_partkey AS k, p_name, CAST(NULL AS VARCHAR) AS c_name FROM part UNION ALL SELECT c_custkey, NULL, c_name FROM customer",
)
def g01(t):
    a = t["part"].select(F.col("p_partkey").alias("k"), "p_name")
    return sets.union_by_name([a, t["customer"].select(F.col("c_custkey").alias("k"), "c_name")])


@check(
    "G02_diagonal_relaxed_union",
    """SELECT CAST(p_partkey AS VARCHAR) AS k, CAST(p_size AS DOUBLE) AS v, p_brand AS b FROM part
       UNION ALL SELECT c_name, c_acctbal, NULL FROM customer""",
)
def g02(t):
    a = t["part"].select(F.col("p_partkey").alias("k"), F.col("p_size").alias("v"), F.col("p_brand").alias("b"))
    return sets.union_widened([a, t["customer"].select(F.col("c_name").alias("k"), F.col("c_acctbal").alias("v"))])


@check(
    "G03_union_all",
    "SELECT chave_acesso, seq_nitem, 'NF-e' AS modelo FROM {fato_nfe_detalhe} UNION ALL SELECT chave_acesso, seq_nitem, 'NFC-e' FROM {fato_nfce_detalhe}",
)
def g03(t):
    branch = lambda name, label: t[name].select("chave_acesso", "seq_nitem", F.lit(label).alias("modelo"))
    return branch("fato_nfe_detalhe", "NF-e").unionByName(branch("fato_nfce_detalhe", "NFC-e"))


@check(
    "G05_first_row_per_key",
    "SELECT l_orderkey, l_linenumber, MIN(l_partkey * 1000 + l_suppkey) AS menor FROM lineitem GROUP BY 1, 2",
)
def g05(t):
    rows = t["lineitem"].withColumn("menor", F.col("l_partkey") * 1000 + F.col("l_suppkey"))
    return sets.first_per_key(rows, ["l_orderkey", "l_linenumber"], [F.col("menor").asc()]).select(
        "l_orderkey", "l_linenumber", "menor"
    )


@check("G06_distinct_keys", "SELECT DISTINCT l_partkey, l_returnflag FROM lineitem")
def g06(t):
    return sets.distinct_keys(t["lineitem"], "l_partkey", "l_returnflag")
