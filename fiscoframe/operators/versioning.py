"""Latest version of something per key.

``row_number() = 1`` is planned with a group limit on both sides of the shuffle:
each task forwards only its own best row per key, so a key that holds a third of
all rows still sends one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in the given order (which should be total)."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where(F.col("__rank") == 1).drop("__rank")


def submitted_until(df: DataFrame, cut_off, delivered: str = "data_entrega", whole_day: bool = False) -> DataFrame:
    """Versions delivered up to the cut-off; ``whole_day`` includes all of that day."""
    limit = F.lit(cut_off).cast("date")
    if whole_day:
        return df.where(F.col(delivered) < F.date_add(limit, 1))
    return df.where(F.col(delivered) <= limit)


def valid_files(
    files: DataFrame,
    cut_off,
    keys: Sequence[str] = ("cnpj", "dt_ini"),
    delivered: str = "data_entrega",
    identifier: str = "reg_0000_id",
) -> DataFrame:
    """Ledger files in force at the cut-off: one per taxpayer and period."""
    known = submitted_until(files, cut_off, delivered)
    return latest(known, keys, [F.col(delivered).desc(), F.col(identifier).desc()])


def all_versions(
    files: DataFrame,
    cut_off,
    keys: Sequence[str] = ("cnpj", "dt_ini"),
    delivered: str = "data_entrega",
    identifier: str = "reg_0000_id",
) -> DataFrame:
    """Every version with its rank (newest first) and the number of submissions.

    A key is one taxpayer and one period, so its rows are the submissions of one month's file:
    a handful, which one window ranks and counts in one shuffle.
    """
    known = submitted_until(files, cut_off, delivered, whole_day=True)
    of_key = Window.partitionBy(*keys)
    newest_first = of_key.orderBy(F.col(delivered).desc(), F.col(identifier).desc())
    return known.withColumn("ordem", F.row_number().over(newest_first)).withColumn("qtd_envios", F.count(F.lit(1)).over(of_key))


def last_event(events: DataFrame) -> DataFrame:
    """Newest event per document as text, by sequence number then time."""
    newest = latest(events, ["chave_acesso"], [F.col("nsu").desc_nulls_first(), F.col("evento_dhevento").desc_nulls_first()])
    return newest.select(
        "chave_acesso",
        F.concat(
            F.col("evento_descevento"),
            F.lit(" ("),
            F.date_format("evento_dhevento", "dd/MM/yy HH:mm"),
            F.lit(")"),
        ).alias("desc_evento"),
    )


def last_pendency(pendencies: DataFrame) -> DataFrame:
    """Newest pendency per taxpayer, audit type and reference."""
    return latest(
        pendencies, ["cpf_cnpj", "malhas_id", "referencia_malhas_id"], [F.col("id_pendencia").desc()]
    )


def last_notification(notifications: DataFrame) -> DataFrame:
    """Newest notification per pendency: sent date, else seen date."""
    moment = F.coalesce("dt_envio", "dt_ciencia")
    return latest(
        notifications,
        ["co_cnpj_notif", "id_fisconforme"],
        [moment.desc_nulls_first(), F.col("id_notificacao").desc()],
    )
