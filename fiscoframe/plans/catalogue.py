"""The audit queries by name, their parameters and display order."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscoframe.plans import border, invoices, ledger
from fiscoframe.plans.parameters import Params

#: Queries that an extraction runs at a time.
AT_A_TIME = 5


@dataclass(frozen=True)
class AuditQuery:
    """``build`` returns the unsorted plan; sorting is a display matter.

    A query over all taxpayers is normally written to a partitioned table, where a
    total order would cost a shuffle for nothing.
    """

    build: Callable[[Mapping[str, DataFrame], Params], DataFrame]
    order: Callable[[], list[Column]] = field(default=list)
    per_taxpayer: bool = True

    def run(self, tables: Mapping[str, DataFrame], params: Params, ordered: bool = False) -> DataFrame:
        df = self.build(tables, params)
        keys = self.order()
        return df.orderBy(*keys) if ordered and keys else df


def _by(*names: str) -> Callable[[], list[Column]]:
    def keys() -> list[Column]:
        return [F.col(n[1:]).desc() if n.startswith("-") else F.col(n).asc_nulls_last() for n in names]

    return keys


def _border_order() -> list[Column]:
    return [
        F.col("emissao"),
        F.col("cnpj_emit"),
        F.col("nota"),
        F.when(F.col("prod_nitem").isNull(), 1).otherwise(2),
        F.col("prod_nitem").try_cast("bigint"),
    ]


CATALOGUE: dict[str, AuditQuery] = {
    "omissao_saidas": AuditQuery(invoices.omitted_documents, _by("-data_emissao")),
    "e111": AuditQuery(ledger.adjustments, _by("periodo_efd", "codigo_ajuste")),
    "fisconforme": AuditQuery(invoices.audit_pendencies),
    "nfce": AuditQuery(invoices.retail_invoice_detail),
    "nfe": AuditQuery(invoices.invoice_detail),
    "nfe_evento": AuditQuery(invoices.invoice_events, _by("chave_acesso", "evento_dhevento", "nsu_evento")),
    "nfe_dados_st": AuditQuery(invoices.xml_tax_values, _by("chave_acesso", "prod_nitem")),
    "verif_cnpjs": AuditQuery(invoices.sales_to_listed_buyers, per_taxpayer=False),
    "bloco_h": AuditQuery(ledger.inventory, _by("-dt_inv", "codigo_produto_limpo")),
    "c100": AuditQuery(ledger.documents, _by("dt_doc", "ser", "num_doc")),
    "c170": AuditQuery(ledger.items, _by("periodo_efd", "num_doc", "num_item")),
    "c176": AuditQuery(ledger.refund_items),
    "c176_mensal": AuditQuery(ledger.refund_reconciliation, _by("mes_referencia")),
    "c176_v2": AuditQuery(ledger.analytic_items, _by("ano_efd", "periodo_efd", "num_doc", "num_item")),
    "cte": AuditQuery(invoices.transport_documents),
    "dados_cadastrais": AuditQuery(invoices.taxpayer_data),
    "dif_icms": AuditQuery(invoices.under_declared, _by("data_emissao", "num_doc")),
    "dif_icms_v2": AuditQuery(invoices.under_declared_with_context, _by("-data_emissao", "-num_doc")),
    "fronteira": AuditQuery(border.border_items),
    "fronteira_completo": AuditQuery(border.border_analysis, _border_order),
    "reg_0000": AuditQuery(ledger.file_versions, _by("dt_ini", "ordem")),
    "reg_0005": AuditQuery(ledger.taxpayer_register, _by("periodo_efd")),
    "reg_0190": AuditQuery(ledger.unit_register, _by("periodo_efd")),
    "reg_0200": AuditQuery(ledger.product_register, _by("periodo_efd")),
}


@dataclass(frozen=True)
class Outcome:
    query: str
    status: str
    detail: str = ""


def extract(
    tables: Mapping[str, DataFrame],
    params: Params,
    write: Callable[[str, DataFrame], str],
    names: Iterable[str] | None = None,
) -> list[Outcome]:
    """Run queries and save each as a table of its own name, a few at a time, so that one uses cores that another leaves idle.

    Queries without a taxpayer parameter are skipped and a failing query is
    reported without stopping the rest.  Outcomes are in the order of the names.
    """

    def one(name: str) -> Outcome:
        query = CATALOGUE[name]
        if not query.per_taxpayer:
            return Outcome(name, "skipped", "no taxpayer parameter")
        try:
            return Outcome(name, "written", write(name, query.run(tables, params)))
        except Exception as error:  # reported per query, by contract
            return Outcome(name, "failed", f"{type(error).__name__}: {str(error)[:200]}")

    with ThreadPoolExecutor(AT_A_TIME) as threads:
        return list(threads.map(inheritable_thread_target(SparkSession.active())(one), names or CATALOGUE))
