"""Parameters shared by the audit queries."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Params:
    """Values a query may use.  ``today`` is explicit so that runs can be repeated."""

    cnpj: str | None = None
    cut_off: date | str | None = None
    start: date | str | None = None
    end: date | str | None = None
    today: date | str | None = None
    item_code: str | None = None
    access_key: str | None = None
    buyers: tuple[str, ...] = field(default=())
    home_state: str = "RO"

    @property
    def limit(self) -> date | str:
        """Cut-off for ledger versions, today if none is given."""
        value = self.cut_off or self.today
        if value is None:
            raise ValueError("cut_off or today is required")
        return value


def one_taxpayer(df: DataFrame, column: str, cnpj: str | None) -> DataFrame:
    """Restrict to one taxpayer before any join; none given means all of them."""
    return df if cnpj is None else df.where(F.col(column) == cnpj)
