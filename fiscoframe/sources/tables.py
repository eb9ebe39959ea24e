"""Where tables come from: folders partitioned by taxpayer, or any mapping."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscoframe.operators.sets import union_widened
from fiscoframe.session import sized


class Tables(Mapping[str, DataFrame]):
    """Named tables that are opened on first use."""

    def __init__(self, openers: Mapping[str, Callable[[], DataFrame]]):
        self._openers = dict(openers)
        self._open: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = self._openers[name]()
        return self._open[name]

    def __iter__(self):
        return iter(self._openers)

    def __len__(self) -> int:
        return len(self._openers)

    @classmethod
    def in_folder(cls, spark: SparkSession, root: str, names: Iterable[str]) -> Tables:
        names = list(names)
        sized(spark, *[f"{root}/{name}" for name in names])
        return cls({name: (lambda name=name: spark.read.parquet(f"{root}/{name}")) for name in names})


def _footer_schemas(batches):
    """path, types: the columns of each Parquet file as text, from its footer alone."""
    import json

    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyarrow import fs

    for batch in batches:
        paths, types = batch.column("path").to_pylist(), []
        for path in paths:
            files, name = fs.FileSystem.from_uri(path)
            with files.open_input_file(name) as f:
                types.append(json.dumps([(c.name, str(c.type)) for c in pq.read_schema(f)]))
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(types, pa.string())], names=["path", "types"])


def read_mixed(spark: SparkSession, path: str) -> DataFrame:
    """A folder of Parquet files whose columns differ in type or presence, as one frame.

    Tasks read the footers; files of equal columns form a group, which is scanned with its own types; groups are
    united by name, each column in the widest type that holds all of its values (text in the end).
    A folder where all files agree is one plain scan.
    """
    # only the listing: no content is read
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path).select("path")
    footers = listed.repartition("path").mapInArrow(_footer_schemas, "path string, types string").collect()  # a row for each file, as in any scan's listing
    groups: dict[str, list[str]] = {}
    for row in footers:
        groups.setdefault(row["types"], []).append(row["path"])
    if not groups:
        raise FileNotFoundError(f"no Parquet files below {path}")
    return union_widened([spark.read.parquet(*sorted(files)) for _, files in sorted(groups.items())])


def for_taxpayer(df: DataFrame, cnpj: str | None) -> DataFrame:
    """Rows of one taxpayer (partition pruning on disk); none given means all."""
    return df if cnpj is None else df.where(F.col("cnpj") == cnpj)


def list_taxpayers(df: DataFrame) -> DataFrame:
    """Taxpayer ids of a table: all digits, at least eleven of them."""
    return df.select("cnpj").where(F.col("cnpj").rlike("^[0-9]{11,}$")).distinct().orderBy("cnpj")


def tables_of(tables: Mapping[str, DataFrame], cnpj: str) -> list[str]:
    """Names of the tables that hold rows of a taxpayer."""
    return sorted(
        name
        for name, df in tables.items()
        if "cnpj" in df.columns and not for_taxpayer(df, cnpj).isEmpty()
    )


def by_precedence(candidates: Iterable[DataFrame], keys: Iterable[str] = ("cnpj",)) -> DataFrame:
    """Per taxpayer, the rows of the first candidate that has any.

    The rows of the first candidate always stay and are not moved; those of a later one stay where no
    earlier candidate has the key, which a scan of the key columns alone decides.
    """
    keys = list(keys)
    kept: list[DataFrame] = []
    seen: DataFrame | None = None
    for df in candidates:
        kept.append(df if seen is None else df.join(seen, keys, "left_anti"))
        own = df.select(*keys).distinct()
        seen = own if seen is None else seen.union(own)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), kept)


def resolve_name(available: Iterable[str], prefix: str) -> str | None:
    """Grouped table, else plain table, else a table whose name contains the prefix."""
    names = sorted(available)
    lowered = {name.lower(): name for name in names}
    wanted = prefix.lower()
    for candidate in (f"{wanted}_agrupado", wanted):
        if candidate in lowered:
            return lowered[candidate]
    return next((name for name in names if wanted in name.lower()), None)


def first_available(tables: Mapping[str, DataFrame], *prefixes: str) -> DataFrame | None:
    """First prefix that resolves to a table."""
    for prefix in prefixes:
        name = resolve_name(tables.keys(), prefix)
        if name is not None:
            return tables[name]
    return None


def base_year(files: DataFrame) -> DataFrame:
    """Year of the earliest ledger file of each taxpayer."""
    start = "dt_ini" if "dt_ini" in files.columns else "dt_periodo"
    year = F.substring(F.col(start).cast("string"), 1, 4)
    return files.groupBy("cnpj").agg(F.min(year).alias("ano_base"))


