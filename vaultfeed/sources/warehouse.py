"""The warehouse as a lazy mapping from table name to its current rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The tables the extracts read.
TABLES = (
    "SAT_UNIDNTFD_PRTY", "XFRMTN", "REF_LKUP",
    "LNK_PREM_TRAN", "SAT_PREM", "LNK_PLCY_CVRG", "SAT_PLCY_DTL", "SAT_CMSN",
    "SAT_PLCY_CVRG_DTL", "HUB_PLCY", "LNK_PLCY_PRTY_ROLE", "SAT_ORG", "SAT_SELL_AGCY",
    "SAT_TRTY_DTL", "LNK_PLCY_CNTCT_PNT", "SAT_PHYS_ADDR", "SAT_PLCY_LMT",
    "SAT_PLCY_CVRG_DED", "SAT_INS_OBJ_PROP", "LNK_PLCY_LOB", "SAT_PLCY_LOB_DTL",
    "SAT_SCHED_MDFR", "SAT_PLCY_CVRG_LMT",
    "SAT_CLM_DTL", "SAT_CVRG_DTL", "LNK_CLM_PLCY", "LNK_CLM_TRAN", "SAT_CLM_TRAN_DTL",
    "SAT_EXPSR_DTL", "SAT_LOB_DTL", "SAT_PLCY_CVRG_SAR_DTL", "SAT_AGCY_ACCT_DTL",
    "LNK_AGCY_ACCT_LGL_AGCY", "SAT_LGL_AGCY_DTL", "SAT_AGCY_ACCT_LGL_AGCY_DTL",
    "SAT_PLCY_LOB_EXPSR",
)


def current_rows(df: DataFrame, end_column: str = "ld_end_dt") -> DataFrame:
    """Keep the open rows of a history table; a table without an end date is all current."""
    if end_column.lower() in (c.lower() for c in df.columns):
        return df.filter(F.col(end_column).isNull())
    return df


def plain_names(df: DataFrame, prefix: str = "") -> DataFrame:
    """Lower-case the column names and drop an installation's own prefix."""
    names = [c.lower().removeprefix(prefix.lower()) for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"column names collide without the prefix {prefix!r}: {sorted(names)}")
    return df.toDF(*names)


class Warehouse(Mapping[str, DataFrame]):
    """Tables by name, opened on first use and limited to their current rows.

    ``prefix`` is what the installation puts before its own columns (hash keys, cell and
    segment codes); the extracts use the column names without it.
    """

    def __init__(
        self,
        open_table: Callable[[str], DataFrame],
        names: tuple[str, ...] = TABLES,
        prefix: str = "",
        end_column: str = "ld_end_dt",
    ):
        self._open = open_table
        self._names = tuple(n.lower() for n in names)
        self._prefix = prefix
        self._end_column = end_column
        self._frames: dict[str, DataFrame] = {}

    @classmethod
    def load(
        cls,
        spark: SparkSession,
        root: str,
        schema: str = "ADV_DB",
        fmt: str = "parquet",
        **layout,
    ) -> Warehouse:
        """Tables stored as ``<root>/<schema>/<table in lower case>``."""
        base = f"{root.rstrip('/')}/{schema.strip().upper()}"
        return cls(lambda name: spark.read.format(fmt).load(f"{base}/{name}"), **layout)

    @classmethod
    def catalog(cls, spark: SparkSession, database: str, **layout) -> Warehouse:
        """Tables of a catalog database."""
        return cls(lambda name: spark.table(f"{database}.{name}"), **layout)

    @classmethod
    def frames(cls, frames: Mapping[str, DataFrame], **layout) -> Warehouse:
        """Tables handed over as DataFrames."""
        by_name = {name.lower(): df for name, df in frames.items()}
        return cls(by_name.__getitem__, names=tuple(by_name), **layout)

    def __getitem__(self, name: str) -> DataFrame:
        key = name.lower()
        if key not in self._names:
            raise KeyError(name)
        if key not in self._frames:
            df = plain_names(self._open(key), self._prefix)
            self._frames[key] = current_rows(df, self._end_column)
        return self._frames[key]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)

    def register_views(self, names: tuple[str, ...] | None = None) -> None:
        """Expose tables to SQL text under their own names."""
        for name in names or self._names:
            self[name].createOrReplaceTempView(name)
