"""Reading source tables.

Sources are parquet tables addressed by name below a directory
(``{dir}/{name}.parquet``).  Reads are lazy: the scan only materialises the
columns a plan uses and receives its filters (``PushedFilters`` in the plan).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


class MissingColumnsError(ValueError):
    """A source lacks columns a model needs."""


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str,
               required: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Scan one parquet source; fail early if required columns are absent."""
    df = spark.read.parquet(table_path(sf_dir, name))
    require_columns(df, required, name)
    return df


def require_columns(df: DataFrame, required, what: str = "input") -> None:
    have = {c.lower() for c in df.columns}
    missing = [c for c in required if c.lower() not in have]
    if missing:
        raise MissingColumnsError(f"{what} lacks columns {missing}")


def col_or_null(df: DataFrame, name: str, dtype: DataType | str) -> Column:
    """The column if the source has it, else a typed NULL.

    Models are declared against the full source contract; a source that
    carries fewer columns still yields the declared output schema.
    """
    if name.lower() in {c.lower() for c in df.columns}:
        return F.col(name).cast(dtype) if dtype is not None else F.col(name)
    return F.lit(None).cast(dtype)


class Sources:
    """Lazy accessor for the tables of one source directory.

    Each table is opened once per accessor (file listing and footer schema are read
    once); every use shares that relation, which also lets Spark reuse identical
    exchanges over it within one plan.  A new accessor lists the files anew: keep one
    per report or model graph, not per session.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._opened: dict[str, DataFrame] = {}

    def __call__(self, name: str, required=()) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = read_table(self.spark, self.sf_dir, name)
        df = self._opened[name]
        require_columns(df, required, name)
        return df

    def derived(self, name: str, make) -> DataFrame:
        """``make(self)``, planned once per accessor."""
        key = f"{name}()"
        if key not in self._opened:
            self._opened[key] = make(self)
        return self._opened[key]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self(name)
