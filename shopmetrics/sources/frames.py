"""A star schema over caller-supplied DataFrames (loaded Parquet tables,
or small hand-made fixtures in tests)."""

from __future__ import annotations

from pyspark.sql import DataFrame


class TableStar:
    """Same attribute surface as :class:`~shopmetrics.sources.binding.Star`."""

    def __init__(self, **tables: DataFrame):
        for name, df in tables.items():
            setattr(self, name, df)

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    @classmethod
    def from_catalog(cls, spark, database: str, names: list[str]) -> "TableStar":
        """Catalog tables (keeps their bucketing for shuffle-free joins)."""
        return cls(**{n: spark.table(f"{database}.{n}") for n in names})

    @classmethod
    def from_parquet(cls, spark, folder: str, names: list[str]) -> "TableStar":
        return cls(**{n: spark.read.parquet(f"{folder.rstrip('/')}/{n}") for n in names})
