"""The bundle of seven source DataFrames every builder takes."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from widelines.functions.joins import is_bounded


@dataclass(frozen=True)
class Sources:
    customers: DataFrame
    sales_order: DataFrame
    sales_order_parts: DataFrame
    sales_order_services: DataFrame
    auto_parts: DataFrame
    service: DataFrame
    service_parts: DataFrame
    # size-probe results, keyed by (source names, row bound); shared by builders
    probes: dict = field(default_factory=dict, compare=False, repr=False)

    def as_dict(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self) if f.name != "probes"}

    def with_tables(self, **tables: DataFrame) -> "Sources":
        kept = {k: v for k, v in self.probes.items() if not set(k[0]) & set(tables)}
        return replace(self, **tables, probes=kept)

    def broadcast_if_small(self, df: DataFrame, depends_on: tuple[str, ...],
                           max_rows: int) -> DataFrame:
        """Broadcast ``df`` (derived from ``depends_on``) when its rows are proven few.

        The probe runs once per bundle and bound; every builder reuses it.
        """
        key = (tuple(sorted(depends_on)), max_rows)
        if key not in self.probes:
            self.probes[key] = is_bounded(df, max_rows)
        return F.broadcast(df) if self.probes[key] else df

    def is_small(self, name: str, max_rows: int) -> bool:
        """Whether a source has ``max_rows`` rows at most; probed once per bundle and bound."""
        key = ((name,), max_rows)
        if key not in self.probes:
            self.probes[key] = is_bounded(getattr(self, name), max_rows)
        return self.probes[key]

    def register_views(self, prefix: str = "") -> None:
        """Expose every source as a temporary view (for SQL users)."""
        for name, df in self.as_dict().items():
            df.createOrReplaceTempView(f"{prefix}{name}")
