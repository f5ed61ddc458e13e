"""Warehouse tables over JDBC. The driver jar and the address are configuration."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Warehouse:
    url: str
    user: str
    password: str = field(repr=False)
    driver: str | None = None
    # Upper bound on simultaneous connections.
    connections: int = 64
    batch_rows: int = 10_000

    def options(self, table: str) -> dict[str, str]:
        options = {
            "url": self.url,
            "dbtable": table,
            "user": self.user,
            "password": self.password,
            "numPartitions": str(self.connections),
            "batchsize": str(self.batch_rows),
        }
        if self.driver:
            options["driver"] = self.driver
        return options


def kpi_defaults(kpis: DataFrame) -> DataFrame:
    """Row as the warehouse wants it: missing numbers as 0, missing texts as ``{}``."""
    defaults = {}
    for f in kpis.schema.fields:
        if f.dataType.typeName() in ("double", "float", "long", "integer"):
            defaults[f.name] = F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType))
        elif f.dataType.typeName() == "string":
            defaults[f.name] = F.coalesce(F.col(f.name), F.lit("{}"))
    return kpis.withColumns(defaults)


def batch_columns(kpis: DataFrame, batch_id: int, query: str) -> DataFrame:
    """Rows with the query and the micro-batch they come from. A batch that is repeated after a failure
    appends its rows again; these columns tell them apart, as a key or by a reader."""
    return kpis.withColumns({"query_id": F.lit(query), "batch_id": F.lit(batch_id)})


def append_rows(df: DataFrame, warehouse: Warehouse, table: str) -> None:
    df.write.format("jdbc").options(**warehouse.options(table)).mode("append").save()


def replace_table(df: DataFrame, warehouse: Warehouse, table: str) -> None:
    """New content under the old definition: truncating keeps types, keys and grants.

    Rows are dealt out to the connections by a shuffle, so that the limit slows down the writing
    only and not the stage that computes them.
    """
    (df.repartition(warehouse.connections).write.format("jdbc").options(**warehouse.options(table)).option("truncate", "true")
     .mode("overwrite").save())
