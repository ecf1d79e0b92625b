"""Where the layers live, and how a table is found in them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lakestrata.sources.snapshot import read_enum, read_snapshot

# Names of the layers and of the two sources as they appear in paths.
LANDING, RAW, CONTEXT, TRUST = "landing-zone", "raw", "context", "trust"
CATALOGUE, TIMES = "igdb", "hltb"
CATALOGUE_ENUMS, COMMON_ENUMS = "igdb_enums", "aux_enums"


@dataclass(frozen=True)
class TableId:
    """A table of the lake: `<layer>/<api>/<name>`, or `<layer>/<name>` for marts."""

    layer: str
    name: str
    api: str | None = None

    @property
    def folder(self) -> str:
        return "/".join(p for p in (self.layer, self.api, self.name) if p)


@dataclass(frozen=True)
class Lake:
    """The tables under one root folder."""

    spark: SparkSession
    root: str

    def path(self, table: TableId) -> str:
        return f"{self.root}/{table.folder}"

    def control_path(self, table: TableId) -> str:
        return f"{self.path(table)}/control"

    def read(
        self, table: TableId, *, version: int | None = None, required: bool = True
    ) -> DataFrame | None:
        return read_snapshot(self.spark, self.path(table), version, required=required)

    def enum(self, api: str, entity: str, column: str) -> DataFrame | None:
        return read_enum(self.spark, f"{self.root}/{RAW}/{api}", entity, column)
