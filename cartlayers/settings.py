"""Where a run reads from and writes to."""

from __future__ import annotations

from dataclasses import dataclass

LOG_TABLE = "quality_log"


@dataclass(frozen=True)
class Settings:
    """Names and formats of one installation.

    `catalog` is optional: without it the three layers are databases of the session catalog.
    `file_prefix` goes in front of the landing file names that carry the data set's own prefix.
    `storage_path` holds the files of all layers; without it each layer's are in its database's folder.
    """

    raw_path: str = "raw_files"
    file_prefix: str = ""
    catalog: str | None = None
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    table_format: str = "parquet"
    storage_path: str | None = None

    def database(self, layer: str) -> str:
        name = {"bronze": self.bronze, "silver": self.silver, "gold": self.gold}[layer]
        return f"{self.catalog}.{name}" if self.catalog else name

    def table(self, layer: str, name: str) -> str:
        return f"{self.database(layer)}.{name}"

    def landing_path(self, file: str) -> str:
        return f"{self.raw_path.rstrip('/')}/{self.landing_file(file)}"

    def landing_file(self, file: str) -> str:
        return file.format(prefix=self.file_prefix)

    @property
    def log_table(self) -> str:
        return self.table("gold", LOG_TABLE)
