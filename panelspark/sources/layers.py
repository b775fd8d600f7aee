"""Names of the medallion layers of one environment, and their databases."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

ENVIRONMENTS = ("dev", "staging", "test", "prod")
LAYERS = ("bronze", "silver", "gold", "ml_assets")


@dataclass(frozen=True)
class LayerNames:
    """Schema, path and table names. One rule names a model everywhere it is looked up."""

    env: str
    model: str = "propensity"
    project: str = "panel"
    root: str | None = None

    def __post_init__(self):
        if self.env not in ENVIRONMENTS:
            raise ValueError(f"env must be one of {ENVIRONMENTS}, not {self.env!r}")

    def schema(self, layer: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"layer must be one of {LAYERS}, not {layer!r}")
        return f"{self.project}_{layer}_{self.env}"

    def path(self, layer: str) -> str | None:
        return f"{self.root.rstrip('/')}/{self.schema(layer)}" if self.root else None

    def silver_table(self, source: str, serving: bool = False) -> str:
        return f"{source}_{self.model}" + ("_serving" if serving else "")

    def gold_table(self, serving: bool = False) -> str:
        return self.model + ("_serving" if serving else "")

    @property
    def inference_table(self) -> str:
        return f"inference_{self.model}"

    @property
    def registered_model(self) -> str:
        return f"{self.env}_{self.model}"

    def as_dict(self) -> dict[str, str | None]:
        """All names at once, for callers that pass them on as plain text."""
        names = {f"{layer}_schema": self.schema(layer) for layer in LAYERS}
        names |= {f"{layer}_data_storage_path": self.path(layer) for layer in LAYERS}
        for source in ("members", "attributes", "labels"):
            names[f"silver_{source}_table"] = self.silver_table(source)
            names[f"silver_{source}_table_serving"] = self.silver_table(source, serving=True)
        names["gold_table"] = self.gold_table()
        names["gold_table_serving"] = self.gold_table(serving=True)
        names["inference_table"] = self.inference_table
        return names


def create_databases(spark: SparkSession, names: LayerNames) -> list[str]:
    """Create the four databases of an environment. Nothing is created on import."""
    created = []
    for layer in LAYERS:
        location = f" LOCATION '{names.path(layer)}'" if names.root else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {names.schema(layer)}{location}")
        created.append(names.schema(layer))
    return created
