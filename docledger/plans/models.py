"""Models: functions from input tables to one output table, run in dependency order."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

from docledger.plans.register import export_type, sales_register
from docledger.sources.commits import claim_entry, drop_unclaimed, fresh_folder, last_entry
from docledger.sources.files import attach_layer
from docledger.sources.sinks import write_register


def layer_name(layer: str) -> str:
    return f"s_{layer}"


@dataclass(frozen=True)
class Model:
    layer: str
    name: str
    inputs: Sequence[str]
    build: Callable[..., DataFrame]

    @property
    def id(self) -> str:
        return f"{layer_name(self.layer)}.{self.name}"


@dataclass
class Project:
    """A set of models. Inputs name a raw table (``raw.sales``) or another model's id."""

    models: dict[str, Model] = field(default_factory=dict)

    def add(self, layer: str, name: str, inputs: Sequence[str], build: Callable[..., DataFrame]) -> Model:
        model = Model(layer, name, tuple(inputs), build)
        self.models[model.id] = model
        return model

    def parents(self) -> dict[str, list[str]]:
        return {m.id: list(m.inputs) for m in self.models.values()}

    def run(self, spark: SparkSession, raw: Mapping[str, DataFrame], root: str) -> dict[str, DataFrame]:
        """Rebuild every model and publish them together under ``root``.

        Models are written to a folder of this run, later ones read the written
        tables, and one log entry makes the run the published one. A model that
        fails half way leaves the last good tables of all models in place.
        """
        tables = dict(raw)
        folder = fresh_folder(root)
        places = {}
        for name in TopologicalSorter(self.parents()).static_order():
            if name in tables:
                continue
            if name not in self.models:
                raise ValueError(f"no table or model named {name}")
            model = self.models[name]
            places[name] = f"{folder}/{layer_name(model.layer)}/{model.name}".removeprefix(f"{root}/")
            write_register(model.build(*[tables[i] for i in model.inputs]), f"{root}/{places[name]}")
            tables[name] = spark.read.parquet(f"{root}/{places[name]}")
        number = 0
        while True:
            last = last_entry(spark, root)
            number = max(number, last[0] if last else 0) + 1
            if claim_entry(spark, root, number, {"run": number, "tables": places}):
                return {name: tables[name] for name in self.models}


def published(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of the last run that came to its end, by model id; none before the first."""
    last = last_entry(spark, root)
    return {name: spark.read.parquet(f"{root}/{path}") for name, path in last[1]["tables"].items()} if last else {}


def attach_published(spark: SparkSession, root: str) -> list[str]:
    """Make the tables of the last run known to SQL by their ids, such as ``s_sale.export_type``."""
    last = last_entry(spark, root)
    places = last[1]["tables"] if last else {}
    for name, path in places.items():
        layer, table = name.split(".", 1)
        attach_layer(spark, layer, {table: f"{root}/{path}"}, f"{root}/catalog")
    return sorted(places)


def drop_unpublished(spark: SparkSession, root: str, older_than: float = 7 * 86_400) -> list[str]:
    """Delete the data of runs that failed or were followed by another, if older than so many seconds."""
    last = last_entry(spark, root)
    kept = {path.split("/")[1] for path in last[1]["tables"].values()} if last else set()
    return drop_unclaimed(spark, root, kept, older_than)


def sale_project() -> Project:
    project = Project()
    project.add("sale", "sales_register", ["raw.sales"], sales_register)
    project.add("sale", "export_type", ["raw.sales"], export_type)
    return project
