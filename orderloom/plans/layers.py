"""The layers from raw lines to gold, each written once and then read.

A layer that several queries need is a written table in the shared folder, not
a cached plan: it survives the loss of an executor, cuts the lineage, and later
scans read only the columns they use.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from orderloom.functions.keys import key_clashes, rekeyed
from orderloom.operators import quality, star
from orderloom.operators.cleaning import clean, prepared
from orderloom.schema import BATCH_V1, BATCH_V2, STREAM, Profile
from orderloom.sources.files import rename_by_heading
from orderloom.sources.sizing import scan_bytes, sized_lines, sized_shuffles
from orderloom.sources.tables import write_files
from orderloom.streaming.orders import cleaned_stream


# Numbers tried before the natural keys of members that share a surrogate key.
MOST_NUMBERS = 50

# Layers of order lines, and the codec of their files: a fifth to a third fewer bytes than the session's own.
LINE_LAYERS = ("bronze", "silver", "silver_v1", "fact_orders", "arrivals", "clean_arrivals")
LINE_COMPRESSION = "zstd"


class Layers:
    """Bronze, silver and gold of one raw source under one folder."""

    def __init__(
        self,
        spark: SparkSession,
        raw: Callable[[], DataFrame],
        root: str,
        profile: Profile = BATCH_V2,
        known_customers: DataFrame | None = None,
        fact_by_year: bool = False,
        raw_bytes: Callable[[], int] = lambda: 0,
        count_steps: bool = False,
    ):
        """With count_steps the cleaning steps are counted while bronze is written (see observed)."""
        self.spark = spark
        self.raw = raw
        self.raw_bytes = raw_bytes
        self.root = root.rstrip("/")
        self.profile = profile
        self.count_steps = count_steps
        self.observed: dict[str, int] = {}
        self._schemas: dict[str, T.StructType] = {}
        self._paths: dict[str, str] = {}
        self._partition_by = {"fact_orders": ("order_year",)} if fact_by_year else {}
        table = self.table

        self._known_customers = known_customers
        self._rekeyed = {"dim_customer"} if known_customers is not None else set()

        def fact() -> DataFrame:
            others = {name: self._others(name) for name in sorted(self._rekeyed)}
            rows = star.fact_orders_with(table("silver"), others) if others else star.fact_orders(table("silver"))
            return star.with_order_year(rows) if fact_by_year else rows

        self._recipes: dict[str, Callable[[], DataFrame]] = {
            "bronze": lambda: rename_by_heading(raw()),
            "silver": lambda: clean(table("bronze"), profile),
            "silver_v1": lambda: clean(table("bronze"), BATCH_V1),
            "dim_date": lambda: star.dim_date(table("silver")),
            "dim_customer": lambda: star.dim_customer(table("silver"))
            if known_customers is None
            else star.refreshed_customers(known_customers, table("silver")),
            "dim_product": lambda: star.dim_product(table("silver")),
            "dim_region": lambda: star.dim_region(table("silver")),
            "fact_orders": fact,
            "arrivals": lambda: prepared(table("bronze"), STREAM),
            # From bronze, not from the arrivals: those are written for the stream of files only.
            "clean_arrivals": lambda: cleaned_stream(table("bronze")),
        }

    def path(self, name: str) -> str:
        """Where the layer was written."""
        self.table(name)
        return self._paths[name]

    def partition_by(self, name: str) -> tuple[str, ...]:
        return self._partition_by.get(name, ())

    def table(self, name: str) -> DataFrame:
        """The layer, written first if this run has not done so yet.

        It is read with the schema it was written with, so no footers are
        opened to infer one, and an empty layer reads as such.
        """
        if name not in self._schemas:
            layer = self._recipes[name]()
            schema, observation = layer.schema, Observation() if self.count_steps and name == "bronze" else None
            if observation is not None:
                layer = quality.with_observed(layer, observation, self.profile)
            # A path of its own for each attempt: one that failed is not in the way of the next.
            path = self._new_path(name)
            with sized_shuffles(self.spark, sized_lines(self._input_bytes(name))):
                write_files(layer, path, self.partition_by(name), LINE_COMPRESSION if name in LINE_LAYERS else None)
            self._schemas[name], self._paths[name] = schema, path
            if observation is not None and self.row_count(name):
                self.observed = observation.get
        return self.spark.read.schema(self._schemas[name]).parquet(self._paths[name])

    def _new_path(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:12]}"

    def _others(self, name: str) -> DataFrame:
        """Members of a dimension with keys other than their digest, written: their size is known then."""
        members = star.other_keys(self.table(name), *star.MEMBER_KEYS[name])
        path = self._new_path(f"{name}-others")
        write_files(members, path)
        return self.spark.read.schema(members.schema).parquet(path)

    def resolve_clashes(self) -> dict[str, int]:
        """Gives members that share a surrogate key keys of their own, before the fact is written.

        A dimension with such members is written once more; without any, which is nearly always,
        only their keys are read. Returns how many numbers were tried per dimension concerned.
        """
        tried: dict[str, int] = {}
        for name, (natural, key) in star.MEMBER_KEYS.items():
            stays = self._known_customers if name == "dim_customer" else None
            for number in range(1, MOST_NUMBERS + 1):
                if key_clashes(self.table(name), key).isEmpty():
                    break
                path = self._new_path(name)
                write_files(rekeyed(self.table(name), natural, key, number, stays), path)
                self._paths[name] = path
                self._rekeyed.add(name)
                tried[name] = number
        return tried

    def _input_bytes(self, name: str) -> int:
        """Size of what a layer is made from; the recipe has written it by now."""
        if name == "bronze":
            return self.raw_bytes()
        sources = {
            "silver": "bronze",
            "silver_v1": "bronze",
            "arrivals": "bronze",
            "clean_arrivals": "bronze",
        }
        return scan_bytes(self.table(sources.get(name, "silver")))

    def steps(self) -> list[dict]:
        """Rows before, removed by and after each cleaning step; bronze is not read again for it."""
        return quality.observed_steps(self.observed, self.row_count("silver"), self.table("bronze"), self.profile)

    def flaws(self) -> dict[str, int]:
        """How many lines of bronze lose a value when they are typed, by way."""
        return quality.observed_flaws(self.observed, self.table("bronze"))

    def row_count(self, name: str) -> int:
        """Rows of a written layer; reads no column, only the files' footers."""
        return self.table(name).count()
