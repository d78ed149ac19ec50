"""Fitted steps: what ``fit`` learned, as plain data that ``transform`` applies."""

from __future__ import annotations

import json
import pkgutil
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

_APPLY: dict[str, Callable[[DataFrame, dict], DataFrame]] = {}


def applies(kind: str):
    """Register the transform side of a step kind."""

    def register(fn):
        _APPLY[kind] = fn
        return fn

    return register


def _transform_of(kind: str) -> Callable[[DataFrame, dict], DataFrame]:
    """The registered transform; operator modules are imported first if need be, since a
    fresh process that loads a plan has not imported those that fitted it."""
    if kind not in _APPLY:
        import millrace.operators as operators

        for module in pkgutil.iter_modules(operators.__path__):
            import_module(f"{operators.__name__}.{module.name}")
        import_module("millrace.plans.run")
    return _APPLY[kind]


@dataclass
class Step:
    kind: str
    params: dict = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        return _transform_of(self.kind)(df, self.params)


@dataclass
class FittedPlan:
    """Steps applied in order; the same object serves batch and streams."""

    steps: list[Step] = field(default_factory=list)

    def add(self, step: Step) -> "FittedPlan":
        self.steps.append(step)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        for step in self.steps:
            df = step.transform(df)
        return df

    def to_json(self) -> str:
        return json.dumps([{"kind": s.kind, "params": s.params} for s in self.steps])

    @staticmethod
    def from_json(text: str) -> "FittedPlan":
        return FittedPlan([Step(d["kind"], d["params"]) for d in json.loads(text)])

    def save(self, spark: SparkSession, path: str) -> None:
        """The plan below ``path``, with a copy of every dictionary table beside it."""
        root, saved = path.rstrip("/"), []
        for step in self.steps:
            params = dict(step.params)
            if "table" in params:
                name = f"tables/{uuid.uuid4().hex}"
                spark.read.parquet(params["table"]).write.parquet(f"{root}/{name}")
                params["table"] = name
            saved.append(Step(step.kind, params))
        row = spark.createDataFrame([(FittedPlan(saved).to_json(),)], "value string")
        row.coalesce(1).write.mode("overwrite").text(f"{root}/plan")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "FittedPlan":
        root = path.rstrip("/")
        plan = FittedPlan.from_json(spark.read.text(f"{root}/plan", wholetext=True).head()[0])
        for step in plan.steps:
            if "table" in step.params:
                step.params["table"] = f"{root}/{step.params['table']}"
        return plan
