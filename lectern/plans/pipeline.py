"""A graph of named stages whose edges are the parameter names of their functions."""

from __future__ import annotations

import inspect
from collections.abc import Callable
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, Observation, functions as F


class Pipeline:
    """Stages are functions of earlier stages' frames; inputs are given when it runs."""

    def __init__(self) -> None:
        self.stages: dict[str, Callable[..., DataFrame]] = {}

    def stage(self, function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        self.stages[function.__name__] = function
        return function

    def upstream(self, name: str) -> list[str]:
        return list(inspect.signature(self.stages[name]).parameters)

    def order(self) -> list[str]:
        """Stages so that each comes after those it reads; CycleError for a circle."""
        graph = {name: [u for u in self.upstream(name) if u in self.stages] for name in self.stages}
        return list(TopologicalSorter(graph).static_order())

    def run(self, keep: Callable[[str, DataFrame], DataFrame] | None = None, **inputs: DataFrame) -> dict[str, DataFrame]:
        """The frame of every stage; keep may write a stage and give what was written. An input that is missing is a KeyError."""
        frames = dict(inputs)
        for name in self.order():
            frame = self.stages[name](**{u: frames[u] for u in self.upstream(name)})
            frames[name] = keep(name, frame) if keep else frame
        return frames


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """df and an observation of its rows, filled by the first action on it."""
    watch = Observation(name)
    return df.observe(watch, F.count(F.lit(1)).alias("rows")), watch
