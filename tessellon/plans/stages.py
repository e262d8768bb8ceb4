"""Stages of a build: what each needs, what it makes, and which are done."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tessellon import files


@dataclass(frozen=True)
class Stage:
    """``make`` gets the tables of ``needs`` by name. A temporary stage's table is deleted when all that need it are done."""

    name: str
    needs: tuple[str, ...]
    make: Callable[[dict[str, DataFrame]], DataFrame]
    temporary: bool = False


class Registry:
    """Stages by name; a stage is done when its table below ``root`` and the marker beside it are written."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.stages = spark, root.rstrip("/"), {}

    def add(self, name: str, *needs: str, temporary: bool = False):
        def register(make: Callable[[dict[str, DataFrame]], DataFrame]):
            if name in self.stages:
                raise ValueError(f"two stages {name}")
            self.stages[name] = Stage(name, needs, make, temporary)
            return make

        return register

    def each(self, pattern: str, values: list[str], *needs: str):
        """A stage for every value; ``{}`` in the pattern and in the needs stands for it."""

        def register(make: Callable[[dict[str, DataFrame], str], DataFrame]):
            for v in values:
                self.add(pattern.format(v), *[n.format(v) for n in needs])(lambda t, v=v: make(t, v))
            return make

        return register

    def order(self, *targets: str) -> list[Stage]:
        """The targets and all they need, each after its needs; a cycle or an unknown name is an error."""
        out, open_, seen = [], set(), set()

        def visit(name: str) -> None:
            if name in seen:
                return
            if name in open_:
                raise ValueError(f"stage {name} needs itself")
            if name not in self.stages:
                raise ValueError(f"no stage {name}")
            open_.add(name)
            for n in self.stages[name].needs:
                visit(n)
            open_.discard(name)
            seen.add(name)
            out.append(self.stages[name])

        for t in targets or tuple(self.stages):
            visit(t)
        return out

    def done(self, name: str) -> bool:
        return files.exists(self.spark, f"{self.root}/{name}_done")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")

    def run(self, *targets: str) -> list[str]:
        """Make what is not done yet; returns the names of the stages that ran."""
        wanted, ran = self.order(*targets), []
        for i, stage in enumerate(wanted):
            if self.done(stage.name) or (stage.temporary and not any(stage.name in s.needs and not self.done(s.name) for s in wanted)):
                continue
            stage.make({n: self.table(n) for n in stage.needs}).write.mode("overwrite").parquet(f"{self.root}/{stage.name}")
            files.replace(self.spark, f"{self.root}/{stage.name}_done", "")
            ran.append(stage.name)
            for n in stage.needs:
                if self.stages[n].temporary and self.done(n) and not any(n in s.needs for s in wanted[i + 1 :]):
                    files.delete(self.spark, f"{self.root}/{n}")
                    files.delete(self.spark, f"{self.root}/{n}_done")
        return ran
