"""A named query: a callable (spark, sf_dir) -> DataFrame and, where SQL can express it, the same as SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass
class Registry:
    runs: dict[str, Run] = field(default_factory=dict)
    sql: dict[str, str] = field(default_factory=dict)

    def query(self, name: str, sql: str | None = None) -> Callable[[Run], Run]:
        """Register the decorated callable under ``name``; ``sql`` is its oracle."""
        if name in self.runs:
            raise ValueError(f"query {name} is registered twice")

        def keep(run: Run) -> Run:
            self.runs[name] = run
            if sql:
                self.sql[name] = sql
            return run

        return keep
