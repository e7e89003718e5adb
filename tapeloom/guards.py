"""Guards: a table of violations either is empty or stops the work with some of its rows."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for the tables of one run under spark.checkpoint.dir, which driver and executors share. Only a local session may do without that setting and gets a temporary folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not (spark.conf.get("spark.master", None) or "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="tapeloom-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


class GuardError(ValueError):
    """A rule that must hold for all rows does not."""


class Stages:
    """Tables of a job, each computed once, written under a folder of the run and read again; rules are counted while a table is written.

    A rule is a condition under which a row breaks it. Its count only decides between none and some, as a task that runs twice
    may count twice; rows to show are looked up in the stored table, and only after a rule has failed.
    """

    def __init__(self, root: str):
        self.root, self.names = root, []

    def stored(self, df: DataFrame, name: str, rules: dict[str, Column] | None = None, shown: list[str] | None = None) -> DataFrame:
        """df, written as table `name`; raises GuardError with the first of rules (message: condition) that a row breaks, and some of its rows (columns `shown`)."""
        if name in self.names:
            raise ValueError(f"stage {name} was written before")
        self.names.append(name)
        path, broken = f"{self.root}/{name}", {}
        if rules:
            seen = Observation(f"{name} of {self.root}")
            df.observe(seen, *(F.count_if(c).alias(f"r{i}") for i, c in enumerate(rules.values()))).write.parquet(path)
            broken = {m: c for i, (m, c) in enumerate(rules.items()) if seen.get.get(f"r{i}")}
        else:
            df.write.parquet(path)
        out = df.sparkSession.read.schema(df.schema).parquet(path)
        for message, condition in broken.items():
            require_empty(out.filter(condition).select(*(shown or out.columns)), message)
            raise GuardError(message)
        return out


def require_empty(violations: DataFrame, message: str, shown: int = 20) -> None:
    """Raise GuardError with at most `shown` rows if violations has any."""
    rows = violations.limit(shown).collect()
    if rows:
        raise GuardError(f"{message}: {[r.asDict() for r in rows]}")
