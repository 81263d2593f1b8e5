"""Runs: a folder each, a fingerprint of the configuration, and a status that is written once."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession

SCHEMA_VERSION = 8


@dataclass
class Run:
    run_id: str
    stage: str
    config: dict[str, Any] = field(default_factory=dict)
    schema_version: int = SCHEMA_VERSION

    @property
    def fingerprint(self) -> str:
        return hashlib.sha256(json.dumps({"stage": self.stage, "config": self.config, "schema": self.schema_version}, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


class Workspace:
    """Tables and run records below one folder of any file system that Spark writes to."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _read_json(self, path: str) -> dict[str, Any] | None:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if not p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
            return None
        return json.loads("\n".join(r.value for r in self.spark.read.text(path).collect()))

    def _write_json(self, path: str, value: dict[str, Any]) -> None:
        text = json.dumps(value, sort_keys=True, ensure_ascii=False)
        self.spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("errorifexists").text(path)

    def begin(self, run: Run, resume: bool = False) -> bool:
        """True if the run is new, False if it goes on; another configuration under the same id is an error (DML-8)."""
        path = f"{self.root}/runs/{run.run_id}/begin"
        before = self._read_json(path)
        if before is None:
            self._write_json(path, asdict(run) | {"fingerprint": run.fingerprint, "began_at": datetime.now(timezone.utc).isoformat()})
            return True
        if not resume:
            raise FileExistsError(f"run {run.run_id} exists; resume it or name another")
        if before["fingerprint"] != run.fingerprint:
            raise ValueError(f"run {run.run_id} began with another configuration")
        return False

    def finish(self, run: Run, status: str, **summary: Any) -> None:
        self._write_json(f"{self.root}/runs/{run.run_id}/end", {"run_id": run.run_id, "status": status, "summary": summary, "ended_at": datetime.now(timezone.utc).isoformat()})

    def finished(self, run_id: str) -> dict[str, Any] | None:
        return self._read_json(f"{self.root}/runs/{run_id}/end")

    def write(self, run: Run, name: str, df: DataFrame) -> DataFrame:
        """Write a table of a run once and read it back (DML-6)."""
        path = f"{self.root}/tables/{name}/run_id={run.run_id}"
        df.write.mode("errorifexists").parquet(path)
        return self.spark.read.parquet(path)

    def read(self, name: str, run_id: str | None = None) -> DataFrame:
        path = f"{self.root}/tables/{name}"
        return self.spark.read.parquet(f"{path}/run_id={run_id}") if run_id else self.spark.read.parquet(path)
