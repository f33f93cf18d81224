"""Commit protocol for work that is done in parts over several runs, by numbered manifests.

A folder holds one subfolder per run and a log of manifests. A manifest names one run, the job it belongs to, the parts
planned and the parts done; the newest committed manifest is the state of the folder, and what it doesn't name doesn't
count. A run begins with a manifest of its own, so parts of an earlier run, finished or broken off, never mix with its own.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from pairloom.sources.paths import child_names, delete_path, path_exists

_SCHEMA = "number bigint, run string, job string, planned map<int, bigint>, done map<int, bigint>"


@dataclass(frozen=True)
class Manifest:
    """``planned`` has the number of inputs of each part, ``done`` the rows written by each part that is committed."""

    number: int
    run: str
    job: str
    planned: dict[int, int]
    done: dict[int, int]

    @property
    def open_parts(self) -> list[int]:
        return sorted(set(self.planned) - set(self.done))


def _folder(path: str, number: int) -> str:
    return f"{path}/manifests/{number:010d}"


def newest(spark: SparkSession, path: str) -> Manifest | None:
    """The newest manifest that was written whole; None if there is none."""
    numbers = sorted((int(n) for n in child_names(spark, f"{path}/manifests") if n.isdigit()), reverse=True)
    for n in numbers:
        if path_exists(spark, f"{_folder(path, n)}/_SUCCESS"):
            return Manifest(**spark.read.schema(_SCHEMA).parquet(_folder(path, n)).first().asDict())
    return None


def commit(spark: SparkSession, path: str, manifest: Manifest) -> Manifest:
    """Write the manifest under the next free number. Of two runs in one folder the later one fails here."""
    taken = [int(n) for n in child_names(spark, f"{path}/manifests") if n.isdigit()]
    held = newest(spark, path)
    if held is not None and held.number > manifest.number:
        raise RuntimeError(f"Another run has written to {path} since")
    manifest = replace(manifest, number=max(taken, default=0) + 1)
    row = (manifest.number, manifest.run, manifest.job, manifest.planned, manifest.done)
    spark.createDataFrame([row], _SCHEMA).coalesce(1).write.mode("errorifexists").parquet(_folder(path, manifest.number))
    return manifest


def begin(spark: SparkSession, path: str, job: str) -> Manifest:
    """A run that is not committed yet: its folder is new, and nothing refers to it."""
    held = newest(spark, path)
    taken = [n for n in child_names(spark, path) if n.startswith("run-")]
    return Manifest(held.number if held else 0, f"run-{len(taken) + 1:06d}-{job[:12]}", job, {}, {})


def forget_other_runs(spark: SparkSession, path: str) -> None:
    """Delete the folders of all runs but the newest committed one, and the manifests before it."""
    held = newest(spark, path)
    if held is None:
        return
    for name in child_names(spark, path):
        if name.startswith("run-") and name != held.run:
            delete_path(spark, f"{path}/{name}")
    for name in child_names(spark, f"{path}/manifests"):
        if name.isdigit() and int(name) < held.number:
            delete_path(spark, f"{path}/manifests/{name}")


def state(spark: SparkSession, path: str) -> DataFrame:
    """The parts of the newest run: how many inputs each has, and the rows of those that are committed (else null)."""
    held = newest(spark, path)
    rows = [(held.run, p, n, held.done.get(p)) for p, n in sorted(held.planned.items())] if held else []
    return spark.createDataFrame(rows, "run string, part int, inputs bigint, rows bigint")
