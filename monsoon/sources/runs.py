"""Immutable runs, digests and manifests."""

from __future__ import annotations

import hashlib
import shutil
import subprocess
import sys
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monsoon.sources.tables import write_json


def new_run(root: str | Path, run_id: str) -> Path:
    """A folder that must not exist yet."""
    path = Path(root) / run_id
    path.mkdir(parents=True, exist_ok=False)
    return path


def latest_run(root: str | Path, prefix: str, manifest: str = "run_manifest.json") -> Path | None:
    """The last run by id that has its manifest."""
    runs = [p for p in Path(root).glob(f"{prefix}*") if (p / manifest).is_file()]
    return max(runs, key=lambda p: p.name, default=None)


def sha256_file(path: str | Path) -> str:
    found = hashlib.sha256()
    with open(path, "rb") as file:
        while block := file.read(1 << 20):
            found.update(block)
    return found.hexdigest()


def sha256_tree(path: str | Path) -> str:
    """Of a folder of part files: names' order doesn't matter, contents do."""
    parts = sorted(sha256_file(p) for p in Path(path).rglob("*.parquet")) if Path(path).is_dir() else [sha256_file(path)]
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def content_digest(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row (n_rows, digest) that is the same for the same rows in any order and partitioning.

    Row hashes are summed in two independent keys, so that the table is never sorted or gathered.
    """
    columns = list(columns or df.columns)
    text = [F.coalesce(F.col(c).cast("string"), F.lit("<NULL>")) for c in columns]
    kinds = hashlib.sha256(repr([(c, dict(df.dtypes)[c]) for c in columns]).encode()).hexdigest()
    total = lambda seed: F.coalesce(F.sum(F.xxhash64(F.lit(seed), *text).cast("decimal(38,0)")), F.lit(0)).cast("string")
    return df.agg(F.count("*").alias("n_rows"), F.sha2(F.concat_ws("|", F.lit(kinds), F.count("*").cast("string"), total(1), total(2)), 256).alias("digest"))


def verify_hash(path: str | Path, expected: str) -> None:
    if sha256_tree(path) != expected:
        raise ValueError(f"{path} has changed since it was published")


def snapshot(contracts: Sequence[str | Path], run: str | Path) -> dict[str, str]:
    """Copies contracts into a run and returns their digests."""
    target = Path(run) / "contracts"
    target.mkdir(parents=True, exist_ok=True)
    return {Path(c).name: sha256_file(shutil.copy2(c, target)) for c in contracts}


def tests_pass(path: str, timeout: int = 1800) -> None:
    """Runs a test folder in a process of its own; raises if it fails."""
    done = subprocess.run([sys.executable, "-m", "pytest", "-q", "-x", path], capture_output=True, text=True, timeout=timeout)
    if done.returncode:
        raise RuntimeError(f"the tests failed:\n{done.stdout[-2000:]}")


def manifest(run: str | Path, **sections: object) -> Path:
    path = Path(run) / "run_manifest.json"
    write_json(sections, path)
    return path
