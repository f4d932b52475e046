"""Runs on a file system that driver and executors share, through Hadoop's FileSystem.

A run is written in a staging folder of its own and becomes visible by one rename.  Who may rename is settled by a marker that is
created only if it is absent: of two writers one wins, and a writer that comes back after another has finished loses.  The marker
names the winner's staging folder, so what a winner was killed in the middle of is finished by whoever looks next.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from hashlib import sha256
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

MANIFEST = "run_manifest.json"


class Files:
    """The few operations on shared files that runs need."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(self._conf)
        return fs.makeQualified(p), fs

    def exists(self, path: str) -> bool:
        p, fs = self._at(path)
        return fs.exists(p)

    def names(self, folder: str) -> list[str]:
        p, fs = self._at(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def make(self, folder: str) -> None:
        p, fs = self._at(folder)
        fs.mkdirs(p)

    def read(self, path: str) -> str:
        p, fs = self._at(path)
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Creates a file with this text; False, and nothing changes, if there is one already.

        The file gets its text before it gets its name, so no reader sees half of it.
        """
        p, fs = self._at(path)
        draft, _ = self._at(f"{path}.{uuid.uuid4().hex}.draft")
        fs.mkdirs(p.getParent())
        self._put(fs, draft, text)
        try:
            if fs.getScheme() == "file":  # a hard link is never put over another file
                nio = self._jvm.java.nio.file
                nio.Files.createLink(nio.Path.of(p.toUri()), nio.Path.of(draft.toUri()))
                return True
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), self._conf).rename(draft, p, self._renames("NONE"))
            return True
        except Py4JJavaError as error:
            if fs.exists(p) and "AlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        finally:
            if fs.exists(draft):
                fs.delete(draft, False)

    def replace(self, path: str, text: str) -> None:
        """Puts a file in place of what was there, in one step."""
        p, fs = self._at(path)
        draft, _ = self._at(f"{path}.{uuid.uuid4().hex}.draft")
        fs.mkdirs(p.getParent())
        self._put(fs, draft, text)
        self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), self._conf).rename(draft, p, self._renames("OVERWRITE"))

    def rename(self, old: str, new: str) -> bool:
        """Moves a folder to a name that is free; False if there is nothing to move."""
        p, fs = self._at(old)
        q, _ = self._at(new)
        if not fs.exists(p) or fs.exists(q):
            return False
        return fs.rename(p, q)

    def delete(self, path: str) -> None:
        p, fs = self._at(path)
        fs.delete(p, True)

    def _put(self, fs, path, text: str) -> None:
        stream = fs.create(path, True)
        try:
            stream.write(text.encode())
        finally:
            stream.close()

    def _renames(self, kind: str):
        option = self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
        values = self._jvm.java.lang.reflect.Array.newInstance(option, 1)
        values[0] = self._jvm.java.lang.Enum.valueOf(option, kind)
        return values


def as_url(root: str | Path) -> str:
    return f"file://{root.resolve()}" if isinstance(root, Path) else root.rstrip("/")


@dataclass
class Run:
    """A run that is being written; tables and files go below path."""

    store: RunStore
    run_id: str
    path: str

    def at(self, name: str) -> str:
        return f"{self.path}/{name}"

    def put(self, name: str, text: str) -> None:
        if not self.store.files.create(self.at(name), text):
            raise FileExistsError(self.at(name))

    def put_json(self, name: str, value: object) -> None:
        self.put(name, json.dumps(value, ensure_ascii=False, indent=2, default=str))

    def snapshot(self, contracts: Sequence[str]) -> dict[str, str]:
        """Copies contracts (paths of any file system) into the run; their names with their digests."""
        found = {}
        for c in contracts:
            text, name = self.store.files.read(c), c.rsplit("/", 1)[-1]
            self.put(f"contracts/{name}", text)
            found[name] = sha256(text.encode()).hexdigest()
        return found

    def finish(self, **sections: object) -> str:
        """Writes the manifest and publishes the run; its final path.  Raises if another writer has published this id."""
        self.put_json(MANIFEST, {"run_id": self.run_id, "finished_at": dt.datetime.now(dt.UTC), **sections})
        if not self.store.files.create(self.store.marker(self.run_id), self.path):
            self.store.files.delete(self.path)
            raise FileExistsError(f"{self.run_id} has been published by another writer")
        return self.store.open(self.run_id)

    def abandon(self) -> None:
        self.store.files.delete(self.path)


class RunStore:
    """Runs below a root: runs/<id> are finished ones, staging/ those being written, done/ the markers, pointers/ the pointers."""

    def __init__(self, spark: SparkSession, root: str | Path):
        self.files, self.root = Files(spark), as_url(root)

    def marker(self, run_id: str) -> str:
        return f"{self.root}/done/{run_id}"

    def begin(self, run_id: str) -> Run:
        """A run with this id, which must not have been published; several may write at a time, the first to finish wins."""
        if not run_id or "/" in run_id or run_id.startswith("."):
            raise ValueError(f"no run id: {run_id!r}")
        if self.files.exists(self.marker(run_id)):
            raise FileExistsError(f"{run_id} has been published")
        path = f"{self.root}/staging/{run_id}-{uuid.uuid4().hex}"
        self.files.make(path)
        return Run(self, run_id, path)

    def open(self, run_id: str) -> str:
        """The path of a published run; finishes the rename that its writer may have been killed before."""
        final = f"{self.root}/runs/{run_id}"
        if not self.files.exists(f"{final}/{MANIFEST}"):
            if not self.files.exists(self.marker(run_id)):
                raise FileNotFoundError(f"{run_id} has not been published")
            self.files.make(f"{self.root}/runs")
            self.files.rename(self.files.read(self.marker(run_id)), final)
            if not self.files.exists(f"{final}/{MANIFEST}"):
                raise FileNotFoundError(f"{run_id} has lost its files")
        return final

    def latest(self, prefix: str = "") -> str | None:
        """The path of the last published run by id."""
        ids = [i for i in self.files.names(f"{self.root}/done") if i.startswith(prefix) and not i.endswith(".draft")]
        return self.open(max(ids)) if ids else None

    def manifest(self, run_id: str) -> dict:
        return json.loads(self.files.read(f"{self.open(run_id)}/{MANIFEST}"))

    def publish(self, pointer: str, run_id: str, **value: object) -> None:
        """Points a name at a published run, in one step."""
        self.files.replace(f"{self.root}/pointers/{pointer}.json", json.dumps({"run_id": run_id, "path": self.open(run_id), **value}, default=str))

    def resolve(self, pointer: str, **lineage: object) -> dict:
        """A pointer's run, which must have passed and be of the versions asked for."""
        from monsoon.sources.contracts import GateError

        value = json.loads(self.files.read(f"{self.root}/pointers/{pointer}.json"))
        wrong = {k: value.get(k) for k, v in ({"status": "PASS"} | lineage).items() if value.get(k) != v}
        if wrong:
            raise GateError(f"the run of {pointer} is another than asked for: {wrong}")
        return value
