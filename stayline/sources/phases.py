"""Tables of a run of phases: versions that are never overwritten, and manifests written last.

A phase writes each table into a folder of its own. When all are written, one manifest, put in
place by a rename, names them, with the versions of the tables that the phase read and the
settings it ran with. Only what a manifest names is ever read, so a run killed in the middle
of a phase leaves the tables of the last whole one. A table is refused when its phase has no
manifest, ran with other settings, or read a version that has been replaced since.
"""

from __future__ import annotations

import dataclasses
import hashlib
import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from stayline.sources.store import matches, save


class StaleTable(ValueError):
    """A stored table that must not be read."""


def settings_mark(settings) -> str:
    """Digest of a dataclass of settings."""
    content = json.dumps(dataclasses.asdict(settings), default=str, sort_keys=True)
    return hashlib.sha256(content.encode()).hexdigest()[:16]


class Phases:
    """Committed tables in a folder. `phase` is open while its tables are written."""

    def __init__(self, spark: SparkSession, folder: str, settings):
        self.spark, self.folder, self.mark = spark, folder.rstrip("/"), settings_mark(settings)
        self.open: dict | None = None

    # -- manifests ----------------------------------------------------------------

    def _path(self, path: str):
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def manifests(self) -> dict[str, dict]:
        """The newest manifest of each phase."""
        out: dict[str, dict] = {}
        paths = matches(self.spark, f"{self.folder}/_phases/*.json")
        for r in self.spark.read.text(paths, wholetext=True).collect() if paths else []:
            manifest = json.loads(r["value"])
            known = out.get(manifest["phase"])
            if known is None or manifest["number"] > known["number"]:
                out[manifest["phase"]] = manifest
        return out

    def owners(self) -> dict[str, dict]:
        """The manifest that names each table."""
        return {name: m for m in sorted(self.manifests().values(), key=lambda m: m["number"]) for name in m["tables"]}

    def _commit(self, manifest: dict) -> None:
        text = json.dumps(manifest, sort_keys=True)
        name = f"{self.folder}/_phases/{manifest['phase']}-{manifest['number']}"
        new, fs = self._path(f"{name}.new")
        out = fs.create(new, True)
        out.write(bytearray(text.encode()))
        out.close()
        if not fs.rename(new, self._path(f"{name}.json")[0]):
            raise OSError(f"could not put {name}.json in place")

    # -- tables -------------------------------------------------------------------

    @contextmanager
    def phase(self, name: str) -> Iterator[None]:
        """Tables kept inside become the phase's result when the block ends without an error."""
        number = 1 + max((m["number"] for m in self.manifests().values()), default=0)
        self.open = {"phase": name, "number": number, "settings": self.mark, "inputs": {}, "tables": {}}
        try:
            yield
            self._commit(self.open)
        finally:
            self.open = None

    def place(self, name: str) -> str:
        """The folder of a new version of a table of the open phase."""
        if self.open is None:
            raise StaleTable(f"no phase is open to keep {name}")
        path = f"{self.folder}/{name}/{uuid.uuid4().hex}"
        self.open["tables"][name] = path
        return path

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = self.place(name)
        save(df, path)
        return self.spark.read.parquet(path)

    def find(self, name: str) -> str:
        """The folder of a table's present version, after checking that it may be read."""
        if self.open is not None and name in self.open["tables"]:
            return self.open["tables"][name]
        owners = self.owners()
        if name not in owners:
            raise StaleTable(f"no finished phase has stored {name}")
        self._check(name, owners, set())
        path = owners[name]["tables"][name]
        if self.open is not None:
            self.open["inputs"][name] = path
        return path

    def _check(self, name: str, owners: dict[str, dict], seen: set[str]) -> None:
        manifest = owners[name]
        if manifest["phase"] in seen:
            return
        seen.add(manifest["phase"])
        if manifest["settings"] != self.mark:
            raise StaleTable(f"phase {manifest['phase']}, which stored {name}, ran with other settings")
        for needed, path in manifest["inputs"].items():
            if needed not in owners or owners[needed]["tables"][needed] != path:
                raise StaleTable(f"phase {manifest['phase']}, which stored {name}, read a version of {needed} that has been replaced")
            self._check(needed, owners, seen)

    def load(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.find(name))

    def unused(self) -> list[str]:
        """Folders of versions that no present manifest names, also those of runs that were killed."""
        named = {p.split("/")[-1] for m in self.manifests().values() for p in m["tables"].values()}
        folders = matches(self.spark, f"{self.folder}/*/*")
        return [p for p in folders if "/_phases/" not in p and "/exports/" not in p and p.split("/")[-1] not in named]
