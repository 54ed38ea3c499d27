"""A table of batches whose loads are written aside and published by a manifest.

::

    <table>/batch=<name>/version=<id>/...       rows, partitioned as the load asked
    <table>/_history/<kind>/batch=<name>/version=<id>   what later batches need to know of this one
    <table>/_manifest/<number>.json             the published versions; the highest number counts

A load writes a new version beside the one that readers see, and one small file makes it the batch's
version: a load that fails or is still running changes nothing that a reader sees, and a reader keeps to
the versions of the manifest it has read. Manifests are only ever created, so of two loads that
publish at once one finds its number taken and goes on from the other's.

The manifest also holds the stored types of each batch. Batches that were narrowed differently are read
with their own types and widened to the table's.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamline import folders

BATCH, VERSION = "batch", "version"
FIRST, LAST = "first", "last"
_KEPT_MANIFESTS = 5


@dataclass(frozen=True)
class Entry:
    """One published batch."""

    version: str
    types: dict[str, str]  # column → stored type, in the order of the columns
    keys: list[str]  # partition columns
    history: list[str] = field(default_factory=list)  # kinds of history written with it
    digest: str | None = None  # of all rows up to and with this batch
    parent: str | None = None  # the digest of the batch before it, when it was loaded


class PublishError(RuntimeError):
    """Other loads kept publishing first."""


def batch_name(start: str | None, end: str | None) -> str:
    return f"{start or FIRST}_{end or LAST}"


def window_of(name: str) -> tuple[str, str]:
    """First and last day of a batch's window, comparable as texts."""
    parts = name.split("_")
    first, last = (parts[0], parts[-1])
    return {FIRST: "0000-01-01"}.get(first, first), {LAST: "9999-12-31"}.get(last, last)


class BatchTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # --- manifest ---------------------------------------------------------------

    def _numbers(self) -> list[int]:
        names = folders.child_files(self.spark, f"{self.path}/_manifest")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def _manifest(self, number: int) -> str:
        return f"{self.path}/_manifest/{number:012d}.json"

    def entries(self) -> dict[str, Entry]:
        return self._state()[1]

    def _state(self) -> tuple[int, dict[str, Entry]]:
        """The highest number in use and the newest manifest that is written to its end."""
        numbers = self._numbers()
        for number in reversed(numbers):
            try:
                found = json.loads(folders.read_text(self.spark, self._manifest(number)))
            except json.JSONDecodeError:
                continue
            return numbers[-1], {name: Entry(**entry) for name, entry in found["batches"].items()}
        return (numbers[-1] if numbers else 0), {}

    @property
    def published(self) -> bool:
        return bool(self._numbers())

    def before(self, batch: str) -> list[str]:
        """The published batches whose windows end before this one begins, oldest first."""
        start = window_of(batch)[0]
        return sorted((b for b in self.entries() if window_of(b)[1] < start), key=window_of)

    def refuse_overlap(self, batch: str) -> None:
        """Raises if the table has another batch with days in common. One row per batch passes."""
        first, last = window_of(batch)
        for other in self.entries():
            low, high = window_of(other)
            if other != batch and low <= last and first <= high:
                raise ValueError(f"batch {batch} overlaps {other} in {self.path}; load equal or disjoint windows")

    def stale(self) -> list[str]:
        """Batches that were loaded upon rows before them that have changed since: load them again, in order."""
        entries, out, digest = self.entries(), [], None
        for name in sorted(entries, key=window_of):
            if entries[name].digest is not None:
                if entries[name].parent != digest:
                    out.append(name)
                digest = entries[name].digest
        return out

    # --- writing ------------------------------------------------------------------

    def new_version(self) -> str:
        return uuid.uuid4().hex[:12]

    def folder(self, batch: str, version: str) -> str:
        return f"{self.path}/{BATCH}={batch}/{VERSION}={version}"

    def history_folder(self, kind: str, batch: str, version: str) -> str:
        return f"{self.path}/_history/{kind}/{BATCH}={batch}/{VERSION}={version}"

    def publish(self, batch: str, entry: Entry, keep_superseded: bool = False, attempts: int = 20) -> None:
        """Make a written version the batch's. The version it replaces is deleted, unless it is kept for
        readers that still use it (:meth:`vacuum` deletes it then)."""
        folders.make_folder(self.spark, self.folder(batch, entry.version))
        for _ in range(attempts):
            number, entries = self._state()
            replaced = entries.get(batch)
            told = {name: asdict(e) for name, e in {**entries, batch: entry}.items()}
            if folders.create_text(self.spark, self._manifest(number + 1), json.dumps({"batches": told})):
                break
        else:
            raise PublishError(f"{self.path}: {attempts} times another load published first")
        if replaced is not None and not keep_superseded and replaced.version != entry.version:
            self.discard(batch, replaced.version, replaced.history)
        for old in self._numbers()[:-_KEPT_MANIFESTS]:
            folders.delete(self.spark, self._manifest(old))

    def discard(self, batch: str, version: str, history: list[str]) -> None:
        for path in [self.folder(batch, version), *[self.history_folder(k, batch, version) for k in history]]:
            folders.delete(self.spark, path)

    def vacuum(self) -> int:
        """Delete all versions that are not published. Call it while nothing loads or reads older ones."""
        entries, gone = self.entries(), 0
        roots = [self.path, *[f"{self.path}/_history/{k}" for k in folders.child_folders(self.spark, f"{self.path}/_history")]]
        for root in roots:
            for folder in folders.child_folders(self.spark, root):
                if folder.startswith(f"{BATCH}="):
                    name = folder.removeprefix(f"{BATCH}=")
                    kept = f"{VERSION}={entries[name].version}" if name in entries else None
                    for version in folders.child_folders(self.spark, f"{root}/{folder}"):
                        if version != kept:
                            gone += folders.delete(self.spark, f"{root}/{folder}/{version}")
        return gone

    # --- reading ------------------------------------------------------------------

    def read(self, schema: T.StructType, batches: list[str] | None = None) -> DataFrame:
        """The published rows with the given columns and types.

        One scan for each set of stored types, however many batches there are; what passes the driver is one
        path per batch. Columns that a batch lacks are null.
        """
        groups: dict[tuple, list[str]] = {}
        for name, entry in sorted(self.entries().items()):
            if batches is None or name in batches:
                signature = (tuple(entry.types.items()), tuple(entry.keys))
                groups.setdefault(signature, []).append(self.folder(name, entry.version))
        out = None
        for (types, _), paths in groups.items():
            stored = ", ".join(f"`{c}` {kind}" for c, kind in types)
            rows = self.spark.read.schema(stored).option("basePath", self.path).parquet(*paths)
            has = dict(types)
            wide = rows.select(
                *[(F.col(f.name) if f.name in has else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
            )
            out = wide if out is None else out.unionByName(wide)
        return self.spark.createDataFrame([], schema) if out is None else out

    def read_history(self, kind: str, schema: str, batches: list[str]) -> DataFrame:
        """What the given batches left of one kind, with their names as ``batch``."""
        entries = self.entries()
        known = [(b, entries[b].version) for b in batches if b in entries and kind in entries[b].history]
        if not known:
            return self.spark.createDataFrame([], f"{schema}, {BATCH} string")
        root = f"{self.path}/_history/{kind}"
        reader = self.spark.read.schema(f"{schema}, {BATCH} string").option("basePath", root)
        return reader.parquet(*[self.history_folder(kind, b, v) for b, v in known])
