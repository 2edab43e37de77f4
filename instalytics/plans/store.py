"""Intermediate tables of a run, found again by what they were made from.

``RunStore`` keeps the tables that several features read below the shared
checkpoint folder, in a folder named by a digest of the run's inputs (path,
length and time of every file), its context (clock, region, zones) and the code. A table
is in the store once its entry file ``<name>.json`` is published; an entry names
the folder of its rows, so a half-written table is never read, and of two
sessions that write the same one the first to publish is kept. A later query, or
another session, with the same inputs and context reads the table instead of
computing it; changed inputs or a cleared folder give another digest or no
entry, so nothing stale is read.

``delete`` removes the store; as a context manager it does so at the end. Stores
that are left open are removed when the process ends, unless ``keep``.
"""

from __future__ import annotations

import atexit
import hashlib
import json
import uuid
from collections.abc import Callable
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from . import files
from .materialize import checkpoint_root

_OPEN: dict[str, RunStore] = {}


@lru_cache(maxsize=1)
def _code() -> str:
    """Digest of the package's plans, so that other code does not read what this one wrote."""
    h = hashlib.sha256()
    root = Path(__file__).parent.parent
    for part in ("", "functions", "operators", "plans", "sources"):
        for f in sorted((root / part).glob("*.py")):
            h.update(f.name.encode() + f.read_bytes())
    return h.hexdigest()


def run_key(spark: SparkSession, inputs: list[str], context, owner: str = "") -> str:
    """Digest of the inputs' files, the context and the code. With an ``owner``
    (as an application's id) the store is for that one alone."""
    seen = [files.fingerprint(spark, p) for p in sorted(inputs)]
    return hashlib.sha256(json.dumps([sorted(inputs), seen, str(context), owner, _code()], default=str).encode()).hexdigest()[:32]


class RunStore:
    def __init__(self, spark: SparkSession, key: str, root: str | None = None, keep: bool = False):
        self.spark, self.key, self.keep = spark, key, keep
        self.path = f"{root or checkpoint_root(spark)}/instalytics/store/{key}"
        self.written: list[str] = []
        _OPEN[self.path] = self

    def entries(self) -> dict[str, str]:
        """Name and folder of each table in the store."""
        names = [n for n in files.names(self.spark, self.path) if n.endswith(".json") and not n.startswith("_")]
        return {n[:-5]: files.read_json(self.spark, f"{self.path}/{n}")["folder"] for n in names}

    def _entry(self, name: str) -> dict | None:
        at = f"{self.path}/{name}.json"
        if not files.exists(self.spark, at):
            return None
        entry = files.read_json(self.spark, at)
        # an entry whose rows were cleared away is no entry
        return entry if files.exists(self.spark, f"{self.path}/{entry['folder']}/_SUCCESS") else None

    def folder(self, name: str) -> str | None:
        """The folder of that table's rows, if it is in the store."""
        entry = self._entry(name)
        return entry and entry["folder"]

    def table(self, name: str, build: Callable[[], DataFrame], bucket_by: tuple[str, ...] = ()) -> DataFrame:
        """The table of that name; ``build`` is called only if it is not there.

        With ``bucket_by`` the rows are written in as many buckets of these
        columns as the session has shuffle partitions, sorted inside, and read
        as a bucketed table: a join or aggregate on them needs no exchange of
        this side. They are dealt by the same hash first, so each bucket is one file."""
        entry = self._entry(name)
        if entry is None:
            df = build()
            folder = f"{name}-{uuid.uuid4().hex}"
            path = f"{self.path}/{folder}"
            buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions")) if bucket_by else 0
            if bucket_by:
                scratch = f"w_{folder.replace('-', '_')}"
                (df.repartition(buckets, *bucket_by).write.format("parquet").bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
                 .option("path", path).saveAsTable(scratch))
                self.spark.sql(f"DROP TABLE {scratch}")  # external: the rows stay
            else:
                df.write.parquet(path)
            self.written.append(name)
            mine = {"folder": folder, "buckets": buckets, "bucket_by": list(bucket_by), "schema": df.schema.json()}
            if files.exists(self.spark, f"{self.path}/{name}.json") and self._entry(name) is None:
                files.delete(self.spark, f"{self.path}/{name}.json")
            if not files.publish_json(self.spark, f"{self.path}/{name}.json", mine):
                files.delete(self.spark, path)
            entry = self._entry(name)
        return self._read(entry)

    def _read(self, entry: dict) -> DataFrame:
        path = f"{self.path}/{entry['folder']}"
        if not entry["buckets"]:
            return self.spark.read.schema(StructType.fromJson(json.loads(entry["schema"]))).parquet(path)
        # the session's catalog learns the layout of the files, whichever session wrote them
        view = f"s_{entry['folder'].replace('-', '_')}"
        if not self.spark.catalog.tableExists(view):
            cols = ", ".join(f"`{c}`" for c in entry["bucket_by"])
            fields = ", ".join(f"`{f['name']}` {_ddl(f['type'])}" for f in json.loads(entry["schema"])["fields"])
            self.spark.sql(f"CREATE TABLE {view} ({fields}) USING parquet CLUSTERED BY ({cols}) SORTED BY ({cols}) "
                           f"INTO {entry['buckets']} BUCKETS LOCATION '{path}'")
        return self.spark.table(view)

    def forget(self, keep: tuple[str, ...] = ()) -> None:
        """Delete all tables but those of ``keep``."""
        for name, folder in self.entries().items():
            if name not in keep:
                files.delete(self.spark, f"{self.path}/{name}.json")
                self.spark.sql(f"DROP TABLE IF EXISTS s_{folder.replace('-', '_')}")
                files.delete(self.spark, f"{self.path}/{folder}")

    def delete(self) -> None:
        _OPEN.pop(self.path, None)
        for folder in self.entries().values():
            self.spark.sql(f"DROP TABLE IF EXISTS s_{folder.replace('-', '_')}")
        files.delete(self.spark, self.path)

    def __enter__(self) -> RunStore:
        return self

    def __exit__(self, *exc) -> None:
        self.delete()


def _ddl(kind) -> str:
    return {"long": "bigint", "integer": "int"}.get(kind, kind)


@atexit.register
def _delete_open() -> None:
    for store in list(_OPEN.values()):
        if not store.keep and SparkSession.getActiveSession() is not None:
            try:
                store.delete()
            except Exception:  # the session is already gone: its scratch folder is the cluster's to clear
                return
