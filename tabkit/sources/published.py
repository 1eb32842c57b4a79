"""Tables that are replaced together or not at all.

A publication is a folder of data folders and manifests. A manifest names, for one version, the folder and schema of every table; the
newest one counts. To publish, all tables are written to folders that no manifest names, and then one file, the next manifest, gets its
name. A step that fails before that changes nothing for any reader; a reader that has a version keeps reading its folders,
whatever is published meanwhile. Folders stay until ``retain`` drops the versions that name them.

The manifest is written in full under another name and renamed. Where a rename refuses an existing name, as in HDFS and on local disks, two writers
cannot publish the same version: the second goes on from what the first has published, or is refused if it names the version it started from.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Sequence
from contextlib import suppress

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tabkit.runtime import delete
from tabkit.sources.writers import write_parquet

Step = Callable[[dict[str, DataFrame]], tuple[dict[str, DataFrame], dict]]
_MANIFEST = re.compile(r"v(\d{12})\.json")
TRIES = 20


class Outdated(RuntimeError):
    """Somebody else has published since the version that a step has read."""


class Publication:
    """The tables below a folder that all executors reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def versions(self) -> list[int]:
        """All versions that can be read, oldest first."""
        fs, where = self._fs(f"{self.path}/manifest")
        if not fs.exists(where):
            return []
        found = (_MANIFEST.fullmatch(status.getPath().getName()) for status in fs.listStatus(where))
        return sorted(int(m[1]) for m in found if m)

    def _manifest(self, version: int) -> dict[str, dict]:
        fs, where = self._fs(f"{self.path}/manifest/v{version:012d}.json")
        stream = fs.open(where)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def snapshot(self, version: int | None = None) -> Snapshot:
        """All tables as of a version, the newest by default; it stays the same while others publish."""
        known = self.versions()
        if version is None:
            return Snapshot(self, known[-1] if known else 0, self._manifest(known[-1]) if known else {})
        if version not in known:
            raise KeyError(f"version {version} is not kept")
        return Snapshot(self, version, self._manifest(version))

    def read(self, name: str, version: int | None = None) -> DataFrame:
        return self.snapshot(version).read(name)

    def publish(self, tables: dict[str, DataFrame], drop: Sequence[str] = (), base: int | None = None) -> int:
        """Replace or add tables, drop others, all at once; returns the new version.

        With ``base`` nobody else may have published since that version.
        """
        written: dict[str, dict] = {}
        try:
            for name, df in tables.items():
                folder = f"{self.path}/data/{name}-{uuid.uuid4().hex}"
                written[name] = {"path": folder, "schema": df.schema.jsonValue()}
                write_parquet(df, folder, mode="error")
            for _ in range(TRIES):
                now = self.snapshot()
                if base is not None and now.version != base:
                    raise Outdated(f"version {now.version} was published after version {base}")
                kept = {name: entry for name, entry in now.entries.items() if name not in drop}
                if self._switched(now.version + 1, {**kept, **written}):
                    return now.version + 1
            raise Outdated(f"others published {TRIES} times meanwhile")
        except BaseException:
            for entry in written.values():
                delete(self.spark, entry["path"])
            raise

    def _switched(self, version: int, entries: dict[str, dict]) -> bool:
        """Give the manifest of a version its name; False if that version is there already."""
        fs, draft = self._fs(f"{self.path}/manifest/.draft-{uuid.uuid4().hex}")
        stream = fs.create(draft, False)
        try:
            stream.write(json.dumps(entries, sort_keys=True).encode())
        finally:
            stream.close()
        _, final = self._fs(f"{self.path}/manifest/v{version:012d}.json")
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(draft, final, none)
        except Py4JJavaError as error:
            fs.delete(draft, False)
            if "FileAlreadyExistsException" in str(error.java_exception):
                return False
            raise
        return True

    def retain(self, versions: int) -> list[int]:
        """Keep the newest versions only; folders that only others name are deleted. Returns the versions that went.

        Readers of a version that goes lose its files, so keep as many as the longest reader needs.
        """
        if versions < 1:
            raise ValueError("the newest version stays")
        known = self.versions()
        old, kept = known[:-versions], known[-versions:]
        named = {entry["path"] for v in kept for entry in self._manifest(v).values()}
        unnamed = {entry["path"] for v in old for entry in self._manifest(v).values()} - named
        for v in old:  # first, so that no version names a folder that is gone
            delete(self.spark, f"{self.path}/manifest/v{v:012d}.json")
        for path in unnamed:
            with suppress(Py4JJavaError):
                delete(self.spark, path)
        return old

    def run_step(self, fn: Step, inputs: Sequence[str], outputs: Sequence[str], drop: Sequence[str] = ()) -> dict:
        """Call ``fn`` with the input tables of one version, publish all its result tables at once, drop ``drop``, return its metrics.

        A step may replace a table it reads. If it fails, or another step was published since it has read, all tables stay as they are.
        """
        now = self.snapshot()
        results, metrics = fn({name: now.read(name) for name in inputs})
        if set(results) != set(outputs):
            raise ValueError(f"step returned {sorted(results)}, expected {sorted(outputs)}")
        self.publish(results, [name for name in drop if name not in outputs], base=now.version)
        return metrics


class Snapshot:
    """The tables of one version."""

    def __init__(self, publication: Publication, version: int, entries: dict[str, dict]):
        self.publication, self.version, self.entries = publication, version, entries

    def names(self) -> list[str]:
        return sorted(self.entries)

    def read(self, name: str) -> DataFrame:
        if name not in self.entries:
            raise KeyError(f"version {self.version} has no table {name}")
        entry = self.entries[name]
        return self.publication.spark.read.schema(T.StructType.fromJson(entry["schema"])).parquet(entry["path"])
