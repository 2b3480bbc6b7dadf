"""Versions of a table below one folder: each a manifest that names the folders of files it is made of."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import SparkSession


class Versioned:
    """`versions/` holds the manifests, `data/` the files.  A version counts once its manifest stands."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _at(self, place: str):
        """(path, file system) of a place below the root."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{place}")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, place: str) -> list[str]:
        path, fs = self._at(place)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def versions(self) -> list[int]:
        return sorted(int(m[1]) for m in (re.fullmatch(r"v(\d+)\.json", n) for n in self._names("versions")) if m)

    def _manifest(self, version: int) -> dict:
        path, fs = self._at(f"versions/v{version:08d}.json")
        stream = fs.open(path)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        found = json.loads(text)
        found["files"] = {int(number): place for number, place in found["files"].items()}
        return found

    def _commit(self, version: int, manifest: dict) -> None:
        """Put the manifest in place by a rename, the step by which the version comes to count."""
        draft, fs = self._at(f"versions/.draft-{uuid.uuid4().hex}")
        place, _ = self._at(f"versions/v{version:08d}.json")
        stream = fs.create(draft)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        fs.delete(place, False)
        if not fs.rename(draft, place):
            raise RuntimeError(f"{place.toString()} could not be put in place")

    def _table_name(self, manifest: dict) -> str:
        return f"kinweave_{manifest['token']}"

    def _drop_old(self, keep: int) -> list[int]:
        """Delete the manifests of all but the newest versions, and files that none of the others names."""
        found = self.versions()
        old = found[: max(len(found) - max(keep, 1), 0)]
        for version in old:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table_name(self._manifest(version))}")
            place, fs = self._at(f"versions/v{version:08d}.json")
            fs.delete(place, False)
        named = {place for version in self.versions() for place in self._manifest(version)["files"].values()}
        for token in self._names("data"):
            if f"data/{token}" in named:
                continue
            inside = [f"data/{token}/{n}" for n in self._names(f"data/{token}")]
            kept = [p for p in inside if p in named]
            for place in [p for p in inside if p not in named and "=" in p] if kept else [f"data/{token}"]:
                path, fs = self._at(place)
                fs.delete(path, True)
        return old
