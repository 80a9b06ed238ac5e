"""File system calls of the driver: listing, renaming, small text files.

They go through Hadoop's FileSystem, so any storage Spark can write to works.
Only names, sizes and small JSON documents pass through here, never table data.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._jvm = spark._jvm
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def system(self, path: str):
        return self._path(path).getFileSystem(self._conf)

    def qualified(self, path: str) -> str:
        return self.system(path).makeQualified(self._path(path)).toString()

    def scheme(self, path: str) -> str:
        return self.system(path).getUri().getScheme()

    def exists(self, path: str) -> bool:
        return self.system(path).exists(self._path(path))

    def is_folder(self, path: str) -> bool:
        return self.exists(path) and self.system(path).getFileStatus(self._path(path)).isDirectory()

    def on_shared_mount(self, path: str) -> bool:
        """Is a ``file:`` path below a mount that all machines share?

        Those are named, with commas between, by ``extractkit.sharedMounts``; the scratch folder is shared by contract.
        """
        named = self.spark.conf.get("extractkit.sharedMounts", "").split(",")
        named += [self.spark.conf.get("spark.checkpoint.dir", "") or "", self.spark.sparkContext.getCheckpointDir() or ""]
        place = self.qualified(path)
        return any(place.startswith(self.qualified(mount.strip()).rstrip("/") + "/") for mount in named if mount.strip())

    def make_folder(self, path: str) -> None:
        self.system(path).mkdirs(self._path(path))

    def list(self, path: str) -> list[tuple[str, int, bool]]:
        """``(name, size, is_folder)`` of the direct children, by name."""
        if not self.exists(path):
            return []
        found = self.system(path).listStatus(self._path(path))
        return sorted((s.getPath().getName(), s.getLen(), s.isDirectory()) for s in found)

    def walk(self, path: str, prefix: str = "") -> list[tuple[str, int]]:
        """``(relative path, size)`` of all data files below, by path."""
        out = []
        for name, size, folder in self.list(path):
            if name.startswith(("_", ".")):
                continue
            if folder:
                out.extend(self.walk(f"{path}/{name}", f"{prefix}{name}/"))
            else:
                out.append((prefix + name, size))
        return out

    def rename(self, source: str, target: str) -> None:
        if not self.system(source).rename(self._path(source), self._path(target)):
            raise OSError(f"Cannot rename {source} to {target}")

    def replace(self, source: str, target: str) -> None:
        """Rename a file over another, which readers see either whole or not at all."""
        option = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(option, 1)
        options[0] = option.OVERWRITE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(target).toUri(), self._conf)
        context.rename(self._path(source), self._path(target), options)

    def delete(self, path: str) -> None:
        self.system(path).delete(self._path(path), True)

    def delete_all(self, paths: list[str]) -> None:
        """Delete files of one file system; there may be many, and each takes its time."""
        if not paths:
            return
        system = self.system(paths[0])
        with ThreadPoolExecutor(8) as pool:
            list(pool.map(lambda path: system.delete(self._path(path), False), paths))

    def read_json(self, path: str):
        stream = self.system(path).open(self._path(path))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def write_json(self, path: str, value, *, overwrite: bool = True) -> bool:
        """Write through a temporary file; False when the target exists and stays."""
        temporary = f"{path}.{uuid.uuid4().hex}.tmp"
        stream = self.system(path).create(self._path(temporary), True)
        try:
            stream.write(bytearray((json.dumps(value, indent=1) + "\n").encode("utf-8")))
        finally:
            stream.close()
        if overwrite:
            self.replace(temporary, path)
            return True
        if self.exists(path):
            self.delete(temporary)
            return False
        self.rename(temporary, path)
        return True
