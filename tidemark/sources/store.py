"""Small files (control items, manifests, pointers) on any file system that Hadoop reaches.

What several writers may change is a log: numbered files, each made once and never changed, of which the last whole one
counts. The file system decides who makes a number, so a log is lock, history and atomic replacement in one: readers
see the old value or the new one, whenever a writer dies.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    def path(self, name: str) -> str:
        return name if ":/" in name or name.startswith("/") else f"{self.root}/{name}"

    def _open(self, name: str):
        p = self.jvm.org.apache.hadoop.fs.Path(self.path(name))
        return p, p.getFileSystem(self.conf)

    def exists(self, name: str) -> bool:
        p, fs = self._open(name)
        return fs.exists(p)

    def delete(self, name: str) -> None:
        p, fs = self._open(name)
        fs.delete(p, True)

    def read_bytes(self, name: str) -> bytes:
        p, fs = self._open(name)
        stream = fs.open(p)
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def read_json(self, name: str) -> dict | None:
        return json.loads(self.read_bytes(name)) if self.exists(name) else None

    def create(self, name: str, value: dict) -> bool:
        """Write only if nobody has; False if somebody has. The file system decides who is first."""
        p, fs = self._open(name)
        try:
            stream = fs.create(p, False)
        except Exception as e:  # py4j wraps the exception of the file system
            if "FileAlreadyExists" in str(e):
                return False
            raise
        try:
            stream.write(bytearray(json.dumps(value, sort_keys=True).encode()))
        finally:
            stream.close()
        return True

    def write_json(self, name: str, value: dict) -> None:
        """Write over what is there; for files that no reader needs whole at every moment."""
        self.delete(name)
        if not self.create(name, value):
            raise OSError(f"{name} is being written by somebody else")

    def names(self, folder: str) -> list[str]:
        p, fs = self._open(folder)
        return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []

    def latest(self, log: str) -> tuple[int, dict | None]:
        """The last number of a log and the last whole value; (0, None) of an empty one.

        A number whose file was not written to its end has no value, and the one before it counts.
        """
        numbers = sorted((int(n[:-5]) for n in self.names(log) if n.endswith(".json") and n[:-5].isdigit()), reverse=True)
        for n in numbers:
            try:
                return numbers[0], json.loads(self.read_bytes(f"{log}/{n:012d}.json"))
            except ValueError:
                continue
        return (numbers[0] if numbers else 0), None

    def append(self, log: str, after: int, value: dict) -> bool:
        """Put the value behind number `after`; False if somebody else has done so."""
        return self.create(f"{log}/{after + 1:012d}.json", value)

    def _hashed(self, source: str, target: str | None) -> tuple[int, str]:
        """Stream a file through sha256 in the JVM, in small pieces, to the target if there is one."""
        src, from_fs = self._open(source)
        digest = self.jvm.java.security.MessageDigest.getInstance("SHA-256")
        stream = self.jvm.java.security.DigestInputStream(from_fs.open(src), digest)
        if target is None:
            out = self.jvm.java.io.OutputStream.nullOutputStream()
        else:
            dst, to_fs = self._open(target)
            out = to_fs.create(dst, True)
        self.jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 16, True)
        return from_fs.getFileStatus(src).getLen(), bytes(digest.digest()).hex()

    def checksum(self, name: str) -> tuple[int, str]:
        """The bytes and sha256 of a file of any size."""
        return self._hashed(name, None)

    def copy(self, source: str, target: str) -> tuple[int, str]:
        """Copy raw bytes; the source's number of bytes and sha256."""
        return self._hashed(source, target)
