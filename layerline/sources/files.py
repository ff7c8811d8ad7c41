"""Small files and folders on whatever file system a path names, through Spark's own file system layer.

``Place`` has the few operations that snapshots, layers and documents need. Paths without a scheme are on the cluster's default
file system (in tests the local disk), so a data root may lie wherever Spark can write.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import SparkSession

_BUFFER = 1 << 20


class Place:
    """A file or folder, by its path."""

    def __init__(self, path: str):
        self.path = str(path).rstrip("/") or "/"

    def __truediv__(self, name: str) -> Place:
        return Place(f"{self.path}/{name}")

    def __str__(self) -> str:
        return self.path

    def __repr__(self) -> str:
        return f"Place({self.path!r})"

    @property
    def name(self) -> str:
        return self.path.rsplit("/", 1)[-1]

    @property
    def parent(self) -> Place:
        return Place(self.path.rsplit("/", 1)[0] or "/")

    def _open(self):
        """(file system, path, JVM) of this place."""
        spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        system.setWriteChecksum(False)
        return system, path, spark._jvm

    def exists(self) -> bool:
        system, path, _ = self._open()
        return system.exists(path)

    def folders(self) -> list[Place]:
        """The folders right below, by name; none where there is no such place."""
        system, path, _ = self._open()
        found = system.listStatus(path) if system.exists(path) else []
        return sorted((self / s.getPath().getName() for s in found if s.isDirectory()), key=lambda p: p.name)

    def read_bytes(self) -> bytes:
        system, path, jvm = self._open()
        stream = system.open(path)
        try:
            return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def read_text(self) -> str:
        return self.read_bytes().decode("utf-8")

    def write(self, pieces: Iterable[str | bytes]) -> None:
        """Replaces the file by pieces that are never in memory together."""
        system, path, _ = self._open()
        out = system.create(path, True)
        try:
            for block in _blocks(pieces):
                out.write(bytearray(block))
        finally:
            out.close()

    def write_bytes(self, content: bytes) -> None:
        self.write([content])

    def write_text(self, text: str) -> None:
        self.write([text])

    def remove(self) -> None:
        system, path, _ = self._open()
        system.delete(path, True)

    def copy_to(self, target: Place) -> None:
        """A copy of the file or folder, in place of what is there."""
        system, path, jvm = self._open()
        other, to, _ = target._open()
        other.delete(to, True)
        other.mkdirs(to.getParent())
        jvm.org.apache.hadoop.fs.FileUtil.copy(system, path, other, to, False, system.getConf())


def _blocks(pieces: Iterable[str | bytes]) -> Iterator[bytes]:
    held, size = [], 0
    for p in pieces:
        held.append(p.encode("utf-8") if isinstance(p, str) else p)
        size += len(held[-1])
        if size >= _BUFFER:
            yield b"".join(held)
            held, size = [], 0
    yield b"".join(held)
