"""Work in chunks that survives a stop: finished chunks are committed, the others done again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class ChunkedWork:
    """Apply a function to a keyed table chunk by chunk, into a folder.

    A chunk is the rows whose key's hash leaves one remainder, so a row is in the same chunk at
    every start. The chunk is written to a folder of its own try, and only then named in a commit
    record, a file that is put in place by one rename. What a stopped run left half-written is
    under no commit record and isn't read. Results are the committed chunks.

    Rows with a null key are one chunk's. Rows that come new between two runs are done when their
    chunk is; ``pending`` tells which keys have no result yet, and ``append`` does only those.
    """

    def __init__(self, spark: SparkSession, path: str, table: DataFrame, key: str, chunks: int):
        self.spark, self.path, self.table, self.key, self.chunks = spark, path.rstrip("/"), table, key, chunks
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self._place = jvm.org.apache.hadoop.fs.Path
        self._files = self._place(self.path).getFileSystem(conf)

    def _names(self, folder: str) -> list[str]:
        place = self._place(f"{self.path}/{folder}")
        return sorted(f.getPath().getName() for f in self._files.listStatus(place)) if self._files.exists(place) else []

    def committed(self) -> dict[str, str]:
        """Finished chunks and the folder that holds each: ``chunk.try`` records, the first try wins."""
        done: dict[str, str] = {}
        for name in self._names("commits"):
            chunk, attempt = name.split(".")[:2]
            if not name.endswith(".tmp"):
                done.setdefault(chunk, f"{self.path}/data/{chunk}.{attempt}")
        return done

    def _next_try(self, chunk: str) -> str:
        tries = [int(n.split(".")[1]) for n in self._names("data") if n.split(".")[0] == chunk]
        return f"{chunk}.{max(tries, default=-1) + 1}"

    def _write(self, chunk: str, result: DataFrame) -> None:
        attempt = self._next_try(chunk)
        result.write.parquet(f"{self.path}/data/{attempt}")
        record, half = self._place(f"{self.path}/commits/{attempt}"), self._place(f"{self.path}/commits/{attempt}.tmp")
        self._files.create(half, True).close()
        self._files.rename(half, record)

    def run(self, work: Callable[[DataFrame], DataFrame], at_most: int | None = None) -> int:
        """Do the chunks that aren't committed, at most ``at_most`` of them; returns how many."""
        done, n = self.committed(), 0
        part = F.coalesce(F.pmod(F.xxhash64(self.key), F.lit(self.chunks)), F.lit(0))
        for k in range(self.chunks):
            if str(k) in done:
                continue
            if at_most is not None and n >= at_most:
                break
            self._write(str(k), work(self.table.where(part == k)))
            n += 1
        return n

    def results(self) -> DataFrame:
        folders = list(self.committed().values())
        if not folders:
            raise ValueError("no chunk is finished yet")
        schema = self.spark.read.parquet(folders[0]).schema
        return self.spark.read.schema(schema).parquet(*folders)

    def pending(self, table: DataFrame) -> DataFrame:
        """Rows of ``table`` whose key has no result yet."""
        return table.join(self.results().select(self.key).distinct(), self.key, "left_anti") if self.committed() else table

    def append(self, work: Callable[[DataFrame], DataFrame], table: DataFrame, name: str) -> None:
        """Do the rows of ``table`` that have no result yet, under a name of their own; once."""
        if f"more-{name}" not in self.committed():
            self._write(f"more-{name}", work(self.pending(table)))
