"""The files of a table's folder, through the store that Spark reads it from."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..errors import InvalidArgument, InvalidState, NotFound
from .ingest import identifier


class Folder:
    """A folder by its path; the names below are relative to it."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs, self._text = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.commons.io.IOUtils
        self.path = path.rstrip("/")

    def at(self, *names: str):
        return self._path("/".join([self.path, *names]))

    def files(self, *names: str) -> dict[str, tuple[int, int]]:
        """Name -> (bytes, time of change) of what lies there."""
        return {s.getPath().getName(): (s.getLen(), s.getModificationTime()) for s in self._fs.listStatus(self.at(*names))}

    def write(self, text: str, *names: str) -> None:
        stream = self._fs.create(self.at(*names), False)
        stream.write(bytearray(text.encode()))
        stream.close()

    def read(self, *names: str) -> str:
        stream = self._fs.open(self.at(*names))
        text = self._text.toString(stream, "UTF-8")
        stream.close()
        return text

    def move(self, old, new) -> None:
        if not self._fs.rename(old, new):
            raise InvalidState(f"{old} cannot be moved to {new}")

    def delete(self, *names: str) -> None:
        self._fs.delete(self.at(*names), True)


def table_folder(spark: SparkSession, table: str) -> Folder:
    """The folder of a plain Parquet table without partitions; any other table is refused."""
    if not spark.catalog.tableExists(table):
        raise NotFound(f"table {table.upper()} does not exist")
    facts = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {identifier(table)}").collect()}
    if facts.get("Provider", "").lower() != "parquet" or "# Partition Information" in facts:
        raise InvalidArgument(f"table {table.upper()} is not a plain Parquet table without partitions")
    return Folder(spark, facts["Location"])
