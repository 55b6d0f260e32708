"""A log of numbered commits that several writers may append to.

A commit is one small file whose name is its number. It is written under a name of its own and then put in place only if that number is still free, which the
file system does in one step: a rename that does not replace, or on a local disk a hard link. A writer that comes second takes the next
number. Readers see whole commits or none, and a writer that stops before its commit leaves nothing behind that a reader would look at.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from wattline.errors import RegistryError

#: Writers that may take a number one after the other while another one tries.
MOST_TRIES = 1000


def _path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _jvm_error(error: Exception) -> str:
    """Class of the JVM exception behind a call through the gateway, or ''."""
    java = getattr(error, "java_exception", None)
    return java.getClass().getName() if java is not None else ""


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file unless there is one of that name; whether it was written."""
    jvm = spark._jvm
    target, system = _path(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".draft-{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    target, draft = system.makeQualified(target), system.makeQualified(draft)
    try:
        if target.toUri().getScheme() == "file":
            files, uri = jvm.java.nio.file.Files, jvm.java.net.URI
            files.createLink(jvm.java.nio.file.Paths.get(uri("file", None, target.toUri().getPath(), None)), jvm.java.nio.file.Paths.get(uri("file", None, draft.toUri().getPath(), None)))
        else:
            rename = jvm.org.apache.hadoop.fs.Options.Rename
            options = spark.sparkContext._gateway.new_array(rename, 1)
            options[0] = rename.NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, target, options)
        return True
    except Exception as error:
        if not _jvm_error(error).endswith("FileAlreadyExistsException"):
            raise
        return False
    finally:
        system.delete(draft, False)


class CommitLog:
    """The commits below a folder, as JSON records."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def numbers(self) -> list[int]:
        where, system = _path(self.spark, self.path)
        if not system.exists(where):
            return []
        names = (s.getPath().getName() for s in system.listStatus(where))
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def _file(self, number: int) -> str:
        return f"{self.path}/{number:020d}.json"

    def append(self, record: dict, first: int = 1, number_as: str | None = None, form: str = "{}") -> int:
        """Add a record under the next free number, from ``first`` on, and return it. ``number_as`` names a field that is to hold the number."""
        number = max([first - 1, *self.numbers()]) + 1
        for number in range(number, number + MOST_TRIES):
            told = record | ({number_as: form.format(number)} if number_as else {})
            if put_if_absent(self.spark, self._file(number), json.dumps(told)):
                return number
        raise RegistryError(f"no number was free in {MOST_TRIES} tries at {self.path!r}")

    def latest(self) -> dict | None:
        numbers = self.numbers()
        if not numbers:
            return None
        return json.loads(self.spark.read.text(self._file(numbers[-1]), wholetext=True).first()["value"])

    def table(self, schema):
        """All records as a table, or None without any."""
        return self.spark.read.schema(schema).json(self.path).select(*[F.col(c) for c in schema.names]) if self.numbers() else None
