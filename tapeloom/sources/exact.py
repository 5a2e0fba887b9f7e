"""K2-K4: one file for each row, under the very name that the row gives, written by a Python data source.

Writing has two phases. A task writes its files below a folder of its own, ``_staged-<run>/<attempt>``, and
its commit message names that folder. Only when all tasks have ended well does the driver move the files of
the attempts that count to their names; a failed or a speculative attempt's folder is never among them and
goes with the rest of the staged files, after a success as after a failure. Messages bear a folder and a
number, not contents or names: what the driver does for a file is one rename.

A name that is empty, too long for a file, or has a slash or a null character, one that two rows bear, and
one that a file bears already (unless ``mode("overwrite")``, which replaces just the files of these names)
are errors before any file is moved. Rows are dealt by name, so that one task sees both rows of a name.

``write_folders`` does the same with folders ``<key>=<value>``, as ``partitionBy`` names them, at less cost for each file
on local paths than Spark's own writer has.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from tapeloom.shipping import ship

ship(__name__)

FORMAT = "exact_files"
#: Bytes that a file's name may have on common file systems.
LONGEST_NAME = 255
#: Renames that the driver has under way at once.
MOVES = 32


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path, and the path there, letter for letter as Spark means it: nothing in it is an escape. Without a scheme it is local."""
    given = re.fullmatch(r"(?s)([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?(/.*)", path)
    if not given or given[1] == "file":
        return pafs.LocalFileSystem(), (given[3] if given else path).rstrip("/")
    scheme = {"s3a": "s3", "s3n": "s3"}.get(given[1], given[1])
    system, root = pafs.FileSystem.from_uri(f"{scheme}://{given[2] or ''}/")
    return system, (root.rstrip("/") + given[3]).rstrip("/")


def check_name(name: str | None, suffix: str) -> str:
    """The file's name, or an error if it can't be one."""
    file = f"{name or ''}{suffix}"
    if not name or "/" in name or "\0" in name or file in (".", "..") or name.startswith("_staged-") or len(file.encode()) > LONGEST_NAME:
        raise ValueError(f"not a file name: {file!r}")
    return file


def list_names(system: pafs.FileSystem, folder: str, folders: bool = False) -> list[str]:
    """Names of the files, or of the folders, in a folder; none if it is not there."""
    if isinstance(system, pafs.LocalFileSystem):
        try:
            with os.scandir(folder) as found:
                return [f.name for f in found if (f.is_dir() if folders else f.is_file())]
        except FileNotFoundError:
            return []
    kind = pafs.FileType.Directory if folders else pafs.FileType.File
    return [f.base_name for f in system.get_file_info(pafs.FileSelector(folder, allow_not_found=True)) if f.type == kind]


#: What Spark escapes in the names of such folders, and its name for a value that is null or empty.
ESCAPED = re.compile(r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]""")
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def folder_name(key: str, value: str | None) -> str:
    """The name of a value's folder, as Spark has it."""
    return f"{key}={ESCAPED.sub(lambda c: f'%{ord(c[0]):02X}', value) if value else NO_VALUE}"


def is_local(spark: SparkSession, path: str) -> bool:
    """Whether Spark means the local file system by a path."""
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path):
        return path.startswith("file:/")
    return path.startswith("/") and (spark._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:").startswith("file:")


@dataclass
class Staged(WriterCommitMessage):
    """Where an attempt's files lie, and how many there are."""

    attempt: str
    files: int


class ExactWriter(DataSourceWriter):
    #: Whether what is moved to its name is a folder.
    folders = False

    def __init__(self, path: str, suffix: str, run: str, overwrite: bool):
        self.path, self.suffix, self.run, self.overwrite = path, suffix, run, overwrite

    def _staging(self, folder: str) -> str:
        return f"{folder}/_staged-{self.run}"

    def write(self, rows: Iterator) -> Staged:
        """On an executor: the rows of a partition, each as a file below the attempt's own folder."""
        system, folder = open_folder(self.path)
        attempt, seen = uuid.uuid4().hex, set()
        system.create_dir(f"{self._staging(folder)}/{attempt}", recursive=True)
        for row in rows:
            file = check_name(row[0], self.suffix)
            if file in seen:
                raise ValueError(f"two rows have the name {file!r}")
            seen.add(file)
            content = row[1]
            with system.open_output_stream(f"{self._staging(folder)}/{attempt}/{file}") as out:
                out.write(content.encode() if isinstance(content, str) else bytes(content or b""))
        return Staged(attempt, len(seen))

    def commit(self, messages: list[Staged | None]) -> None:
        """On the driver, once, when all tasks have ended well."""
        system, folder = open_folder(self.path)
        try:
            staged, replaced = self._checked(system, folder, messages)
            self._publish(system, folder, staged, replaced)
        finally:
            self._clear(system, folder)

    def _checked(self, system: pafs.FileSystem, folder: str, messages: list[Staged | None]) -> tuple[list[tuple[str, str]], set[str]]:
        """The attempts' folders with the names in each, one text for all, and the names that are there already. Names are compared by their hashes, eight bytes each."""
        attempts, hashes = [], []
        for m in messages:
            at = f"{self._staging(folder)}/{m.attempt}"
            names = list_names(system, at, self.folders)
            if len(names) != m.files:
                raise RuntimeError(f"{m.files} files were staged, {len(names)} are there")
            attempts.append((at, "\0".join(names)))
            hashes.append(np.fromiter(map(hash, names), np.int64, len(names)))
        every = np.sort(np.concatenate([np.zeros(0, np.int64), *hashes]))
        twice = set(every[1:][every[1:] == every[:-1]].tolist())
        there = {f for f in list_names(system, folder, self.folders) if len(every) and every[min(np.searchsorted(every, hash(f)), len(every) - 1)] == hash(f)}
        seen, replaced = set(), set()
        for _, names in attempts if twice or there else []:
            for f in names.split("\0"):
                if f in there:
                    replaced.add(f)
                if hash(f) in twice:
                    if f in seen:
                        raise ValueError(f"two rows have the name {f!r}")
                    seen.add(f)
        if replaced and not self.overwrite:
            raise FileExistsError(f"names that are taken: {sorted(replaced)[:5]}")
        return attempts, replaced

    def _publish(self, system: pafs.FileSystem, folder: str, attempts: list[tuple[str, str]], replaced: set[str]) -> None:
        """Moves all files to their names, or, where one can't be moved, puts back what was there before."""
        old = f"{self._staging(folder)}/_old"
        system.create_dir(old)
        # A local rename is too short for threads.
        pool = None if isinstance(system, pafs.LocalFileSystem) else ThreadPoolExecutor(MOVES)
        rename = os.rename if pool is None else system.move

        def move(at: str, f: str) -> Exception | None:
            try:
                if f in replaced:
                    rename(f"{folder}/{f}", f"{old}/{f}")
                rename(f"{at}/{f}", f"{folder}/{f}")
            except Exception as e:
                return e

        failed = None
        tried: list[tuple[str, str]] = []
        for at, names in attempts:
            some = names.split("\0") if names else []
            tried.append((at, names))
            errors = [e for f in some if (e := move(at, f))] if pool is None else [e for e in pool.map(lambda f: move(at, f), some) if e]
            if errors:
                failed = errors[0]
                break
        if failed:
            kept = set(list_names(system, old, self.folders))
            for at, names in tried:
                waiting = set(list_names(system, at, self.folders))
                for f in names.split("\0") if names else []:
                    if f not in waiting:
                        (system.delete_dir if self.folders else system.delete_file)(f"{folder}/{f}")
                    if f in kept:
                        rename(f"{old}/{f}", f"{folder}/{f}")
            raise failed

    def abort(self, messages: list[Staged | None]) -> None:
        """On the driver, when a task has failed for good."""
        self._clear(*open_folder(self.path))

    def _clear(self, system: pafs.FileSystem, folder: str) -> None:
        if system.get_file_info(self._staging(folder)).type == pafs.FileType.Directory:
            system.delete_dir(self._staging(folder))


class FoldersWriter(ExactWriter):
    """A folder ``<key>=<value>`` with one file for each value: ``head``, and all rows of the value, a line break after each."""

    folders = True

    def __init__(self, path: str, suffix: str, run: str, overwrite: bool, key: str, head: str):
        super().__init__(path, suffix, run, overwrite)
        self.key, self.head = key, head.encode()

    def write(self, rows: Iterator) -> Staged:
        """On an executor: rows of a partition; those of a value are one after another."""
        system, folder = open_folder(self.path)
        attempt, n, last, out = uuid.uuid4().hex, 0, None, None
        at = f"{self._staging(folder)}/{attempt}"
        system.create_dir(at, recursive=True)
        try:
            for value, content in rows:
                if not n or value != last:
                    if out:
                        out.close()
                    name = f"{at}/{folder_name(self.key, value)}"
                    system.create_dir(name, recursive=False)
                    out = system.open_output_stream(f"{name}/part-{self.run}{self.suffix}")
                    out.write(self.head)
                    n, last = n + 1, value
                out.write((content or "").encode("utf-8", "surrogatepass") + b"\n")
        finally:
            if out:
                out.close()
        return Staged(attempt, n)


class ExactFiles(DataSource):
    """``df.write.format("exact_files").option("suffix", ".txt").save(path)`` of rows (name, content)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> ExactWriter:
        kinds = [f.dataType.simpleString() for f in schema]
        if len(kinds) != 2 or kinds[0] != "string" or kinds[1] not in ("string", "binary"):
            raise ValueError(f"rows must be a name and a text or bytes, not {schema.simpleString()}")
        given = (self.options["path"], self.options.get("suffix", ""), uuid.uuid4().hex, overwrite)
        return FoldersWriter(*given, self.options["key"], self.options.get("head", "")) if "key" in self.options else ExactWriter(*given)


def write_files(rows: DataFrame, path: str, suffix: str, name: str | Column, content: str | Column, overwrite: bool = False) -> None:
    """A file ``<name><suffix>`` in ``path`` for each row; a null content is an empty file."""
    spark: SparkSession = rows.sparkSession
    spark.dataSource.register(ExactFiles)
    named = rows.select((F.col(name) if isinstance(name, str) else name).cast("string").alias("name"), (F.col(content) if isinstance(content, str) else content).alias("content"))
    named.repartition("name").write.format(FORMAT).option("suffix", suffix).mode("overwrite" if overwrite else "append").save(path)



def write_folders(rows: DataFrame, path: str, suffix: str, key: str, content: str | Column, order: list[str] = [], head: str = "", overwrite: bool = False) -> None:
    """A folder ``<key>=<value>`` in a local ``path`` for each value, with one file of the value's rows in order: what ``partitionBy`` writes,
    at less cost for each file. Without ``overwrite`` the path must not be there, with it the values' folders are replaced."""
    spark: SparkSession = rows.sparkSession
    if not overwrite and os.path.lexists(open_folder(path)[1]):
        raise FileExistsError(f"the path is there already: {path}")
    spark.dataSource.register(ExactFiles)
    line = F.col(content) if isinstance(content, str) else content
    named = rows.select(F.col(key).cast("string").alias("__name"), line.alias("__content"), *[F.col(c).alias(f"__by{k}") for k, c in enumerate(order)])
    dealt = named.repartition("__name").sortWithinPartitions("__name", *[f"__by{k}" for k in range(len(order))]).select("__name", "__content")
    dealt.write.format(FORMAT).options(suffix=suffix, key=key, head=head).mode("overwrite" if overwrite else "append").save(path)
