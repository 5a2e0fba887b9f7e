"""Tables that grow by versions: folders ``version=1`` and so on, each published whole by one rename."""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs
from pyspark.sql import DataFrame

from tapeloom.shipping import ship
from tapeloom.sources.exact import open_folder

ship(__name__)


def versions(system: pafs.FileSystem, folder: str) -> set[int]:
    found = system.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
    return {int(f.base_name.removeprefix("version=")) for f in found if f.type == pafs.FileType.Directory and f.base_name.startswith("version=")}


def last_whole(there: set[int]) -> int:
    """The last version before which none is missing."""
    n = 0
    while n + 1 in there:
        n += 1
    return n


def last(path: str) -> int:
    return last_whole(versions(*open_folder(path)))


def files_of(path: str, upto: int) -> list[str]:
    """Folders of the versions up to ``upto``, for Spark to read."""
    return [f"{path.rstrip('/')}/version={n}" for n in range(1, upto + 1)]


def stage(rows: DataFrame, path: str) -> str:
    """Writes rows aside; the name by which ``publish`` knows them."""
    new = f"_new-{uuid.uuid4().hex}"
    rows.write.parquet(f"{path.rstrip('/')}/{new}")
    return new


def publish(path: str, new: str, version: int) -> bool:
    """Makes staged rows a version; False, and nothing is changed, if another writer has made that version."""
    system, folder = open_folder(path)
    if version in versions(system, folder):
        return False
    try:
        # A folder does not replace one that holds files.
        system.move(f"{folder}/{new}", f"{folder}/version={version}")
        return True
    except OSError:
        if version not in versions(system, folder):
            raise
        return False


def discard(path: str, new: str) -> None:
    system, folder = open_folder(path)
    system.delete_dir(f"{folder}/{new}")
