"""Files and folders on whatever file system a path names."""

from __future__ import annotations

import os
import uuid
from datetime import datetime

from pyarrow import fs
from pyspark.sql import SparkSession


def _resolve(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def folder_exists(path: str) -> bool:
    files, place = _resolve(path)
    return files.get_file_info(place).type == fs.FileType.Directory


def delete_folder(path: str) -> None:
    """Remove a folder and what is in it; one that is not there is fine."""
    files, place = _resolve(path)
    if folder_exists(path):
        files.delete_dir(place)


def _inside(path: str, kind: fs.FileType, recursive: bool = False) -> list[fs.FileInfo]:
    files, place = _resolve(path)
    found = files.get_file_info(fs.FileSelector(place, allow_not_found=True, recursive=recursive))
    return [one for one in found if one.type == kind]


def folders_in(path: str) -> list[str]:
    """Names of the folders directly in a folder."""
    return sorted(one.base_name for one in _inside(path, fs.FileType.Directory))


def files_in(path: str) -> list[str]:
    """Names of the files directly in a folder; none if there is no folder."""
    return sorted(one.base_name for one in _inside(path, fs.FileType.File))


def folder_bytes(path: str) -> int:
    """Size of all files in a folder, at any depth."""
    return sum(one.size for one in _inside(path, fs.FileType.File, recursive=True))


def changed_at(path: str) -> datetime | None:
    """When a file or folder last changed, where its file system tells."""
    files, place = _resolve(path)
    return files.get_file_info(place).mtime


def read_file(path: str) -> str:
    files, place = _resolve(path)
    with files.open_input_file(place) as file:
        return file.read().decode()


def delete_file(path: str) -> None:
    files, place = _resolve(path)
    if files.get_file_info(place).type == fs.FileType.File:
        files.delete_file(place)


def create_file(path: str, text: str) -> bool:
    """Create a file, whole or not at all; False if there is one of that name already.

    The text is written under a name of its own first. A hard link then gives it the name asked
    for on a local or mounted file system, and elsewhere a rename, which must not replace a file,
    as on HDFS.
    """
    files, place = _resolve(path)
    folder, _, name = place.rpartition("/")
    files.create_dir(folder, recursive=True)
    draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
    if not isinstance(files, fs.LocalFileSystem):
        return _rename_new(path, path.rpartition("/")[0] + f"/.{name}-{uuid.uuid4().hex}", text)
    try:
        with open(draft, "x") as file:
            file.write(text)
            file.flush()
            os.fsync(file.fileno())
        os.link(draft, place)
    except FileExistsError:
        return False
    finally:
        delete_file(draft)
    return True


def _rename_new(path: str, draft: str, text: str) -> bool:
    """``create_file`` through Hadoop's file systems."""
    spark = SparkSession.active()
    place = spark._jvm.org.apache.hadoop.fs.Path
    files = place(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    out = files.create(place(draft), True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    renamed = not files.exists(place(path)) and files.rename(place(draft), place(path))
    if not renamed:
        files.delete(place(draft), False)
    return renamed
