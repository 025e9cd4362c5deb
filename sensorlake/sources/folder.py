"""Files of a folder on shared storage, opened by its URI (local path, file, hdfs,
s3, gs) from the driver and the executors alike."""

from __future__ import annotations

from pyarrow import fs as pafs


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    files, root = pafs.FileSystem.from_uri(uri)
    return files, root.rstrip("/")


def list_files(files: pafs.FileSystem, root: str, ending: str = "") -> list[pafs.FileInfo]:
    """Files below ``root`` (none if it is not there yet), by path, without names or
    subfolders that begin with '_' or '.', as Spark reads folders."""
    found = files.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
    return sorted((f for f in found if f.type == pafs.FileType.File and f.path.endswith(ending)
                   and not any(p[0] in "_." for p in f.path[len(root):].strip("/").split("/"))), key=lambda f: f.path)
