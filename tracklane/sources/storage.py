"""Open and list files on any storage pyarrow knows (local, S3, GCS, ABFS, HDFS)."""

from __future__ import annotations

import io
import zipfile


def filesystem_of(path: str):
    """(filesystem, path inside it) for a URI or a plain local path."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    # Hadoop's names for S3.
    path = path.replace("s3a://", "s3://", 1).replace("s3n://", "s3://", 1)
    try:
        return fs.FileSystem.from_uri(path)
    except (ValueError, NotImplementedError):
        try:
            import fsspec
        except ImportError:
            raise ValueError(f"no reader for {path}; read it with read_lines instead") from None
        storage, inner = fsspec.core.url_to_fs(path)
        return fs.PyFileSystem(fs.FSSpecHandler(storage)), inner


def list_files(path: str, suffix: str | tuple[str, ...]) -> list[tuple[str, int]]:
    """(path, size) of the files with a suffix, in any case, anywhere under a folder, or of one file.

    Names that begin with a dot or an underscore are not data. A path that does not exist is an error.
    """
    from pyarrow import fs

    path = path.rstrip("/")
    storage, inner = filesystem_of(path)
    prefix = path.removesuffix(inner)
    info = storage.get_file_info(inner)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(f"no such file or folder: {path}")
    if info.type == fs.FileType.File:
        return [(prefix + info.path, info.size)]
    found = [
        f
        for f in storage.get_file_info(fs.FileSelector(inner, recursive=True))
        if f.type == fs.FileType.File and f.base_name.lower().endswith(suffix) and not hidden(f.path[len(inner) :])
    ]
    return sorted((prefix + f.path, f.size) for f in found)


def hidden(path: str) -> bool:
    return any(part.startswith((".", "_")) for part in path.split("/"))


def relative_name(path: str, root: str) -> str:
    """A file's path below the folder it was found in; its own name if it was given itself."""
    path, root = path.rstrip("/"), root.rstrip("/")
    return path[len(root) + 1 :] if path.startswith(root + "/") else path.rsplit("/", 1)[-1]


def label_files(names: list[str], label: str) -> list[str]:
    """What files are called as sources, from their relative names: ``name`` or the whole relative ``path``.

    Two files with one label would be taken for one another, so that is an error.
    """
    if label not in ("name", "path"):
        raise ValueError(f"label must be 'name' or 'path', got {label!r}")
    labels = [n.rsplit("/", 1)[-1] if label == "name" else n for n in names]
    seen: dict[str, str] = {}
    for name, own in zip(names, labels, strict=True):
        if own in seen:
            raise ValueError(f"two files are called {own!r}: {seen[own]} and {name}; label='path' tells them apart")
        seen[own] = name
    return labels


def open_bytes(path: str) -> io.BufferedReader:
    storage, inner = filesystem_of(path)
    return io.BufferedReader(storage.open_input_file(inner), 1 << 20)


def open_archive(path: str) -> zipfile.ZipFile:
    stream = open_bytes(path)
    try:
        return zipfile.ZipFile(stream)
    except (zipfile.BadZipFile, ValueError) as error:  # a file shorter than a directory has no place to look at
        raise ValueError(f"not a readable ZIP archive: {path}") from error


def is_csv_member(name: str) -> bool:
    """Whether an archive member holds recordings: a CSV that is neither hidden nor a macOS artefact."""
    base = name.rsplit("/", 1)[-1]
    return name.lower().endswith(".csv") and not name.startswith("__MACOSX") and not base.startswith(".")
