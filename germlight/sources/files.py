"""Files that Python data sources read: on any store that pyarrow reaches, or on a local path."""

from __future__ import annotations

from urllib.parse import urlparse


def _store(path: str):
    from pyarrow import fs

    if urlparse(path).scheme in ("", "file"):
        local = fs.LocalFileSystem()
        return local, urlparse(path).path if path.startswith("file:") else path
    return fs.FileSystem.from_uri(path)


def list_files(path: str, suffixes: tuple[str, ...] = ()) -> list[tuple[str, int]]:
    """(path, size) of a file, or of the files of a folder, in order of name; names with a leading dot or underscore are not data."""
    from pyarrow import fs

    store, name = _store(path)
    info = store.get_file_info(name)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [(path, info.size)]
    inside = store.get_file_info(fs.FileSelector(name, recursive=True))
    base = path.rstrip("/")
    found = [(f"{base}{i.path[len(name.rstrip('/')):]}", i.size) for i in inside if i.type == fs.FileType.File and not i.base_name.startswith((".", "_")) and (not suffixes or i.base_name.endswith(suffixes))]
    return sorted(found)


def open_file(path: str):
    """A seekable binary file."""
    store, name = _store(path)
    return store.open_input_file(name)


#: Spans that files are cut into, each a task which the driver plans: no more than MOST of them, unless spans of LARGE bytes are more.
MOST, LARGE = 1024, 64 << 20


def cuts(path: str, split: int, suffixes: tuple[str, ...] = ()) -> tuple[list[tuple[str, int]], int]:
    """The files under path, and the bytes of a span: split, or more where that would make more than MOST spans."""
    files = list_files(path, suffixes)
    return files, max(split, min(-(-sum(size for _, size in files) // MOST), LARGE))
