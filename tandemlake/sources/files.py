"""Files that executors open by themselves, by any path or address that pyarrow's file systems know."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.datasource import InputPartition

#: Bytes of a file that a task reads.
SPLIT = 64 << 20


def _at(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def listed(path: str, suffix: str) -> list[tuple[str, int]]:
    """Addresses and sizes of a file, or of a folder's files of this suffix, in order."""
    from pyarrow import fs

    system, inner = _at(path)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    lead = path[: len(path) - len(inner)] if path.endswith(inner) else ""
    if info.type == fs.FileType.Directory:
        found = [f for f in system.get_file_info(fs.FileSelector(inner)) if f.path.endswith(suffix)]
        return sorted((lead + f.path, f.size) for f in found)
    return [(path, info.size)]


def opened(path: str):
    """A file to read and seek in."""
    system, inner = _at(path)
    return system.open_input_file(inner)


def length(path: str) -> int:
    with opened(path) as f:
        return f.size()


def there(path: str) -> bool:
    from pyarrow import fs

    system, inner = _at(path)
    return system.get_file_info(inner).type == fs.FileType.File


def created(path: str):
    """A new file to write, with the folders that lead to it."""
    system, inner = _at(path)
    system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(inner)


def moved(path: str, target: str) -> None:
    system, inner = _at(path)
    system.move(inner, _at(target)[1])


def removed(path: str) -> None:
    if there(path):
        system, inner = _at(path)
        system.delete_file(inner)


def removed_folder(path: str) -> None:
    from pyarrow import fs

    system, inner = _at(path)
    if system.get_file_info(inner).type == fs.FileType.Directory:
        system.delete_dir(inner)


def listed_names(path: str, suffix: str) -> list[str]:
    """Names of a folder's files of this suffix; none if there is no such folder."""
    from pyarrow import fs

    system, inner = _at(path)
    if system.get_file_info(inner).type != fs.FileType.Directory:
        return []
    return sorted(f.base_name for f in system.get_file_info(fs.FileSelector(inner)) if f.type == fs.FileType.File and f.base_name.endswith(suffix))


@dataclass
class Split(InputPartition):
    """The part of a file whose records begin at start or later, and before end."""

    path: str
    start: int
    end: int

    def __post_init__(self):
        super().__init__((self.path, self.start))


def splits(path: str, suffix: str, size: int = SPLIT) -> list[Split]:
    return [Split(p, a, min(a + size, n)) for p, n in listed(path, suffix) for a in range(0, max(n, 1), size)]
