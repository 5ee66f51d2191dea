"""Folders of tables and test data, by public file system calls; what is read as data goes through Spark's own readers."""

from __future__ import annotations

from pyarrow import fs


def _opened(address: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(address)


def listed(address: str, ending: str) -> list[str]:
    """Addresses of the files in a folder whose names end so, in order."""
    system, path = _opened(address)
    found = system.get_file_info(fs.FileSelector(path))
    return sorted(f"{address.rstrip('/')}/{f.base_name}" for f in found if f.base_name.endswith(ending))


def remove(address: str) -> None:
    system, path = _opened(address)
    if system.get_file_info(path).type != fs.FileType.NotFound:
        system.delete_dir(path)


def move(source: str, target: str) -> None:
    """Rename; the target's parent folder is made."""
    system, path = _opened(target)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    system.move(_opened(source)[1], path)


def create(address: str):
    """A stream into a new file, which replaces one of that name; its folder is made."""
    system, path = _opened(address)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path)
