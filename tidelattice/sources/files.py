"""Files of the shared folder, seen by the driver and by tasks alike."""

from __future__ import annotations

import os

from pyarrow import fs


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system that holds a path, and the path in it; a path without a scheme is local."""
    if "://" not in path and not path.startswith("file:"):
        path = f"file://{os.path.abspath(path)}"
    return fs.FileSystem.from_uri(path)


def names(system: fs.FileSystem, folder: str, kind: fs.FileType | None = None) -> list[str]:
    """Sorted names in a folder, empty if there is none; those that begin with `_` or `.` are hidden."""
    found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted(f.base_name for f in found if f.base_name[0] not in "._" and kind in (None, f.type))


def put(path: str, data: bytes) -> None:
    """A small file, there as a whole or not at all: written aside and moved."""
    system, at = opened(path)
    system.create_dir(os.path.dirname(at), recursive=True)
    with system.open_output_stream(f"{at}.tmp") as out:
        out.write(data)
    system.move(f"{at}.tmp", at)


def get(path: str) -> bytes | None:
    """A small file, or None."""
    system, at = opened(path)
    if system.get_file_info(at).type == fs.FileType.NotFound:
        return None
    with system.open_input_stream(at) as data:
        return data.read()
