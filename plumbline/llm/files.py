"""Files that tasks write into the shared folder and read back.

A file gets its name only when it is complete, so a task that is repeated or runs twice
leaves one whole file. Paths are URIs of the shared folder, local or remote.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def _place(uri: str):
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write_file(uri: str, data) -> None:
    """Write pieces of bytes to ``uri``, replacing what an earlier attempt left."""
    system, path = _place(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    draft = f"{path}.{uuid.uuid4().hex}.draft"
    with system.open_output_stream(draft) as out:
        for piece in data:
            out.write(piece)
    system.move(draft, path)


def read_file(uri: str, start: int = 0, length: int | None = None) -> bytes:
    """All bytes of a file, or ``length`` of them from ``start``."""
    system, path = _place(uri)
    with system.open_input_file(path) as file:
        file.seek(start)
        return file.read(file.size() - start if length is None else length)
