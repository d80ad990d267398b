"""First-line reader run inside tasks (header sniffing for the landing scan).

The executors get the package through `session.ship_package`.
"""

from __future__ import annotations

import pandas as pd

HEADER_PROBE_BYTES = 1 << 16


# Hadoop scheme names that the Arrow file systems know under another name.
_SCHEME_ALIASES = {"s3a": "s3", "s3n": "s3"}


def open_target(path: str):
    """(file system, path inside it) for a Hadoop-style path string as Spark
    lists it (`file:/x`, `s3a://bucket/key`, ...; not percent-encoded)."""
    import pyarrow.fs as pafs
    from urllib.parse import quote
    if ":" not in path.split("/", 1)[0]:
        return pafs.LocalFileSystem(), path
    scheme, rest = path.split(":", 1)
    if scheme == "file":
        local = "/" + rest.lstrip("/")
        return pafs.LocalFileSystem(), local
    uri = _SCHEME_ALIASES.get(scheme, scheme) + ":" + quote(rest, safe="/:@!$&'()*+,;=~")
    return pafs.FileSystem.from_uri(uri)


def first_line(path: str) -> str | None:
    """The first line of a file, read in 64 KB blocks until the first newline."""
    fs, inner = open_target(path)
    chunks = []
    with fs.open_input_stream(inner) as stream:
        while True:
            block = stream.read(HEADER_PROBE_BYTES)
            if not block:
                break
            cut = block.find(b"\n")
            if cut >= 0:
                chunks.append(block[:cut])
                break
            chunks.append(block)
    text = b"".join(chunks).decode("utf-8", errors="replace").lstrip("﻿").rstrip("\r")
    return text if text else None


# Marks a file this reader could not open (e.g. a storage scheme Arrow has no
# client for); the scan then reads its first line through Spark instead.
UNREADABLE = "\x00unreadable"


def _safe_first_line(path: str) -> str | None:
    try:
        return first_line(path)
    except Exception:  # noqa: BLE001 -- any failure defers to the Spark reader
        return UNREADABLE


def header_lines(batches):
    for pdf in batches:
        yield pd.DataFrame({"path": pdf["path"], "modified": pdf["modified"],
                            "header": [_safe_first_line(p) for p in pdf["path"]]})
