"""Files that tasks write to, and read from, the shared folder.

A task writes under a name of its own attempt and returns the names as rows. The table of
those rows, written by Spark, is the manifest: files that it doesn't list come from lost
attempts and are never read.
"""

from __future__ import annotations

import uuid

from pyspark import TaskContext


# Hadoop's names of stores that pyarrow knows by another one.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def known(uri: str) -> str:
    """The URI as pyarrow spells it."""
    scheme, mark, rest = uri.partition("://")
    return SCHEMES.get(scheme, scheme) + mark + rest


def _located(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(known(uri))


def new_file(folder: str, suffix: str):
    """(uri, output stream) of a fresh file in ``folder``."""
    uri = f"{folder}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}{suffix}"
    system, path = _located(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return uri, system.open_output_stream(path, compression=None)


def whole_file(uri: str) -> bytes:
    system, path = _located(uri)
    with system.open_input_stream(path, compression=None) as f:
        return f.read()


def random_file(uri: str):
    system, path = _located(uri)
    return system.open_input_file(path)
