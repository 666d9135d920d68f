"""Folders of any file system Spark knows: names, small files, moves and removals."""

from __future__ import annotations

import json
from dataclasses import dataclass
from uuid import uuid4

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return store, store.makeQualified(place)


def key_root(spark: SparkSession, path: str) -> str:
    """The path inside its store, however it is spelled, without a slash at its end."""
    return _at(spark, path)[1].toUri().getPath().rstrip("/")


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its store, without a slash at its end."""
    return _at(spark, path)[1].toString().rstrip("/")


def exists(spark: SparkSession, path: str) -> bool:
    store, place = _at(spark, path)
    return store.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    store, place = _at(spark, path)
    store.delete(place, True)


@dataclass(frozen=True)
class Entry:
    """One name in a folder."""

    name: str
    is_folder: bool
    bytes: int


def entries(spark: SparkSession, path: str) -> list[Entry]:
    """What stands directly in a folder, by name; nothing if there is no such folder."""
    store, place = _at(spark, path)
    if not store.exists(place):
        return []
    found = [Entry(s.getPath().getName(), s.isDirectory(), s.getLen()) for s in store.listStatus(place)]
    return sorted(found, key=lambda entry: entry.name)


def move(spark: SparkSession, old: str, new: str) -> None:
    """Give a file or folder another name; the folder it goes to is made if need be."""
    store, source = _at(spark, old)
    _, target = _at(spark, new)
    store.mkdirs(target.getParent())
    if not store.rename(source, target):
        raise OSError(f"could not move {old} to {new}")


def put(spark: SparkSession, path: str, content: bytes) -> None:
    """A small file that is there whole or not at all."""
    parent, _, name = path.rpartition("/")
    hidden = f"{parent}/_writing-{uuid4().hex}"
    store, place = _at(spark, hidden)
    out = store.create(place, True)
    try:
        out.write(content)
    finally:
        out.close()
    move(spark, hidden, f"{parent}/{name}")


def put_json(spark: SparkSession, path: str, value: object) -> None:
    put(spark, path, json.dumps(value, sort_keys=True).encode())


def get_json(spark: SparkSession, path: str) -> object:
    store, place = _at(spark, path)
    stream = store.open(place)
    try:
        return json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()
