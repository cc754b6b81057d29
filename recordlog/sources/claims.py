"""Put-if-absent on the shared file system: the one primitive that commits and reservations rest on.

A claim is a folder with one file in it.  It is filled under a name of its own and then renamed to the
claimed name; a rename never replaces a folder that holds a file, neither on HDFS nor on a local
disk, so the first one stands whole and every other claimant reads the winner's text.  Stores whose rename
is not atomic (plain object stores) need a committer of their own and do not fit."""
from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

BODY = "claim.json"


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of ``path``."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``, none where it does not exist."""
    fs, at = file_system(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(at) if f.isDirectory()) if fs.exists(at) else []


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = file_system(spark, path)
    return fs.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    fs, at = file_system(spark, path)
    fs.delete(at, True)


def read_claim(spark: SparkSession, path: str) -> dict | None:
    """What stands at ``path``, None where nothing does."""
    fs, at = file_system(spark, f"{path}/{BODY}")
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def claim(spark: SparkSession, path: str, body: dict) -> bool:
    """Put ``body`` at ``path`` unless something stands there already; whether it is ours that stands there."""
    token = uuid.uuid4().hex
    parent, _, name = path.rstrip("/").rpartition("/")
    draft = f"{parent}/_draft-{name}-{token}"
    fs, at = file_system(spark, path)
    if fs.exists(at):
        return False
    out = fs.create(spark._jvm.org.apache.hadoop.fs.Path(f"{draft}/{BODY}"), False)
    out.write(bytearray(json.dumps({**body, "token": token}).encode()))
    out.close()
    try:
        fs.rename(spark._jvm.org.apache.hadoop.fs.Path(draft), at)
    finally:
        # a lost race leaves the draft where it was or inside the winner's folder
        for left in (draft, f"{path}/_draft-{name}-{token}"):
            delete(spark, left)
    stands = read_claim(spark, path)
    return stands is not None and stands["token"] == token
