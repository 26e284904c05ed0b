"""Fingerprints of what an artifact was made of: an artifact of other or changed inputs is refused."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession

#: The version of manifests; an artifact of a newer one is refused.
VERSION = 1
NAME = "_fingerprint.json"


class StaleArtifactError(ValueError):
    """The artifact is not one of these inputs."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def schema_digest(df: DataFrame) -> str:
    """A digest of column names, types and order."""
    return hashlib.sha256(df.schema.json().encode()).hexdigest()


def files_of(spark: SparkSession, path: str) -> tuple[int, int, str]:
    """(number, bytes, digest of names, sizes and times) of all files below a path. The driver sees their list, not their content."""
    fs, at = _fs(spark, path)
    if not fs.exists(at):
        raise FileNotFoundError(path)
    found, each = [], fs.listFiles(at, True)
    while each.hasNext():
        f = each.next()
        name = f.getPath().getName()
        if not name.startswith(("_", ".")):
            found.append((name, f.getLen(), f.getModificationTime()))
    return len(found), sum(f[1] for f in found), hashlib.sha256(json.dumps(sorted(found)).encode()).hexdigest()


def fingerprint(spark: SparkSession, sources: dict[str, str], config: dict | None = None) -> dict:
    """What an artifact of these sources (name -> path of a Parquet table) and settings is known by."""
    out = {}
    for name, path in sources.items():
        number, size, digest = files_of(spark, path)
        out[name] = {"files": number, "bytes": size, "digest": digest, "schema": schema_digest(spark.read.parquet(path))}
    return {"version": VERSION, "sources": out, "config": config or {}}


def write_fingerprint(spark: SparkSession, folder: str, sources: dict[str, str], config: dict | None = None) -> None:
    """Leave the fingerprint in the artifact's folder, in the store where the artifact is."""
    fs, at = _fs(spark, f"{folder}/{NAME}")
    out = fs.create(at, True)
    try:
        out.write(bytearray(json.dumps(fingerprint(spark, sources, config), sort_keys=True).encode()))
    finally:
        out.close()


def require_fresh(spark: SparkSession, folder: str, sources: dict[str, str], config: dict | None = None) -> None:
    """An error that names what has changed, if the artifact was made of other files, schemas or settings, or by a newer version."""
    fs, at = _fs(spark, f"{folder}/{NAME}")
    if not fs.exists(at):
        raise StaleArtifactError(f"{folder} has no fingerprint")
    stream = fs.open(at)
    try:
        then = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    if then["version"] > VERSION:
        raise StaleArtifactError(f"{folder} is of version {then['version']}, this is {VERSION}")
    now = fingerprint(spark, sources, config)
    changed = [] if then["config"] == now["config"] else ["settings"]
    for name in sorted(then["sources"].keys() | now["sources"].keys()):
        a, b = then["sources"].get(name), now["sources"].get(name)
        if a is None or b is None:
            changed.append(f"{name} is {'new' if a is None else 'gone'}")
        else:
            changed += [f"{what} of {name}" for what in ("schema", "files", "bytes", "digest") if a[what] != b[what]]
    if changed:
        raise StaleArtifactError(f"{folder} is stale: {', '.join(changed)}")
