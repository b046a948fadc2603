"""Tables of named parts, each replaced as a whole.

A part is written to a folder of its own, and then named in a manifest, a small text file
that is put in place by one rename.  Until then readers see the part as it was, and a write
that fails leaves nothing that is read.  Manifests are numbered, and the highest counts; of
two writers at a time one fails, since neither overwrites a manifest.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

MANIFESTS = "_manifests"


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _latest(spark: SparkSession, path: str) -> tuple[int, dict]:
    """Number and content of the newest manifest."""
    fs, folder = _files(spark, f"{path}/{MANIFESTS}")
    if not fs.exists(folder):
        return 0, {}
    numbers = [int(x.getPath().getName()) for x in fs.listStatus(folder) if x.getPath().getName().isdigit()]
    if not numbers:
        return 0, {}
    stream = fs.open(spark._jvm.org.apache.hadoop.fs.Path(folder, str(max(numbers))))
    try:
        content = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    return max(numbers), json.loads(content)


def _put_manifest(spark: SparkSession, path: str, number: int, content: dict) -> None:
    fs, folder = _files(spark, f"{path}/{MANIFESTS}")
    fs.mkdirs(folder)
    named = spark._jvm.org.apache.hadoop.fs.Path(folder, str(number))
    staged = spark._jvm.org.apache.hadoop.fs.Path(folder, f".{uuid.uuid4().hex}")
    stream = fs.create(staged, False)
    try:
        stream.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    finally:
        stream.close()
    if fs.exists(named) or not fs.rename(staged, named):
        fs.delete(staged, False)
        raise RuntimeError(f"another writer has published at {path}; nothing was changed")


def publish(table: DataFrame, path: str, name: str) -> None:
    """Write ``table`` as the part ``name`` of the table at ``path``, in place of an earlier one."""
    publish_parts({name: table}, path)


def publish_parts(parts: dict[str, DataFrame], path: str) -> None:
    """Write several parts, which readers see all at once.  Each has the same columns."""
    if not parts:
        return
    spark = next(iter(parts.values())).sparkSession
    number, content = _latest(spark, path)
    content = dict(content)
    for name, table in parts.items():
        folder = f"part-{uuid.uuid4().hex}"
        table.write.parquet(f"{path}/{folder}")
        content[name] = {"folder": folder, "schema": table.schema.json()}
    _put_manifest(spark, path, number + 1, content)


def withdraw(spark: SparkSession, path: str, name: str) -> None:
    """Take a part out of the table."""
    number, content = _latest(spark, path)
    if name in content:
        _put_manifest(spark, path, number + 1, {k: v for k, v in content.items() if k != name})


def part_names(spark: SparkSession, path: str) -> list[str]:
    return sorted(_latest(spark, path)[1])


def read_versions(spark: SparkSession, path: str, names: list[str] | None = None) -> DataFrame:
    """The rows of the parts, of all or of those named.  A part that was written without rows
    has none; one that was never written is an error."""
    from pyspark.sql.types import StructType

    content = _latest(spark, path)[1]
    names = sorted(content) if names is None else names
    missing = [name for name in names if name not in content]
    if missing or not names:
        raise FileNotFoundError(f"no part {', '.join(missing) or 'at all'} at {path}")
    schema = StructType.fromJson(json.loads(content[names[0]]["schema"]))
    folders = [f"{path}/{content[name]['folder']}" for name in names]
    return spark.read.schema(schema).parquet(*folders)


def old_folders(spark: SparkSession, path: str) -> list[str]:
    """Folders of parts that the newest manifest does not name: replaced ones, and what failed
    writers left.  Nothing deletes them; do so once no reader or writer uses them."""
    fs, folder = _files(spark, path)
    used = {part["folder"] for part in _latest(spark, path)[1].values()}
    if not fs.exists(folder):
        return []
    found = (x.getPath().getName() for x in fs.listStatus(folder))
    return sorted(f"{path}/{name}" for name in found if name.startswith("part-") and name not in used)
