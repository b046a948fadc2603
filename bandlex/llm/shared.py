"""What several operators of this subpackage use."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bandlex.operators.lookup import fits_broadcast

#: White space that separates words, as a regular expression (Java and RE2).
SPACE = r"[\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, as ``spark.checkpoint.dir``
    names it.  A local session that names none, such as a test, gets its own; a cluster has
    to name one, since its executors do not see the driver's folders."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if named is None and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="llm-"))
    return (named or context.getCheckpointDir()).rstrip("/")


def settle(table: DataFrame) -> DataFrame:
    """The table read back from a checkpoint in the shared folder: computed once, with
    its lineage cut, and independent of the executors that made it."""
    shared_folder(table.sparkSession)
    return table.checkpoint()


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def words(text: str | Column) -> Column:
    """The words of a text; none of a null."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def one_row(**columns: Column) -> Column:
    """A generator of one row with these columns.

    Unlike a projection it is a barrier: what it computes is not copied into the
    expressions above it, where a lambda would evaluate it once per element.
    """
    return F.inline(F.array(F.struct(*(c.alias(name) for name, c in columns.items()))))


#: What the names of working columns end in, beside those of a caller's table.
PRIVATE = uuid.uuid4().hex
#: The column that, with ``doc_id``, tells rows of documents apart.
DIGEST = f"digest_{PRIVATE}"


def set_aside(docs: DataFrame, *used: str) -> DataFrame:
    """``docs`` with names that clash with nothing for all columns but those ``used``.
    `bring_back` gives them their own again."""
    return docs.toDF(*(c if c in used else f"c{i}_{PRIVATE}" for i, c in enumerate(docs.columns)))


def bring_back(aside: DataFrame, docs: DataFrame, *used: str) -> DataFrame:
    """The columns of ``docs`` in a table made from what `set_aside` returned."""
    names = (c if c in used else f"c{i}_{PRIVATE}" for i, c in enumerate(docs.columns))
    return aside.select(*(F.col(name).alias(c) for name, c in zip(names, docs.columns)))


def row_digest(*columns: str) -> Column:
    """SHA-256 of the columns' values, in hexadecimal; nulls count as empty."""
    values = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)
    return F.sha2(F.concat_ws("\x1f", *values).cast("binary"), 256)


def _on_rows(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Join on ``doc_id`` and the digest with nulls equal; ``keys`` is broadcast only when
    its measured size allows."""
    keys = keys.select(F.col("doc_id").alias("_id"), F.col(DIGEST).alias("_key")).distinct()
    keys = F.broadcast(keys) if fits_broadcast(keys, "_key") else keys
    return rows.join(keys, (rows[DIGEST] == keys["_key"]) & rows["doc_id"].eqNullSafe(keys["_id"]), how)


def without_rows(rows: DataFrame, gone: DataFrame, repeated: DataFrame) -> DataFrame:
    """``rows`` without those among ``gone``, and one of each among ``repeated``; both are
    named by ``doc_id`` and digest.  The digest is dropped.

    Rows move with their text only if their keys are too many to be broadcast, or if they
    repeat an id and a text.
    """
    stays = _on_rows(rows, gone, "left_anti")
    if not repeated.isEmpty():
        once = _on_rows(stays, repeated, "left_semi").dropDuplicates(["doc_id", DIGEST])
        stays = _on_rows(stays, repeated, "left_anti").unionByName(once)
    return stays.drop(DIGEST)
