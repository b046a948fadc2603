"""A bounded sample of what looks wrong in a run.

Each cause keeps the rows of the ``k`` smallest priorities, a hash of seed, cause and key.
That is a uniform sample, the same one whatever the order of rows and the number of tasks,
and samples of parts merge into that of the whole.  A task holds ``k`` rows at a time:
nothing is sorted as a whole.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandlex.operators.bands import parse_corpus_lines, unscored_documents

SEED = 42
PER_CAUSE = 20
COLUMNS = ("cause", "key", "detail", "priority")


def priority(cause: Column, key: Column, seed: int = SEED) -> Column:
    """The place of a row in its cause's order, as 32 hexadecimal digits."""
    return F.md5(F.concat_ws("\x1f", F.lit(str(seed)), cause, key).cast("binary"))


def sample_rows(rows: DataFrame, cause: str, k: int = PER_CAUSE, seed: int = SEED) -> DataFrame:
    """``cause, key, detail, priority`` of at most ``k`` rows of ``rows`` (``key, detail``).

    Rows of one key and detail are one.  A null key counts as an empty one.
    """
    key = F.coalesce(F.col("key").cast("string"), F.lit(""))
    listed = rows.select(F.lit(cause).alias("cause"), key.alias("key"), F.col("detail").cast("string").alias("detail"))
    listed = listed.withColumn("priority", priority(F.col("cause"), F.col("key"), seed))
    return merge_samples(listed, k=k)


def merge_samples(*samples: DataFrame, k: int = PER_CAUSE) -> DataFrame:
    """One sample from several of one cause, such as those of batches: the ``k`` first."""
    rows = samples[0]
    for other in samples[1:]:
        rows = rows.unionByName(other)
    return rows.select(*COLUMNS).distinct().orderBy("priority", "key", "detail").limit(k)


def suspect_sample(causes: Mapping[str, DataFrame], k: int = PER_CAUSE, seed: int = SEED) -> DataFrame:
    """The samples of several causes, each a table with ``key`` and ``detail``."""
    found = None
    for cause, rows in causes.items():
        sample = sample_rows(rows, cause, k, seed)
        found = sample if found is None else found.unionByName(sample)
    return found


def unscored(docs: DataFrame, scores: DataFrame) -> DataFrame:
    """Documents whose author has no score, as suspects."""
    return unscored_documents(docs.select("doc_id", "author"), scores).select(F.col("doc_id").alias("key"), F.col("author").alias("detail"))


def bad_lines(lines: DataFrame, line: str = "value", width: int = 80) -> DataFrame:
    """Corpus lines that cannot be read, as suspects: a hash of the line, and its beginning."""
    bad = parse_corpus_lines(lines.select(line), line, "quarantine").where("doc_id is null")
    return bad.select(F.md5(F.col("text").cast("binary")).alias("key"), F.left("text", F.lit(width)).alias("detail"))


def undefined_idf(table: DataFrame) -> DataFrame:
    """Terms in more documents than there are said to be, as suspects."""
    bad = table.where(F.isnan("idf"))
    return bad.select(F.concat_ws(" ", "band", "term").alias("key"), F.concat(F.lit("df "), F.col("df").cast("string")).alias("detail"))
