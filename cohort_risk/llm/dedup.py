"""Exact duplicates by full content, safe against groups of any size.

Rows are first counted by two independent digests of their whole normalised text. A text whose
digests occur once has no equal, so its content goes no further. The others are combined by
content, so that equal digests of different texts never meet:

1. each task combines the equal texts of its own rows (the partial aggregation below the
   shuffle), so that a text leaves a task once however often it occurs there;
2. what is left is combined within salts, which deal the winners of a text that all tasks
   hold over several reducers;
3. the winners of the salts, at most one for each salt and text, are combined globally.

Rows then look up their group by both digests. Both joins lie directly over shuffles, so
adaptive execution can split a hot text there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_risk import session
from cohort_risk.session import free_shuffles, stored

#: Reducers that the copies of one text are dealt over.
SALTS = 16


def normalised(text) -> F.Column:
    """Runs of ASCII white space become one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _digested(df: DataFrame, text_col: str, *columns) -> DataFrame:
    rows = df.select(*columns, normalised(F.col(text_col)).alias("content"))
    return rows.select("*", *_digests())


def _digests() -> list[F.Column]:
    return [F.sha2("content", 256).alias("digest"), F.xxhash64("content").alias("check")]


def groups(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
           salts: int = SALTS) -> DataFrame:
    """One row per distinct normalised text: digest, check, keep_id, group_size."""
    rows = _digested(df, text_col, F.col(id_col).alias("id"))
    counted = session.stored(rows.groupBy("digest", "check").agg(
        F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "exact-digests")
    repeated = rows.join(counted.filter("group_size > 1"), ["digest", "check"], "left_semi")
    # grouped without the digests: Spark would take the join's shuffle for the salted one
    salted = (repeated.withColumn("salt", F.spark_partition_id() % salts)
              .groupBy("salt", "content").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n")))
    equal = (salted.groupBy("content")
             .agg(F.min("id").alias("keep_id"), F.sum("n").alias("group_size"))
             .select(*_digests(), "keep_id", "group_size"))
    return counted.filter("group_size = 1").unionByName(equal)


def mark(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
         salts: int = SALTS) -> DataFrame:
    """Every row's id with keep_id, group_size, kept and text_sha256.

    ``keep_id`` is the smallest id among equal texts, and ``kept`` is true where it is the
    row's own. Null texts count as empty. Ids name rows: rows that repeat an id and its text
    share their fate. A null id is kept only if no other row of the group has an id.
    """
    found = stored(groups(df, text_col, id_col, salts), "exact-groups")
    rows = _digested(df, text_col, F.col(id_col)).drop("content")
    return rows.join(found, ["digest", "check"]).select(
        id_col, "keep_id", "group_size", F.col(id_col).eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"))


def keep_one(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
             salts: int = SALTS) -> DataFrame:
    """The rows of ``df`` that ``mark`` keeps, with their columns, row by row.

    A row stays where its id is the ``keep_id`` of its own text's group: the lookup is by
    id and both digests, so a row whose id also names a kept row of another text goes.
    """
    found = stored(groups(df, text_col, id_col, salts).select("keep_id", "digest", "check"), "exact-kept")
    free_shuffles(df.sparkSession)  # the content's, before the rows go through one of their own
    rows = df.select("*", F.sha2(normalised(F.col(text_col)), 256).alias("__digest"),
                     F.xxhash64(normalised(F.col(text_col))).alias("__check"))
    on = (rows[id_col].eqNullSafe(found["keep_id"]) & (rows["__digest"] == found["digest"])
          & (rows["__check"] == found["check"]))
    return rows.join(found, on, "left_semi").drop("__digest", "__check")
