"""Exact duplicates by skew-safe combining.

Rows are combined three times, and full texts are compared each time: inside every map
task, then per salt of each digest, then the salt winners of each digest. A text with
copies in a third of all rows thus reaches a task as one row per map task at most.

Defined cases: a null text counts as empty; a null id is smaller than every other id;
rows that repeat an id and a text are the same document and say the same; other columns
play no part, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklane.session import settle

#: Parts that the copies of one text are dealt to before the last combining.
SALTS = 32


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _salt() -> Column:
    # constant within a map task, so that the task combines all its copies of a text
    return F.pmod(F.spark_partition_id(), F.lit(SALTS))


def text_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """Each row's class: doc_id, keep_id, group_size, kept, digest.

    ``keep_id`` is the largest id among rows of the same text. A digest shared by
    different texts is resolved by the texts themselves.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).withColumn("digest", digest(F.col("text")))
    salted = (
        rows.withColumn("salt", _salt())
        .groupBy("digest", "text", "salt")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    )
    winners = salted.groupBy("digest", "text").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )
    # the texts have been compared; what follows needs only whether a digest stands for one
    classes = settle(
        winners.groupBy("digest").agg(
            F.count("*").alias("texts"),
            F.max("keep_id").alias("keep_id"),
            F.max("group_size").alias("group_size"),
        )
    )
    found = rows.select("doc_id", "digest").join(
        classes.where("texts = 1").drop("texts"), "digest"
    )
    clashes = classes.where("texts > 1").select("digest")
    if not clashes.isEmpty():
        of_texts = winners.join(clashes, "digest", "left_semi")
        found = found.unionByName(
            rows.join(of_texts, ["digest", "text"]).select(found.columns)
        )
    return found.select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest",
    )


def _orderable(docs: DataFrame) -> list[str]:
    return [name for name, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]


def drop_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per text, whole and with all columns: that of the largest id.

    Among rows with the same id and text the largest of the other columns stays. The
    row travels with its text through the same three combinings, so there is no join.
    """
    others = [c for c in docs.columns if c != text_col]
    tie = [c for c in _orderable(docs) if c not in (id_col, text_col)]
    by_name = {c: F.col(f"`{c}`") for c in docs.columns}
    rows = docs.select(
        F.coalesce(by_name[text_col], F.lit("")).alias("text"),
        F.struct(
            by_name[text_col].isNull().alias("no_text"),
            F.struct(*[by_name[c].alias(f"c{i}") for i, c in enumerate(others)]).alias("cells"),
        ).alias("row"),
        F.struct(by_name[id_col], *[by_name[c] for c in tie]).alias("rank"),
    ).withColumn("digest", digest(F.col("text")))
    best = F.max_by("row", "rank").alias("row"), F.max("rank").alias("rank")
    salted = rows.withColumn("salt", _salt()).groupBy("digest", "text", "salt").agg(*best)
    kept = salted.groupBy("digest", "text").agg(*best)
    place = {c: f"row.cells.c{i}" for i, c in enumerate(others)}
    return kept.select(
        *[
            F.when(~F.col("row.no_text"), F.col("text")).alias(c)
            if c == text_col
            else F.col(place[c]).alias(c)
            for c in docs.columns
        ]
    )
