"""Exact duplicates: 128-bit content hash, bytes compared inside groups."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolescope.llm.base import fresh, materialize

HASH_BITS = 128


def folded(text: Column) -> Column:
    """The text with A-Z lower-cased and nothing else; NULL is empty.

    ``lower`` folds every alphabet, so it takes only texts that are ASCII throughout: those of as
    many bytes as characters. ``translate`` goes character by character and takes the others.
    """
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, ascii_uppercase, ascii_lowercase))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                 keep: str = "smallest", hash_bits: int = HASH_BITS) -> DataFrame:
    """``id, keep_id, group_size, kept, text_sha256`` for every row.

    Texts are equal when they are identical after lower-casing A-Z; NULL counts as empty. Groups
    are formed by the hash *and* the bytes: the aggregate's key holds the text itself, so copies
    are folded on the map side (a hot group reaches the shuffle as one row per task) and a hash
    collision splits into its true groups. Only texts whose hash is shared by different texts
    meet their bytes again when rows are labelled; all others find their group by the hash.

    ``keep`` says which id of a group stays: ``smallest`` or ``largest``. An empty table gives no
    rows, repeated rows count each time, rows with a NULL id belong to groups but are never the
    one that stays unless the whole group has no id (``kept`` is then false). If the id that stays
    is repeated in its group, all its rows are marked. Other columns are ignored.
    ``hash_bits`` shortens the hash, for tests of collisions.
    """
    pick = {"smallest": F.min, "largest": F.max}[keep]
    size = hash_bits // 8
    # all of it in the JVM: whole texts sent through Python workers would be held there once more
    hashed = docs.select(F.col(id_col).alias("id"), folded(F.col(text_col)).alias("body")).select(
        "id", F.substring(F.unhex(F.md5("body")), 1, size).alias("h"),
        F.sha2("body", 256).alias("sha"), "body")
    texts = materialize(
        hashed.groupBy("h", "body").agg(F.count(F.lit(1)).alias("n"), pick("id").alias("keep_id"),
                                        F.min("sha").alias("sha"))
        .withColumn("n_texts", F.lit(1)).drop("body"), "exact-groups")
    per_hash = texts.groupBy("h").agg(
        F.count(F.lit(1)).alias("n_texts"), F.min("n").alias("n"),
        F.min("keep_id").alias("keep_id"))
    # hashes of two or more texts: their rows find the group by the full digest of their bytes
    split = texts.join(per_hash.where("n_texts > 1").select("h"), "h", "left_semi").select(
        "h", "sha", F.col("n").alias("own_n"), F.col("keep_id").alias("own_keep"))
    rows = hashed.select("id", "h", "sha")
    found = rows.join(per_hash, "h", "left").join(split, ["h", "sha"], "left")
    one = F.col("n_texts") == 1
    keep_id = F.when(one, F.col("keep_id")).otherwise(F.col("own_keep"))
    return found.select(
        F.col("id").alias(id_col), keep_id.alias("keep_id"),
        F.when(one, F.col("n")).otherwise(F.col("own_n")).alias("group_size"),
        F.coalesce(F.col("id") == keep_id, F.lit(False)).alias("kept"),
        F.col("sha").alias("text_sha256"))


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
               keep: str = "smallest", without_id: bool = False) -> DataFrame:
    """The rows that stay, with all their columns: one row of each group of equal texts.

    A survivor is known by its id and the digest of its text, so different texts that share an id
    stay each. Groups of which no row has an id are left out, unless ``without_id`` lets one row of
    each stay.
    """
    groups = exact_groups(docs, id_col, text_col, keep=keep)
    stays = F.col("kept")
    if without_id:
        stays = stays | F.col("keep_id").isNull()
    stay = groups.where(stays).select(F.col(id_col).alias("stay_id"),
                                      F.col("text_sha256").alias("stay_sha")).distinct()
    digest = fresh(docs, "digest")
    own = docs.withColumn(digest, F.sha2(folded(F.col(text_col)), 256))
    kept = own.join(stay, own[id_col].eqNullSafe(stay["stay_id"])
                    & (own[digest] == stay["stay_sha"]), "left_semi")
    return kept.dropDuplicates([id_col, digest]).drop(digest)
