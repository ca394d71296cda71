"""Line dedup by a log-template tree, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolescope.llm.base import materialize

VARIABLE = "<*>"
SPACES = " \\t\\r\\f\\x0B"


def _masked(line):
    """The words of a line, one space between them; those with a digit are variable fields."""
    digit = f"(?<![^{SPACES}])[^{SPACES}0-9]*+[0-9][^{SPACES}]*+"
    return F.trim(F.regexp_replace(F.regexp_replace(line, digit, VARIABLE), f"[{SPACES}]+", " "))


def line_templates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                   depth: int = 3, min_docs: int = 5, constant: float = 0.5,
                   similarity: float = 0.6) -> DataFrame:
    """``id, n_lines, n_dropped, text``: every row, its text without recurring template lines.

    A token with a digit is a variable field. A line whose tokens recur, field for field, in
    ``min_docs`` distinct texts is dropped, whatever else shares its place in the tree.

    The others go by template. A fixed-depth tree leads each line by its number of tokens and its
    first ``depth`` tokens to a leaf, and there by its next token to a branch: that token's own if
    ``min_docs`` different lines of the leaf hold it, else the leaf's common one. In a branch,
    where each different line counts once, a position beyond the depth is constant if one token
    (of equally frequent ones the largest) holds at least ``constant`` of the lines and two of
    them. A line follows the branch's template when its constant tokens make up ``similarity`` of
    its positions beyond the depth, so the leading tokens alone never suffice; if lines of
    ``min_docs`` distinct texts follow it, all of them are dropped, wherever they stand. Lines
    without a token stay.

    Identical texts count once, so a group of copies does not make its own lines recur. Lines are
    known by 64-bit hashes and a number; only one line of each kind in a leaf that can recur meets
    its tokens again. A branch's positions, not its lines, meet in one row, so a line that a third
    of all documents share stays spread. Texts are shuffled twice, by their hashes, at every size.

    NULL text is empty (one line without a token); very long texts and lines are read whole; NULL
    and repeated ids are rows like any other; an empty table gives no rows; other columns are
    ignored.
    """
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    keyed = source.withColumn("key", F.xxhash64("text"))
    words = F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit(""))) + 1
    lines = (keyed.select("id", "key", F.posexplode(F.split("text", "\n")).alias("line_no", "raw"))
             .select("id", "key", "line_no", _masked(F.col("raw")).alias("line"))
             .where("line <> ''")
             .select("id", "key", "line_no", F.xxhash64("line").alias("seq"), F.xxhash64(
                 F.concat_ws(" ", words.cast("string"), F.substring_index("line", " ", depth)))
                 .alias("leaf")))
    # the lines of each distinct text, which stands for all its copies
    lines = materialize(lines.groupBy("key", "line_no", "seq", "leaf")
                        .agg(F.min("id").alias("first")), "line-leaves")
    kinds = materialize(
        lines.groupBy("leaf", "seq", "key").agg(F.min(F.struct("line_no", "first")).alias("at"))
        .groupBy("leaf", "seq").agg(F.count(F.lit(1)).alias("texts"),
                                    F.min(F.struct("key", "at")).alias("at")), "line-kinds")
    reached = (kinds.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.sum("texts").alias("texts"))
               .where((F.col("n") > 1) & (F.col("texts") >= min_docs)).select("leaf"))
    found = (kinds.join(reached, "leaf", "left_semi")
             .groupBy(F.col("at.key").alias("at_key"), F.col("at.at.first").alias("first"))
             .agg(F.collect_list(F.struct("leaf", "seq", "at.at.line_no")).alias("at")))
    all_lines = F.split("text", "\n")  # at most the lines of one text in ``at``
    met = (keyed.join(found.hint("merge"), (F.col("key") == F.col("at_key"))
                      & F.col("id").eqNullSafe(F.col("first")))
           .select(F.explode(F.transform("at", lambda x: F.struct(
               x["leaf"].alias("leaf"), x["seq"].alias("seq"),
               F.split(_masked(F.get(all_lines, x["line_no"])), " ").alias("tokens"))))
               .alias("x"))
           .select("x.leaf", "x.seq", F.slice("x.tokens", depth + 1, F.size("x.tokens"))
                   .alias("tail")).where(F.size("tail") > 0))
    met = materialize(met.dropDuplicates(["leaf", "seq"]).withColumn("head", F.get("tail", F.lit(0))),
                      "line-tokens")
    heads = (met.groupBy("leaf", "head").agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") >= min_docs).select("leaf", "head", F.col("head").alias("branch")))
    met = materialize(met.join(heads, ["leaf", "head"], "left").drop("head")
                      .withColumn("branch", F.coalesce("branch", F.lit(""))), "line-branches")
    branch = ["leaf", "branch"]
    counts = (met.select(*branch, F.posexplode("tail").alias("pos", "token"))
              .groupBy(*branch, "pos", "token").agg(F.count(F.lit(1)).alias("c")))
    top = counts.groupBy(*branch, "pos").agg(
        F.sum("c").alias("lines"), F.max(F.struct("c", "token")).alias("top"))
    template = (top.where((F.col("top.c") >= constant * F.col("lines")) & (F.col("top.c") > 1))
                .groupBy(*branch).agg(F.collect_list(
                    F.struct("pos", F.col("top.token").alias("token"))).alias("fixed")))
    same = F.size(F.filter("fixed", lambda x: F.col("tail")[x["pos"]] == x["token"]))
    follow = materialize(met.join(template, branch).where(same >= similarity * F.size("tail"))
                         .select(*branch, "seq"), "line-follow")
    recurring = (lines.select("seq", "key").join(follow, "seq").select(*branch, "key").distinct()
                 .groupBy(*branch).agg(F.count(F.lit(1)).alias("texts"))
                 .where(F.col("texts") >= min_docs))
    goes = (kinds.where(F.col("texts") >= min_docs).select("seq")
            .unionByName(follow.join(recurring, branch, "left_semi").select("seq")).distinct())
    dropped = (lines.join(goes, "seq", "left_semi").groupBy("key")
               .agg(F.collect_list("line_no").alias("gone")))
    gone = F.coalesce("gone", F.array().cast("array<int>"))
    return keyed.join(dropped.hint("merge"), "key", "left").select(
        F.col("id").alias(id_col), all_lines.alias("all"), gone.alias("gone")).select(
        id_col, F.size("all").cast("bigint").alias("n_lines"),
        F.size("gone").cast("bigint").alias("n_dropped"),
        F.array_join(F.filter("all", lambda _, i: ~F.array_contains("gone", i)), "\n")
        .alias("text"))
