"""Exact dedup (8): progressive refinement by length, prefix hash and full hash.

Three levels, each over what the one before left: rows alone in their length
leave first, then rows alone in (length, hash of the first characters), and
only the rest have their whole text hashed. Every level counts with a
map-side partial aggregate, so a third of all rows in one group is one row
per task. The keys that survive a level are broadcast when they were counted
and are few, else joined by shuffle; the whole-text hash is taken behind that
join in both cases.

Defined cases: a null text counts as empty; the normalised text lower-cases
A-Z only; of equal texts the row with the largest id stays (a null id is
below all others); rows repeated with the same id and text all carry the
same decision in ``groups`` and are reduced to one by ``drop_duplicates``;
empty input gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from seqrisk.llm.common import lower_ascii, null_safe, saved, small

PREFIX_CHARS = 64


def _text(col: str) -> Column:
    return F.coalesce(F.col(f"`{col}`"), F.lit(""))


def _sha(col: str) -> Column:
    return F.sha2(lower_ascii(_text(col)), 256)


def _prefix(col: str, chars: int) -> Column:
    return F.xxhash64(lower_ascii(F.substring(_text(col), 1, chars)))


def _suspects(docs: DataFrame, id_col: str, text_col: str, prefix_chars: int) -> DataFrame:
    """The (len, prefix) keys that more than one row has, as a table."""
    rows = saved(docs.select(F.octet_length(_text(text_col)).alias("len"), _prefix(text_col, prefix_chars).alias("prefix")))
    lengths = saved(rows.groupBy("len").count().where("count > 1").select("len"))
    by_length = rows.join(F.broadcast(lengths) if small(lengths) else lengths, "len", "left_semi")
    return saved(by_length.groupBy("len", "prefix").count().where("count > 1").select("len", "prefix"))


def _keyed(docs: DataFrame, keys: DataFrame, text_col: str, prefix_chars: int) -> DataFrame:
    """``docs`` with __sha: the hash of the whole text of rows whose key is in ``keys``, null for all others. The text is
    only read in full behind this join, at every size."""
    found = keys.select(F.col("len").alias("__l"), F.col("prefix").alias("__p"), F.lit(True).alias("__hit"))
    on = (F.octet_length(_text(text_col)) == F.col("__l")) & (_prefix(text_col, prefix_chars) == F.col("__p"))
    joined = docs.join(F.broadcast(found) if small(keys) else found, on, "left")
    return joined.withColumn("__sha", F.when(F.col("__hit"), _sha(text_col))).drop("__l", "__p", "__hit")


def _groups(keyed: DataFrame, id_col: str) -> DataFrame:
    """One row per group of two or more rows with equal texts: text_sha256,
    keep_id, group_size, n_keep (rows that carry keep_id)."""
    per_id = keyed.where("__sha is not null").groupBy(F.col("__sha").alias("text_sha256"), F.col(f"`{id_col}`").alias("id")).count()
    return (per_id.groupBy("text_sha256")
            .agg(F.sum("count").alias("group_size"), F.max(F.struct("id", "count")).alias("top"))
            .where("group_size > 1")
            .select("text_sha256", F.col("top.id").alias("keep_id"), "group_size", F.col("top.count").alias("n_keep")))


def equal_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """One row per group of two or more rows with equal texts: text_sha256,
    keep_id, group_size, n_keep (rows that carry keep_id)."""
    two = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    return _groups(_keyed(two, _suspects(docs, id_col, text_col, prefix_chars), text_col, prefix_chars), id_col)


def mark_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256
    (asked of every row, so it is made once more in this projection). Rows meet
    the groups by broadcast where these were counted and are few."""
    groups = saved(equal_groups(docs, id_col, text_col, prefix_chars))
    rows = docs.select(F.col(f"`{id_col}`").alias(id_col), _sha(text_col).alias("text_sha256"))
    keep = F.when(F.col("group_size").isNull(), F.col(f"`{id_col}`")).otherwise(F.col("keep_id"))
    return rows.join(F.broadcast(groups) if small(groups) else groups, "text_sha256", "left").select(
        f"`{id_col}`", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col(f"`{id_col}`").eqNullSafe(keep).alias("kept"), "text_sha256")


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """``docs`` without all but one row of each group of equal texts. Rows of no
    suspect key pass without their text being hashed."""
    keys = _suspects(docs, id_col, text_col, prefix_chars)
    keyed = _keyed(docs, keys, text_col, prefix_chars)
    groups = saved(_groups(_keyed(docs.select(f"`{id_col}`", f"`{text_col}`"), keys, text_col, prefix_chars), id_col))
    named = groups.select(F.col("text_sha256").alias("__of"), F.col("keep_id").alias("__keep"),
                          F.col("group_size").alias("__size"), F.col("n_keep").alias("__n_keep"))
    joined = keyed.join(F.broadcast(named) if small(groups) else named, F.col("__sha") == F.col("__of"), "left")
    stays = joined.where(F.col("__size").isNull() | F.col(f"`{id_col}`").eqNullSafe(F.col("__keep")))
    cols = [f"`{c}`" for c in docs.columns]
    once = stays.where(F.coalesce(F.col("__n_keep"), F.lit(1)) == 1).select(*cols)
    repeated = stays.where(F.col("__n_keep") > 1).dropDuplicates(["__sha"]).select(*cols)
    return once.unionByName(repeated)
