"""Line deduplication over a corpus, in DataFrame functions only.

A line's key is the line without ASCII white space at both ends and with A-Z
in lower case.  Keys of at least ``min_chars`` code points are hashed to 128
bits; a key found in ``min_docs`` or more documents loses all its lines but
those of the largest ``doc_id`` holding it.  Other lines stay in place.

Only hashes and positions of lines are shuffled for counting.  Counting is in
two steps, (key, document) and then key, both combined before their shuffle,
so that a line found in a third of all documents is a few rows per map task.
The text itself is shuffled once, to meet the positions it loses.

Edge cases: a null or empty text is one empty line; rows with the same
``doc_id`` count as one document; rows with a null ``doc_id`` count together
as one document that is smaller than any other; repeated rows give repeated
results; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANK = " \t\n\x0b\x0c\r"


def _ascii_lower(c: Column) -> Column:
    """A-Z only; ``lower`` does just that wherever every byte is a character."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)) \
            .otherwise(F.translate(c, UPPER, UPPER.lower()))


def line_key(line: Column) -> Column:
    return _ascii_lower(F.btrim(line, F.lit(BLANK)))


def _hash128(c: Column) -> list[Column]:
    return [F.xxhash64(c).alias("_h1"), F.xxhash64(F.lit(7), c).alias("_h2")]


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``text_col`` rebuilt, plus ``_n_lines`` and ``_n_dropped`` (replaced if there)."""
    rows = docs.select(F.col(id_col).alias("_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    lines = (rows.select("_id", *[h.alias(n) for h, n in zip(_hash128(F.col("_t")), ("_t1", "_t2"))],
                         F.posexplode(F.split("_t", "\n")).alias("_pos", "_line"))
             .select("_id", "_t1", "_t2", "_pos", line_key(F.col("_line")).alias("_key"))
             .filter(F.char_length("_key") >= min_chars)
             .select("_id", "_t1", "_t2", "_pos", *_hash128(F.col("_key"))))
    # written, so that the join below has a shuffle on both sides and AQE can split a frequent line
    common = materialise(
        lines.select("_h1", "_h2", "_id").distinct()
        .groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n"), F.max("_id").alias("_keep"))
        .filter(F.col("_n") >= min_docs), "common")
    dropped = (lines.join(common, ["_h1", "_h2"])
               .filter(~F.col("_id").eqNullSafe(F.col("_keep")))
               .groupBy("_id", "_t1", "_t2").agg(F.collect_set("_pos").alias("_lost"))
               .select(F.col("_id").alias("_d"), F.col("_t1").alias("_d1"),
                       F.col("_t2").alias("_d2"), "_lost"))
    t1, t2 = _hash128(F.col("_x"))
    # the row travels as one struct, so that no column of it meets ours
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                        F.col(id_col).alias("_i"), F.coalesce(F.col(text_col), F.lit("")).alias("_x"))
    met = whole.join(dropped, F.col("_i").eqNullSafe(F.col("_d"))
                     & (t1 == F.col("_d1")) & (t2 == F.col("_d2")), "left") \
        .select("_row", "_x", "_lost", F.split("_x", "\n").alias("_lines"))
    places = F.sequence(F.lit(0), F.size("_lines") - 1)
    kept = F.transform(F.array_except(places, F.col("_lost")), lambda i: F.get(F.col("_lines"), i))
    ours = ("_n_lines", "_n_dropped", text_col)
    return met.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c not in ours],
                      F.when(F.col("_lost").isNull(), F.col("_x"))
                      .otherwise(F.array_join(kept, "\n")).alias(text_col),
                      F.size("_lines").cast("long").alias("_n_lines"),
                      F.when(F.col("_lost").isNull(), 0).otherwise(F.size("_lost")).cast("long").alias("_n_dropped"))


def line_digests(docs: DataFrame) -> DataFrame:
    """The query: one row per document with line counts and the digest of what stays."""
    out = dedup_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"),
                      F.col("_n_dropped").alias("n_dropped"),
                      F.sha2(F.col("text"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls
           FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT r, doc_id, pos, line,
             translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS keep FROM k WHERE length(key) >= 20
      GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.keep AS gone FROM k LEFT JOIN c USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r
"""
