"""Removal of lines that many documents share.

Everything is DataFrame expressions, and lines travel as two 64-bit hashes of their key, never as text:

1. Lines long enough to count become (hash, document, position) rows, written once.
2. The rows are range-partitioned by hash and a salt of the document, and sorted inside by document and position; one
   stream over each partition counts the first line of each document. The salt lets a line that a third of all
   documents hold spread over many ranges; the salted counts are summed by hash afterwards.
3. Lines found in enough documents lose all rows but those of the largest document. Dropped positions become bitmaps of
   64-line words, and only words with a dropped line are stored: an absent word means that all its lines stay.
4. The bitmaps meet the texts once, when they are applied.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window, functions as F

from cardloom.sources.tables import stage

BLANK = " \t\n\u000b\f\r"
SALTS = 64


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    core = F.btrim(line, F.lit(BLANK))
    return F.when(F.octet_length(core) == F.length(core), F.lower(core)).otherwise(
        F.translate(core, string.ascii_uppercase, string.ascii_lowercase))


def line_hashes(docs: DataFrame, min_chars: int, key: str, text: str) -> DataFrame:
    """(``doc``, ``version``, ``pos``, ``h1``, ``h2``) of every line whose key has ``min_chars`` code points.

    ``version`` is a hash of the text: it tells apart rows that share a key."""
    lines = docs.select(F.col(key).alias("doc"), F.xxhash64(text).alias("version"),
                        F.posexplode(F.split(F.coalesce(text, F.lit("")), "\n", -1)).alias("pos", "line"))
    keyed = lines.where(F.length("line") >= min_chars).select("doc", "version", "pos", line_key(F.col("line")).alias("k"))
    return keyed.where(F.length("k") >= min_chars).select(
        "doc", "version", "pos", F.xxhash64("k").alias("h1"), F.xxhash64("k", F.lit(1)).alias("h2"))


def repeated_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """(``h1``, ``h2``, ``keeper``) of the lines that at least ``min_docs`` documents hold; the largest is the keeper."""
    group = ["h1", "h2", "salt"]
    ranged = lines.select("h1", "h2", F.pmod(F.xxhash64("doc"), F.lit(SALTS)).alias("salt"), "doc", "pos").repartitionByRange(*group)
    stream = Window.partitionBy(*group).orderBy(F.desc("doc"), "pos")
    first = (F.row_number().over(stream) == 1) | ~F.lag("doc").over(stream).eqNullSafe(F.col("doc"))
    salted = ranged.select(*group, "doc", first.alias("first")).groupBy(*group).agg(
        F.count_if("first").alias("docs"), F.max("doc").alias("keeper"))
    return (salted.groupBy("h1", "h2").agg(F.sum("docs").alias("docs"), F.max("keeper").alias("keeper"))
            .where(F.col("docs") >= min_docs).select("h1", "h2", "keeper"))


def keep_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Of every row that loses lines: ``doc``, ``version`` and ``keep``, an array of (``word``, ``bits``).

    Bit i of word w says whether line 64 w + i stays; words that keep all their lines are left out. Rows with a null
    key count as one document, smaller than any other; rows that share a key are one document, too.
    """
    lines = stage(line_hashes(docs, min_chars, key, text), "lines")
    repeated = stage(repeated_lines(lines, min_docs), "repeated")  # stored, so that the join may split a very common line
    dropped = (lines.join(repeated, ["h1", "h2"]).where(~F.col("doc").eqNullSafe(F.col("keeper")))
               .select("doc", "version", "pos").repartition("doc", "version"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("pos") % 64)
    words = dropped.groupBy("doc", "version", F.floor(F.col("pos") / 64).cast("int").alias("word")).agg(
        F.bitwise_not(F.bit_or(bit)).alias("bits"))
    return words.groupBy("doc", "version").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("keep"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``row`` (the whole input row as a struct), ``n_lines``, ``n_dropped`` and ``kept``, the remaining text.

    Bitmaps grow with the documents, so they are merged at every size and never broadcast."""
    packed = docs.select(F.struct("*").alias("row"), F.col(key).alias("d"), F.xxhash64(text).alias("v"))
    joined = packed.join(bitmaps.hint("merge"), F.col("d").eqNullSafe(F.col("doc")) & (F.col("v") == F.col("version")), "left")
    whole = F.coalesce(F.col(f"row.`{text}`"), F.lit(""))
    cut = joined.select("row", whole.alias("t"), F.split(whole, "\n", -1).alias("lines"),
                        F.map_from_entries("keep").alias("words"))
    kept = cut.select("row", F.size("lines").cast("long").alias("n_lines"), "t", F.when(F.col("words").isNotNull(), F.filter(
        "lines", lambda x, i: F.getbit(F.coalesce(F.col("words")[F.floor(i / 64).cast("int")], F.lit(-1).cast("long")), i % 64) == 1)).alias("left"))
    return kept.select("row", "n_lines", F.when(F.col("left").isNull(), 0).otherwise(F.col("n_lines") - F.size("left")).cast("long").alias("n_dropped"),
                       F.when(F.col("left").isNull(), F.col("t")).otherwise(F.array_join("left", "\n")).alias("kept"))


def line_dedup(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, key: str = "doc_id",
               text: str = "text") -> DataFrame:
    """``apply_bitmaps`` with the bitmaps of the same documents.

    A null or empty text is one empty line. Repeated rows, null keys and further columns of any name stay as they are;
    an empty table gives an empty table.
    """
    return apply_bitmaps(docs, stage(keep_bitmaps(docs, min_chars, min_docs, key, text), "bitmaps"), key, text)


def digests(docs: DataFrame, **options) -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_dropped`` and ``kept_sha256`` of every row."""
    return line_dedup(docs.select("doc_id", "text"), **options).select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


DIGEST_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS k FROM lines),
repeated AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE keeper <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN repeated USING (k) GROUP BY doc_id"""
