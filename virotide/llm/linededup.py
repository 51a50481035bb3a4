"""Line dedup over content-defined chunks, in DataFrame functions alone.

Lines are hashed; a rolling hash over two neighbouring line hashes ends a chunk at one line in ``every`` on
average, so boundaries depend on the lines around them and not on where they stand. Chunks of two lines or
more that occur elsewhere are compared byte for byte, and all but the first occurrence (smallest document,
then place) are removed.

``remove_runs`` does not depend on where chunks end: each two neighbouring lines are compared, so every run of
two lines or more that stands at an earlier place is removed whole. ``remove_repeats`` is the chunk rule of ``op9``.

Defined cases: a null text stays null and an empty one empty; a text all of whose chunks are removed becomes
empty, its row stays; rows without an id come after all others; rows equal in id and text count as one
document; an empty table stays empty; other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from virotide.llm.common import NO_ID, keep

EVERY = 4


def _marked(docs: DataFrame, every: int) -> DataFrame:
    """``docs`` with ``_lines`` and ``_ends``: the number of the last line of each chunk, from 1."""
    value = lambda line: F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")
    rows = docs.withColumn("_lines", F.split(F.col("text").cast("string"), "\n", -1)).withColumn("_hashes", F.transform("_lines", value))
    before = F.concat(F.array(F.lit(0).cast("long")), F.slice("_hashes", 1, F.size("_hashes") - 1))
    rolled = F.zip_with("_hashes", before, lambda a, b: F.pmod(a * 31 + b, F.lit(every)) == 0)
    rows = rows.withColumn("_stops", rolled)
    # Zipping numbers in keeps each flag beside its place: no array is looked up inside a lambda.
    numbered = F.zip_with("_stops", F.sequence(F.lit(1), F.size("_stops")), lambda stop, n: F.when(stop | (n == F.size("_lines")), n))
    return rows.withColumn("_ends", F.array_compact(numbered)).drop("_hashes", "_stops")


def _chunk_list(lines: str = "_lines", ends: str = "_ends"):
    """Structs of chunk number (from 1), count of lines and text."""
    starts = F.concat(F.array(F.lit(0)), F.slice(ends, 1, F.size(ends) - 1))
    spans = F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), (b - a).alias("n_lines")))
    return F.transform(
        spans,
        lambda s, i: F.struct((i + 1).alias("chunk_no"), s["n_lines"].alias("n_lines"), F.array_join(F.slice(lines, s["start"] + 1, s["n_lines"]), "\n").alias("chunk")),
    )


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))).withColumn("_text", F.xxhash64(F.col("text").cast("string")))


def chunks(docs: DataFrame, every: int = EVERY) -> DataFrame:
    """``(_id, _text, chunk_no, n_lines, chunk)`` of the chunks of two lines or more."""
    rows = _marked(_keyed(docs.select("doc_id", "text")).where("text is not null"), every)
    listed = F.filter(_chunk_list(), lambda c: c["n_lines"] > 1)
    return rows.select("_id", "_text", F.explode(listed).alias("c")).select("_id", "_text", "c.*")


def repeated(docs: DataFrame, every: int = EVERY) -> DataFrame:
    """``(_id, _text, chunk_no)`` of the later occurrences of chunks.

    Hashes alone are counted first; only chunks whose hash occurs twice are moved with their text. Both
    sides of each join are plain shuffles, so the adaptive join splits a chunk that most documents share.
    """
    found = chunks(docs, every).withColumn("hash", F.xxhash64("chunk"))
    often = keep(found.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "hashes")
    candidates = keep(found.join(often, "hash"), "candidates")
    first = F.min(F.struct("_id", "_text", "chunk_no")).alias("first")
    firsts = keep(candidates.groupBy("hash", "chunk").agg(first, F.count("*").alias("n")).where("n > 1").drop("n"), "firsts")
    later = candidates.join(firsts, ["hash", "chunk"]).where(F.struct("_id", "_text", "chunk_no") > F.col("first"))
    return later.select("_id", "_text", "chunk_no")


def remove_repeats(docs: DataFrame, every: int = EVERY) -> DataFrame:
    """``docs`` with repeated chunks cut from ``text``; all columns and rows stay."""
    gone = keep(repeated(docs, every).groupBy("_id", "_text").agg(F.collect_set("chunk_no").alias("_gone")), "repeats")
    rows = _marked(_keyed(docs).join(gone, ["_id", "_text"], "left"), every)
    left = F.filter(_chunk_list(), lambda c: ~F.array_contains("_gone", c["chunk_no"]))
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda c: c["chunk"]), "\n"))
    return rows.withColumn("_kept", text).select(*[F.col("_kept").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])


def line_pairs(docs: DataFrame) -> DataFrame:
    """``(_id, _text, n, hash, check)`` of each two neighbouring lines: the number of the first (from 1), XXH64 and MD5."""
    rows = _keyed(docs.select("doc_id", "text")).where("text is not null").withColumn("_lines", F.split(F.col("text").cast("string"), "\n", -1))
    count = F.size("_lines") - 1
    both = F.zip_with(
        F.slice("_lines", 1, count), F.slice("_lines", 2, count), lambda a, b: F.struct(F.xxhash64(a, b).alias("hash"), F.unhex(F.md5(F.concat_ws("\n", a, b))).alias("check"))
    )
    return rows.select("_id", "_text", F.posexplode(both).alias("at", "p")).select("_id", "_text", (F.col("at") + 1).alias("n"), "p.hash", "p.check")


def repeated_lines(docs: DataFrame) -> DataFrame:
    """``(_id, _text, _gone)``: the numbers of the lines in runs of two or more that stand at an earlier place.

    Short hashes are counted first; the long ones are kept for those that occur twice alone. A pair that overlaps
    its own first occurrence loses only its second line: a run of equal lines keeps its first two.
    """
    found = line_pairs(docs)
    often = keep(found.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "hashes")
    candidates = keep(found.join(often, "hash").select("_id", "_text", "n", "check"), "candidates")
    first = F.min(F.struct("_id", "_text", "n")).alias("first")
    firsts = keep(candidates.groupBy("check").agg(first, F.count("*").alias("times")).where("times > 1").drop("times"), "firsts")
    later = candidates.join(firsts, "check").where(F.struct("_id", "_text", "n") > F.col("first"))
    overlaps = (F.col("_id") == F.col("first._id")) & (F.col("_text") == F.col("first._text")) & (F.col("n") == F.col("first.n") + 1)
    lines = later.select("_id", "_text", F.explode(F.when(overlaps, F.array(F.col("n") + 1)).otherwise(F.array("n", F.col("n") + 1))).alias("line"))
    return lines.groupBy("_id", "_text").agg(F.collect_set("line").alias("_gone"))


def remove_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with each run of two or more repeated lines cut from ``text``, all but its first place; all columns and rows stay."""
    gone = keep(repeated_lines(docs), "repeats")
    # One plan whatever the size: small lists would be sent to all, large ones not.
    rows = _keyed(docs).join(gone.hint("shuffle_merge"), ["_id", "_text"], "left")
    lines = F.split(F.col("text").cast("string"), "\n", -1)
    # array_except is a hash set, and the lines are a lambda's variable, split once: no square in a text's lines.
    left = F.array_except(F.sequence(F.lit(1), F.size(lines)), F.col("_gone"))
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(
        F.transform(F.array(lines), lambda own: F.array_join(F.transform(left, lambda n: F.element_at(own, n)), "\n"))[0]
    )
    return rows.withColumn("_kept", text).select(*[F.col("_kept").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])


ORACLE = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS n FROM documents),
hashed AS (SELECT *, CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) AS v FROM lines),
stops AS (SELECT *, (v * 31 + coalesce(lag(v) OVER (PARTITION BY doc_id ORDER BY n), 0)) % {EVERY} = 0 AS stop FROM hashed),
numbered AS (SELECT *, 1 + coalesce(sum(CASE WHEN stop THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk_no FROM stops),
chunks AS (SELECT doc_id, chunk_no, count(*) AS n_lines, string_agg(line, chr(10) ORDER BY n) AS chunk FROM numbered GROUP BY doc_id, chunk_no),
placed AS (SELECT *, row_number() OVER (PARTITION BY chunk, n_lines > 1 ORDER BY doc_id, chunk_no) AS place FROM chunks),
kept AS (SELECT doc_id, string_agg(chunk, chr(10) ORDER BY chunk_no) AS text FROM placed WHERE n_lines = 1 OR place = 1 GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text, d.lang, d.source, d.n_chars
FROM documents d LEFT JOIN kept k USING (doc_id)
"""
