"""Quality rules by cross-document line frequency, in DataFrame expressions alone.

Normalised lines are hashed; a line that too many distinct documents of a host hold is boilerplate.
Such lines are removed, and a document of which little is left is rejected.  A ``source`` is a host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailmarts.llm.common import SPACES, Scratch, bound

#: A line is boilerplate if more than so many distinct documents of the host hold it, and more than this
#: share of them.  Copies of one text count once: they are a matter of deduplication.
LEAST_DOCS = 10
LEAST_SHARE = 0.01
#: A document is depleted if less than this share of its words is left.
LEFT = 0.3
#: The base rules: words at least, and per cent of words in repeated windows at most.
LEAST_WORDS = 50
MOST_REPEATED = 50
SYMBOLS = "#*$%&|<>"


def _words(text: str) -> Column:
    return F.array_remove(F.split(F.translate(text, SPACES, " " * len(SPACES)), " "), "")


def _repeated(words: Column) -> Column:
    """Words that lie in a three-word window which occurs twice or more; all its places count.

    Windows are compared by 64-bit hash.  Most texts repeat none, which a set of hashes shows; the others
    are sorted by hash and place, so that equal windows are neighbours."""

    def windows(w: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(w) - 3)
        return F.transform(places, lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))

    def places(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeats(s: Column) -> Column:
            same = F.filter(s, lambda x, k: (
                ((k > 0) & (F.get(s, k - 1)["h"] == x["h"])) | (F.get(s, k + 1)["h"] == x["h"])
            ))
            covered = F.flatten(F.transform(same, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
            return F.size(F.array_distinct(covered))

        return bound(placed, repeats)

    def count(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(places(hashes))

    return F.when(F.size(words) < 4, 0).otherwise(bound(windows(words), count))


def _normal(line: Column) -> Column:
    """Lower case, digits alike, without white space and ASCII punctuation."""
    dropped = SPACES + "!\"'(),-.:;?_`"
    return F.translate(F.lower(line), "123456789" + dropped, "000000000")


def measures(docs: DataFrame) -> DataFrame:
    """Base figures of each row and its lines that hold a word, as (hash, words), in order."""
    text = docs.withColumn("_text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    text = text.withColumns({"_words": _words("_text"), "_split": F.split("_text", "\n")})
    lines = F.filter("_split", lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    return text.withColumn("_lines", lines).select(
        "doc_id", "source",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.translate("_text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _repeated(F.col("_words")).cast("long").alias("n_repeat_words"),
        F.xxhash64("_text").alias("text_hash"),
        F.transform("_lines", lambda x: F.struct(
            F.xxhash64(_normal(x)).alias("line"), F.size(_words(x)).alias("words")
        )).alias("lines"),
    )


def boilerplate(measured: DataFrame) -> DataFrame:
    """(source, line, docs) of the lines above the limits.  Distinct documents are counted in two steps:
    each task first drops repeated (source, line, text), so a common line costs a row per task."""
    docs = measured.groupBy("source").agg(F.countDistinct("text_hash").alias("host_docs"))
    held = measured.select("source", "text_hash", F.explode("lines.line").alias("line")).distinct()
    counts = held.groupBy("source", "line").agg(F.count("*").alias("docs")).where(F.col("docs") > LEAST_DOCS)
    hosts = docs.withColumnRenamed("source", "host")
    return (
        counts.join(hosts, F.col("source").eqNullSafe(F.col("host")))
        .where(F.col("docs") > F.col("host_docs") * LEAST_SHARE)
        .select("source", "line", "docs")
    )


def judge(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per row of ``docs``: base figures, base_failed, kept, n_boilerplate_words, and
    ``boilerplate``, the hashes of the removed lines.

    A null or blank text has no words and fails the base rules; a null source is a host of its own; equal
    rows get equal verdicts; ties at a limit stay below it; an empty table stays empty.  Other columns of
    ``docs`` are ignored, so their names cannot clash.
    """
    measured = scratch.save(
        measures(docs).withColumn("row", F.monotonically_increasing_id())  # fixed by the saved table
    )
    common = scratch.save(boilerplate(measured)).select(
        F.col("source").alias("host"), F.col("line").alias("common")
    )
    found = (
        measured.select("row", "source", F.explode("lines").alias("at")).select("row", "source", "at.*")
        .join(common, F.col("source").eqNullSafe(F.col("host")) & (F.col("line") == F.col("common")))
        .groupBy("row").agg(
            F.sum("words").cast("long").alias("n_boilerplate_words"), F.collect_set("line").alias("boilerplate")
        )
    )
    base_failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    removed = F.coalesce("n_boilerplate_words", F.lit(0).cast("long"))
    depleted = F.col("n_words") - removed < LEFT * F.col("n_words")
    return measured.join(found, "row", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), (~base_failed & ~depleted).alias("kept"),
        removed.alias("n_boilerplate_words"),
        F.coalesce("boilerplate", F.array().cast("array<bigint>")).alias("boilerplate"),
    )


def without_lines(text: Column, boilerplate: Column) -> Column:
    """A text without the lines whose hashes are given, other lines unchanged."""
    rest = F.filter(F.split(text, "\n"), lambda x: ~F.array_contains(boilerplate, F.xxhash64(_normal(x))))
    return F.array_join(rest, "\n")


#: The same in SQL.  The normal form drops the same characters; windows are compared as text.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT row, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT row, words, unnest(range(1, len(words) - 1)) AS i FROM d)),
repeats AS (
  SELECT row, count(DISTINCT place) AS n FROM (
    SELECT row, unnest([i, i + 1, i + 2]) AS place
    FROM (SELECT row, i, count(*) OVER (PARTITION BY row, w) AS times FROM windows) WHERE times > 1)
  GROUP BY row),
held AS (
  SELECT row, source, text, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS words,
    regexp_replace(regexp_replace(lower(l), '[1-9]', '0', 'g'), '[\x20\x09-\x0D!"''(),.:;?_`-]', '', 'g') AS line
  FROM (SELECT row, source, text, unnest(lines) AS l FROM d)),
hosts AS (SELECT source, count(DISTINCT text) AS docs FROM d GROUP BY source),
common AS (
  SELECT held.source, line FROM held JOIN hosts ON held.source IS NOT DISTINCT FROM hosts.source
  GROUP BY held.source, line, docs
  HAVING count(DISTINCT text) > 10 AND count(DISTINCT text) > 0.01 * docs),
found AS (
  SELECT row, sum(words) AS n FROM held JOIN common
    ON held.source IS NOT DISTINCT FROM common.source AND held.line = common.line GROUP BY row),
figures AS (
  SELECT doc_id, len(words) AS n_words, len(array_to_string(words, '')) AS word_chars,
    len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words,
    CAST(coalesce(found.n, 0) AS BIGINT) AS n_boilerplate_words
  FROM d LEFT JOIN repeats USING (row) LEFT JOIN found USING (row))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND n_words - n_boilerplate_words >= 0.3 * n_words AS kept
FROM figures
"""
