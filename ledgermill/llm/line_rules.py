"""Quality rules: per-text counts, and lines that many documents of a host share. DataFrame functions only.

Lines are normalised (lower case, digits as 0, white space collapsed) and hashed. A line is common in its host where more
than ``max_share`` of the host's distinct texts have it, or more than ``max_docs``, and at least ``min_docs``; exact copies count
once. Common lines are removed, and a document is rejected when less than ``min_left`` of its words are left, or by the rules per text.

The texts are cut into lines once; their hashes and numbers of words are staged. Two passes over these find the common lines.
The first counts rows per (host, line), which pre-aggregates before its shuffle and can only be too high; the second counts
distinct texts for the lines that pass. They meet the lines of the texts by a join on (host, line), so a row holds only those
of its own text, however many a host has. The counts of a text are made where it is read, and the words in its common lines
are summed from the staged lines: texts themselves are shuffled only for a caller who wants them without these lines.
``max_docs`` does not grow with the host; None leaves the share alone.

Defined results: a null text has no words and fails; a null host is a host of its own; documents without lines above the
limit lose nothing; repeated rows give a row each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import stage

SPACE = "[\\x20\\x09-\\x0D]"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row, whatever the optimizer makes of the projection."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, f"{SPACE}+"), "")


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that the text has twice or more."""

    def covered(windows: Column) -> Column:
        placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def flagged(rows: Column) -> Column:
            twin = lambda x, k: F.get(rows, k - 1)["h"].eqNullSafe(x["h"]) | F.get(rows, k + 1)["h"].eqNullSafe(x["h"])
            starts = F.transform(F.filter(rows, twin), lambda x: x["i"])
            return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda p: F.array(p, p + 1, p + 2)))))

        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(let(placed, flagged))

    def counted(w: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        )
        return F.when(F.size(w) < 3, 0).otherwise(let(windows, covered))

    return let(words, counted)


def lines_of(text: Column) -> Column:
    """Lines with a word."""
    return F.filter(F.split(text, "\n"), lambda x: F.length(without(x, SPACES)) > 0)


def line_hash(line: Column) -> Column:
    plain = F.translate(F.lower(line), "123456789", "000000000")
    return F.xxhash64(F.trim(F.regexp_replace(plain, f"{SPACE}+", " ")))


def text_lines(rows: DataFrame) -> DataFrame:
    """host, text_key, place, line (hash) and words of every line with a word. ``rows``: host, text, text_key."""
    found = F.transform(lines_of(F.col("text")), lambda x: F.struct(line_hash(x).alias("line"), F.size(words_of(x)).alias("words")))
    return rows.select("host", "text_key", F.posexplode(found).alias("place", "found")).select(
        "host", "text_key", "place", "found.line", "found.words"
    )


def common_lines(rows: DataFrame, lines: DataFrame, min_docs: int, max_share: float, max_docs: int | None = None) -> DataFrame:
    """host, line of the lines over the limit. ``rows``: host, text_key; ``lines``: their ``text_lines``."""
    texts = rows.groupBy("host", "text_key").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("*").alias("texts"))
    limit = F.col("texts") * max_share
    if max_docs is not None:
        limit = F.least(limit, F.lit(max_docs))
    limits = stage(texts.select("host", F.greatest(F.lit(min_docs - 1), limit).alias("limit")), "host-limits")
    often = lines.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs)
    suspects = stage(often.join(limits, "host").where(F.col("n") > F.col("limit")).select("host", "line", "limit"), "suspects")
    seen = lines.join(suspects, ["host", "line"]).groupBy("host", "line").agg(
        F.countDistinct("text_key").alias("n"), F.first("limit").alias("limit")
    )
    return seen.where(F.col("n") > F.col("limit")).select("host", "line")


def cleaned(
    docs: DataFrame, min_docs: int = 5, max_share: float = 0.05, min_left: float = 0.5, max_docs: int | None = 100
) -> DataFrame:
    """doc_id, host, text without its common lines, the counts, base_failed and kept. The host is the column source."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("host"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.withColumn("text_key", F.xxhash64("text", F.lit(1)))
    lines = stage(text_lines(rows), "text-lines")
    common = lines.join(stage(common_lines(rows, lines, min_docs, max_share, max_docs), "common-lines"), ["host", "line"])
    # The rows of equal texts have the same lines in the same places.
    placed = common.groupBy("host", "text_key", "place").agg(F.first("line").alias("line"), F.first("words").alias("words"))
    gone = placed.groupBy("host", "text_key").agg(F.collect_set("line").alias("common"), F.sum("words").alias("gone"))
    text, words = F.col("text"), words_of(F.col("text"))
    visible = lines_of(text)
    blank = lambda x: F.length(without(x, SPACES)) == 0
    left = F.array_join(F.filter(F.split(text, "\n"), lambda x: blank(x) | ~F.array_contains(F.col("common"), line_hash(x))), "\n")
    counted = rows.select(
        "doc_id", "host", "text", "text_key",
        F.size(words).cast("long").alias("n_words"),
        F.length(without(text, SPACES)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        let(visible, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(words).cast("long").alias("n_repeat_words"),
    )
    met = counted.join(stage(gone, "common-of-texts"), ["host", "text_key"], "left").select(
        "doc_id", "host", F.when(F.col("common").isNull(), text).otherwise(left).alias("text"),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.coalesce(F.col("gone"), F.lit(0)).cast("long").alias("n_removed_words"),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    depleted = F.col("n_words") - F.col("n_removed_words") < min_left * F.col("n_words")
    return met.withColumns({"base_failed": failed, "kept": ~failed & ~depleted})


def quality(docs: DataFrame, **limits) -> DataFrame:
    """The counts per text, base_failed, n_removed_words (in common lines) and kept, from ``cleaned``."""
    return cleaned(docs, **limits).drop("host", "text")


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
win AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) > 2),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS n FROM win),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice WHERE n > 1)
        GROUP BY doc_id),
ln AS (SELECT doc_id, host, md5(text) AS t, unnest(string_split(text, chr(10))) AS line FROM d),
lw AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS k,
       trim(regexp_replace(translate(lower(line), '123456789', '000000000'), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
       FROM ln WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lw GROUP BY doc_id),
hosts AS (SELECT host, count(DISTINCT md5(text)) AS texts FROM d GROUP BY host),
common AS (SELECT lw.host, norm FROM lw JOIN hosts USING (host) GROUP BY lw.host, norm, texts
           HAVING count(DISTINCT t) >= 5 AND count(DISTINCT t) > least(texts * 0.05, 100)),
gone AS (SELECT doc_id, sum(k) AS n FROM lw SEMI JOIN common USING (host, norm) GROUP BY doc_id),
r AS (SELECT d.doc_id, len(ws) AS n_words,
      length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
      length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
      coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
      CAST(coalesce(gone.n, 0) AS BIGINT) AS n_removed_words
      FROM d JOIN w USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - n_removed_words >= 0.5 * n_words AS kept
FROM r
"""
