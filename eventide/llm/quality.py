"""Quality rules: per-document counts, and cross-document line frequency within a host.

Every line of every document is normalised (lower case, digits as 0, trimmed) and
hashed; the distinct documents of each (host, line) are counted; lines found in more
than ``max_docs`` documents of their host are removed, and a document that loses more
than ``max_removed`` of its words to them is rejected as depleted.

Everything is built-in functions.  Counts are partially aggregated before the shuffle,
so a line shared by a third of all documents costs a row per task there; the join that
brings the frequent lines back is a plain equi-join whose hot keys AQE can split.

Defined cases: a null or empty text has no words and fails the base rules; a null host
is a host of its own; lines without a word are ignored; rows that share a doc_id are one
document for the line counts and share its removed words, and each row is returned; an
empty table gives an empty result; columns other than the three named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.textops import WORD, let, spaced_parts, whole

SYMBOLS = "[#*$%&|<>]"
WINDOW_WORDS = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_DOCS = 30
MAX_REMOVED = 0.5


def repeat_words(hashes: str, windows: str, size: int = WINDOW_WORDS) -> Column:
    """Words covered by windows whose hash occurs twice or more in the array column ``windows``.

    Only documents that have such a window sort their (hash, position) pairs; equal
    hashes are then neighbours, so the work is n log n however repetitive the text is.
    """
    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def covered(s: Column) -> Column:
        twice = F.filter(s, lambda x, k: F.coalesce(x.h == F.get(s, k - 1).h, F.lit(False))
                         | F.coalesce(x.h == F.get(s, k + 1).h, F.lit(False)))
        at = F.sort_array(F.transform(twice, lambda x: x.i))
        return F.aggregate(
            at, F.struct(F.lit(0).alias("n"), F.lit(-size).alias("last")),
            lambda acc, i: F.struct((acc.n + F.least(F.lit(size), i - acc.last)).alias("n"), i.alias("last")),
            lambda acc: acc.n)

    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), let(pairs, covered)).otherwise(F.lit(0))


def with_base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    d = docs.withColumn("_t", whole(text)).withColumn("_parts", spaced_parts(F.col("_t")))
    d = d.withColumn("_w", F.array_remove("_parts", ""))
    d = d.withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w)))
    starts = F.size("_h") - F.lit(WINDOW_WORDS - 1)
    d = d.withColumn("_win", F.when(starts > 0, F.transform(
        F.sequence(F.lit(1), F.greatest(starts, F.lit(1))),
        lambda i: F.xxhash64(F.slice("_h", i, F.lit(WINDOW_WORDS))))).otherwise(
            F.array().cast("array<bigint>")))
    d = d.withColumn("_lines", F.filter(F.split("_t", "\n", -1), lambda s: s.rlike(WORD)))
    d = d.select(
        *docs.columns,
        F.size("_w").cast("long").alias("n_words"),
        (F.length("_t") - F.size("_parts") + 1).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeat_words("_h", "_win").cast("long").alias("n_repeat_words"))
    return d.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def document_lines(docs: DataFrame, doc_id: str = "doc_id", host: str = "host", text: str = "text") -> DataFrame:
    """One row (doc_id, host, line, n) for each line that has a word: its hash and its words."""
    normal = F.regexp_replace(F.lower(whole(text)), "[0-9]", "0")
    lines = F.filter(F.split(normal, "\n", -1), lambda s: s.rlike(WORD))
    entries = F.transform(lines, lambda s: F.struct(
        F.xxhash64(F.btrim(s, F.lit(" \t\x0b\x0c\r"))).alias("line"),
        F.size(F.array_remove(spaced_parts(s), "")).alias("n")))
    return docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.concat(F.lit("="), F.col(host)), F.lit("")).alias(
        "host"), F.explode(entries).alias("e")).select("doc_id", "host", "e.line", "e.n")


def removed_words(docs: DataFrame, doc_id: str = "doc_id", host: str = "host", text: str = "text",
                  max_docs: int = MAX_DOCS) -> DataFrame:
    """(doc_id, n_line_words, n_removed) of the documents that hold a line above the limit."""
    lines = document_lines(docs, doc_id, host, text)
    often = (lines.groupBy("host", "line").agg(F.countDistinct("doc_id").alias("n_docs"))
             .where(F.col("n_docs") > max_docs).select("host", "line"))
    return lines.join(often, ["host", "line"]).groupBy("doc_id").agg(F.sum("n").alias("n_removed"))


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", host: str = "host", text: str = "text",
                  max_docs: int = MAX_DOCS, max_removed: float = MAX_REMOVED) -> DataFrame:
    """The documents' id, base counts, ``n_removed`` words in lines above the limit, and ``kept``."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(host).alias("host"), F.col(text).alias("text"))
    base = with_base_counts(own).drop("host", "text")
    gone = removed_words(own, max_docs=max_docs).withColumnRenamed("doc_id", "_id")
    total = base.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    lost = F.coalesce("n_removed", F.lit(0))
    return total.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (lost <= max_removed * F.col("n_words"))).alias("kept"),
        lost.cast("long").alias("n_removed"))


def remove_frequent_lines(docs: DataFrame, doc_id: str = "doc_id", host: str = "host", text: str = "text",
                          max_docs: int = MAX_DOCS) -> DataFrame:
    """The documents with their lines above the limit taken out of the text; other columns unchanged.

    Each document joins with the array of its own frequent lines' hashes, so no group
    is larger than a document.
    """
    lines = document_lines(docs, doc_id, host, text)
    often = (lines.groupBy("host", "line").agg(F.countDistinct("doc_id").alias("n_docs"))
             .where(F.col("n_docs") > max_docs).select("host", "line"))
    own = (lines.join(often, ["host", "line"]).groupBy("doc_id").agg(F.collect_set("line").alias("_often"))
           .withColumnRenamed("doc_id", "_id"))
    key = lambda s: F.xxhash64(F.btrim(F.regexp_replace(F.lower(s), "[0-9]", "0"), F.lit(" \t\x0b\x0c\r")))
    # The row travels as one struct, so its columns may have any names.
    rows = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("_doc"))
    body = F.col("row").getField(text)
    kept = F.array_join(F.filter(F.split(body, "\n", -1), lambda s: ~F.array_contains("_often", key(s))), "\n")
    left = F.when(F.col("_often").isNull(), body).otherwise(kept)
    return rows.join(own, F.col("_doc").eqNullSafe(F.col("_id")), "left").select(
        *[left.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns])
