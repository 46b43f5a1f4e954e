"""Line deduplication by a deletion-neighbourhood join over words; built-in functions only.

Two lines are alike if at most one word is inserted, deleted or replaced.  Of alike lines
the earliest, by (doc_id, line number), stays: an occurrence goes if the same line, or a
line one edit away, occurs earlier.

1. Every line of ``MIN_WORDS`` words or more gets three keys: hashes of its halves (which
   together identify it) and one more, chosen so that lines one edit apart share a key.
   Lines whose keys no other line shares have no neighbour and go no further.
2. Each remaining distinct line emits its deletion variants, as hashed keys tagged with the
   deleted position, and itself.  Equal variants at one position are a replacement; a
   variant equal to a whole line is an insertion.  Within such a group all lines are
   neighbours, so the earliest decides for all: groups are joined with their minimum, and no
   pairs are written.
3. The edit is verified on the words themselves.

Scale: all minima are partially aggregated before their shuffle, and all joins are plain
equi-joins whose hot keys AQE can split, so a line found in a third of all documents
gathers nowhere.  Variant hashes are sums of position-tagged word hashes, so a line of n
words costs n, not n * n.

Defined cases: null and empty texts have no lines; shorter lines are never removed; a null
doc_id sorts first; rows that share a doc_id are one document, whose equal lines at one
place count once; ties cannot occur otherwise; an empty table stays empty; other columns
pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.textops import OTHER_SPACES, let, whole, words
from eventide.session import materialize

MIN_WORDS = 5


def _cut(text):
    """The lines of a text as arrays of words; separators other than line feeds are replaced in the whole text first."""
    text = whole(text)
    for c in OTHER_SPACES.replace("\n", ""):
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.transform(F.split(text, "\n", -1), lambda s: F.array_remove(F.split(s, " ", -1), ""))


def _head(line, k):
    return F.xxhash64(F.lit(0), k, F.slice(line, F.lit(1), k))


def _tail(line, k):
    return F.xxhash64(F.lit(1), k, F.slice(line, F.size(line) - k + 1, k))


def identity(line):
    """Two hashes that cover all words of a line: one of each half."""
    return F.struct(_head(line, F.floor(F.size(line) / 2).cast("int")).alias("a"),
                    _tail(line, F.ceil(F.size(line) / 2).cast("int")).alias("b"))


def third_key(line):
    """With the halves of ``identity``, the key that lets a line meet one a word shorter."""
    n = F.size(line)
    return F.when(n % 2 == 0, _head(line, (n / 2 - 1).cast("int"))).otherwise(_tail(line, ((n - 1) / 2).cast("int")))


def _word_hash(word: str, at):
    # 40 bits: sums over a line of up to 2**23 words stay inside a long.
    return F.shiftright(F.xxhash64(F.col(word), at), 24)


def near_lines(firsts: DataFrame) -> DataFrame:
    """(line) identities that have an earlier neighbour, from distinct lines' (line, first, words)."""
    row = Window.partitionBy("line").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    full = Window.partitionBy("line")
    w = firsts.select("line", "first", F.posexplode("words").alias("at", "word"))
    here, shifted = _word_hash("word", F.col("at")), _word_hash("word", F.col("at") - 1)
    w = w.select("line", "first", "at", F.count("at").over(full).alias("n"), F.sum(here).over(full).alias("whole"), (
        F.sum(here).over(row) - here + F.sum(shifted).over(full) - F.sum(shifted).over(row)).alias("variant"))
    w = materialize(w)
    mine = F.struct("first", "line", "at")
    replaced = w.groupBy(F.col("n").alias("m"), F.col("variant").alias("v"), F.col("at").alias("p")).agg(
        F.min(mine).alias("head"), F.max("line").alias("top"), F.min("line").alias("low")).where("top != low")
    subs = w.join(replaced, (F.col("n") == F.col("m")) & (F.col("variant") == F.col("v")) & (F.col("at") == F.col("p")))
    subs = subs.where(F.col("first") > F.col("head.first")).select(
        "line", "at", F.col("head.line").alias("other"), F.lit("replace").alias("how"))
    wholes = w.where("at = 0").groupBy(F.col("n").alias("m"), F.col("whole").alias("v")).agg(
        F.min(mine).alias("head"))
    longer = w.groupBy((F.col("n") - 1).alias("m"), F.col("variant").alias("v")).agg(F.min(mine).alias("head"))
    shrunk = w.join(wholes, (F.col("n") - 1 == F.col("m")) & (F.col("variant") == F.col("v"))).where(
        F.col("first") > F.col("head.first")).select(
            "line", "at", F.col("head.line").alias("other"), F.lit("delete").alias("how"))
    grown = w.where("at = 0").join(longer, (F.col("n") == F.col("m")) & (F.col("whole") == F.col("v"))).where(
        F.col("first") > F.col("head.first")).select(
            "line", F.col("head.at").alias("at"), F.col("head.line").alias("other"), F.lit("insert").alias("how"))
    found = subs.unionByName(shrunk).unionByName(grown)
    text = firsts.select("line", "words")
    pairs = found.join(text, "line").join(
        text.select(F.col("line").alias("other"), F.col("words").alias("others")), "other")
    cut = lambda c: F.concat(F.slice(c, F.lit(1), F.col("at")), F.slice(c, F.col("at") + 2, F.size(c)))
    same = F.when(F.col("how") == "replace", cut("words") == cut("others")).when(
        F.col("how") == "delete", cut("words") == F.col("others")).otherwise(F.col("words") == cut("others"))
    return pairs.where(same).select("line").distinct()


def removed_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, no, line) of the occurrences that go."""
    lines = docs.select(F.col(doc_id).alias("doc_id"), F.posexplode(_cut(text)).alias("no", "words"))
    lines = lines.where(F.size("words") >= min_words)
    seen = materialize(lines.select("doc_id", "no", identity("words").alias("line"), third_key("words").alias("third")))
    firsts = materialize(seen.groupBy("line").agg(F.min(F.struct("doc_id", "no")).alias("first"), F.first(
        "third").alias("third"), F.count("no").alias("times")))
    keys = firsts.select("line", "first", F.explode(F.array("line.a", "line.b", "third")).alias("key"))
    shared = keys.groupBy("key").agg(F.count("line").alias("k")).where("k > 1").select("key")
    near = keys.join(shared, "key").select("line", "first").distinct()
    # Their words, from the documents they occur in first; each is cut into lines once.
    place = near.groupBy(F.col("first.doc_id").alias("_d")).agg(F.collect_list(F.struct("line", "first")).alias("_lines"))
    body = docs.select(F.col(doc_id).alias("_doc"), whole(text).alias("_text"))
    held = place.join(body, F.col("_d").eqNullSafe(F.col("_doc"))).select(F.explode(let(F.split("_text", "\n", -1), lambda cut: F.transform(
        "_lines", lambda x: F.struct(x["line"].alias("line"), x["first"].alias("first"), F.get(cut, x["first"]["no"]).alias("text"))))).alias("x"))
    held = held.select("x.line", "x.first", words(F.col("x.text")).alias("words"))
    held = materialize(held.where(identity("words") == F.col("line")).dropDuplicates(["line"]))
    gone = near_lines(held).withColumn("near", F.lit(True))
    # Only lines that occur again or have an earlier neighbour can go; on its own, this join's hot lines can be split.
    marks = materialize(firsts.select("line", "first", "times").join(gone, "line", "left").where(
        "near or times > 1").select(F.col("line").alias("_line"), "first", F.coalesce("near", F.lit(False)).alias("near")))
    found = seen.select("doc_id", "no", "line").join(marks, F.col("line") == F.col("_line"))
    return found.where(F.col("near") | (F.struct("doc_id", "no") != F.col("first"))).select("doc_id", "no", "line")


def removed_per_document(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                         min_words: int = MIN_WORDS) -> DataFrame:
    """(_id, _gone, _numbers): each document's removed lines as marks, and their sorted numbers from 0."""
    return removed_lines(docs, doc_id, text, min_words).groupBy(F.col("doc_id").alias("_id")).agg(
        F.collect_set(mark(F.col("no"), F.col("line"))).alias("_gone"),
        F.sort_array(F.collect_set("no")).alias("_numbers"))


def mark(no, line):
    """A line of a document as one string: number and identity.  Sets of strings are hashed, sets of structs are not."""
    return F.concat_ws(":", no.cast("string"), line.a.cast("string"), line.b.cast("string"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                min_words: int = MIN_WORDS) -> DataFrame:
    """The documents without their removed lines; every other column unchanged."""
    gone = removed_per_document(docs, doc_id, text, min_words)
    # The row travels as one struct, so its columns may have any names.
    rows = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("_doc"))
    body = F.col("row").getField(text)
    all_marks = F.transform(_cut(body), lambda line, i: mark(i, identity(line)))
    kept = F.transform(F.array_except(all_marks, "_gone"), lambda m: F.get(
        F.split(body, "\n", -1), F.substring_index(m, ":", 1).cast("int")))
    left = F.when(F.col("_gone").isNull(), body).otherwise(F.array_join(kept, "\n"))
    return rows.join(gone, F.col("_doc").eqNullSafe(F.col("_id")), "left").select(
        *[left.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns])
