"""Removal of repeated lines by overlapping windows of three consecutive lines.

Every three consecutive lines of a document form a window, known by 128 bits of hash over
the three lines. Of windows that occur more than once in the corpus, the first occurrence
(smallest ``doc_id``, then smallest line number) stays; each later one marks its lines, and
marked lines go. Overlapping windows merge, as a line is marked once, so a longer repeated
passage goes as a whole. A later occurrence that overlaps the first one in the same
document leaves the lines of the first.

Windows are counted with partial sums in each task, so a window that a third of all
documents share is a few rows where it is dealt out, and only documents with marked lines
are put together anew.

Defined cases: lines end at ``\\n``; documents of fewer than three lines, and null or empty
texts, have no window and stay as they are; a document whose lines all go has an empty
text; null ``doc_id`` come last in the order; rows equal in ``doc_id`` and text are one
document and fare alike; those equal in ``doc_id`` only are ordered by a hash of the text;
columns other than ``text`` and ``n_chars`` are returned unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import free_name, with_value
from ridelake.session import stage

WINDOW = 3


def _lines(text):
    return F.split(text, "\n", -1)


def _keys(docs: DataFrame):
    """Columns that stand for a row: its id and 128 bits of its text."""
    doc_id, text = F.col("doc_id").cast("long"), F.col("text")
    return doc_id, F.xxhash64(doc_id.isNull(), doc_id, text), F.xxhash64(F.lit("row"), doc_id, F.length(text), text)


def windows(docs: DataFrame) -> DataFrame:
    """(late, doc_id, ka, kb, at, ha, hb): each window, with its place and its hash."""
    doc_id, ka, kb = _keys(docs)
    rows = docs.select(doc_id.alias("doc_id"), ka.alias("ka"), kb.alias("kb"), _lines(F.col("text")).alias("lines"))
    # Referred to several times below, the lines stay a column of their own: they are cut once.
    rows = rows.where(F.size("lines") >= WINDOW)

    def of(i):
        three = [F.get("lines", i + k) for k in range(WINDOW)]
        return F.struct(F.xxhash64(F.lit(1), *three).alias("a"), F.xxhash64(F.lit(2), *three).alias("b"))

    found = F.transform(F.sequence(F.lit(0), F.size("lines") - WINDOW), of)
    rows = rows.select("doc_id", "ka", "kb", F.posexplode(found).alias("at", "h"))
    return rows.select(F.col("doc_id").isNull().alias("late"), "doc_id", "ka", "kb", "at", F.col("h.a").alias("ha"), F.col("h.b").alias("hb"))


def marked_lines(docs: DataFrame) -> DataFrame:
    """(ka, kb, gone array<int>): for each document the numbers of the lines that go."""
    found = stage(windows(docs), "windows")
    place = F.struct("late", "doc_id", "ka", "kb", "at")
    repeated = found.groupBy("ha", "hb").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).where("n > 1")
    repeated = stage(repeated.select("ha", "hb", "first"), "repeated")
    later = found.join(repeated, ["ha", "hb"]).where(~place.eqNullSafe(F.col("first")))
    same = (F.col("ka") == F.col("first.ka")) & (F.col("kb") == F.col("first.kb"))
    begin = F.when(same, F.greatest("at", F.col("first.at") + WINDOW)).otherwise(F.col("at"))
    later = later.select("ka", "kb", begin.alias("begin"), (F.col("at") + WINDOW - 1).alias("end")).where("begin <= end")
    lines = later.select("ka", "kb", F.explode(F.sequence("begin", "end")).alias("line"))
    return lines.groupBy("ka", "kb").agg(F.collect_set("line").alias("gone"))


def remove_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` without the lines of later occurrences; ``n_chars``, if there, is counted anew."""
    names = {n: free_name(docs, n) for n in ("ka", "kb", "gone")}
    _, ka, kb = _keys(docs)
    keyed = docs.withColumns({names["ka"]: ka, names["kb"]: kb})
    gone = marked_lines(docs).withColumnsRenamed(names)
    joined = keyed.join(gone, [names["ka"], names["kb"]], "left")
    gone = F.col(names["gone"])

    def left(lines):
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")

    text = F.when(gone.isNull(), F.col("text")).otherwise(with_value(_lines(F.col("text")), left))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        counted = F.when(gone.isNull(), F.col("n_chars")).otherwise(F.length(text))
        changed["n_chars"] = counted.cast(docs.schema["n_chars"].dataType)
    return joined.select(*(changed.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns))
