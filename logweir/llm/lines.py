"""Line dedup by winnowing over line hashes; DataFrame functions only.

A *run* is a sequence of consecutive lines with words (lines without words are passed over), of ``min_words`` words or
more. A line is deleted if it lies in a run that occurs earlier, in an earlier document (by key, NULL last) or further
up in the same one.

How: from each line on, and back from it, the shortest run is a *window*; each window's smallest line hash (the
rightmost of equal ones) is its fingerprint. Equal runs hold equal windows and so equal fingerprints, whatever stands
around them: windows whose fingerprint occurs at one place only can't repeat and go. The rest are joined by their
content to the place where it occurs first. The windows that lead forward and back from a fingerprint extend a match to
both sides line by line: every line of a repeated run lies in one of them, so their union is the whole run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import WORD, free_name, stored, with_row

MIN_WORDS = 50


def _lines(text: Column) -> Column:
    """The lines with words: number, two hashes, words."""
    every = F.transform(F.split(text, "\n", -1), lambda x, i: F.struct(
        i.alias("no"), F.xxhash64(x).alias("h"), F.xxhash64(F.lit(1), x).alias("g"), F.regexp_count(x, F.lit(WORD)).alias("n")))
    return F.filter(every, lambda s: s["n"] > 0)


def _reach(lines: Column, min_words: int) -> Column:
    """How many of the lines it takes to have ``min_words`` words, and how many words these have."""
    start = F.struct(F.lit(0).alias("words"), F.lit(0).alias("lines"))
    return F.aggregate(lines, start, lambda got, x: F.when(got["words"] >= min_words, got).otherwise(
        F.struct((got["words"] + x["n"]).alias("words"), (got["lines"] + 1).alias("lines"))))


def _window(start: Column, count: Column) -> Column:
    """Content (two hashes) and fingerprint of a window."""
    part = F.slice(F.col("lines"), start + 1, count)
    low = F.array_min(F.transform(part, lambda x, i: F.struct(x["h"].alias("h"), (-(start + i)).alias("back"))))
    return F.struct(
        start.alias("start"), count.alias("count"),
        F.xxhash64(F.transform(part, lambda x: x["h"])).alias("w1"), F.xxhash64(F.lit(7), F.transform(part, lambda x: x["g"])).alias("w2"),
        low["h"].alias("mark"), (-low["back"]).alias("mark_at"), F.transform(part, lambda x: x["no"]).alias("nos"))


def _windows(rows: DataFrame, min_words: int) -> DataFrame:
    """One row per window of rows (row, key, lines): row, key, the window, and the numbers of its lines.

    Windows are made from slices inside the document's row, so what is exploded holds a window and not the document.
    """
    lines = F.col("lines")

    def around(x: Column, at: Column) -> Column:
        ahead = F.slice(lines, at + 1, min_words)
        behind = F.reverse(F.slice(lines, F.greatest(at + 2 - min_words, F.lit(1)), F.least(at + 1, F.lit(min_words))))
        return F.struct(at.alias("at"), x["n"].alias("n"), _reach(ahead, min_words).alias("on"), _reach(behind, min_words).alias("back"))

    def windows(r: Column) -> Column:
        forward = F.when(r["on"]["words"] >= min_words, _window(r["at"], r["on"]["lines"]))
        # Back from this line: the window that starts there leads here too, unless it is shorter.
        again = (r["back"]["words"] >= min_words) & (r["back"]["words"] - r["n"] >= min_words)
        return F.array_compact(F.array(forward, F.when(again, _window(r["at"] + 1 - r["back"]["lines"], r["back"]["lines"]))))

    reached = rows.select("row", "key", "lines", F.transform(lines, around).alias("reach"))
    found = reached.select("row", "key", F.explode(F.flatten(F.transform("reach", windows))).alias("w"))
    return found.select("row", "key", "w.*")


def repeated_lines(docs: DataFrame, row: str, key: str, text: str, min_words: int = MIN_WORDS) -> DataFrame:
    """(row, nos): for each row with lines to delete, their numbers, from 0."""
    if min_words < 1:
        raise ValueError("min_words must be 1 or more")
    rows = docs.select(F.col(row).alias("row"), F.col(key).alias("key"), _lines(F.col(text)).alias("lines"))
    windows = stored(_windows(rows, min_words), "line-windows")
    place = F.struct("row", "mark_at")
    marks = stored(windows.groupBy("mark").agg(F.min(place).alias("low"), F.max(place).alias("high"))
                   .where("low != high").select("mark"), "line-marks")
    candidates = windows.join(marks, "mark", "left_semi")
    where = F.struct(F.col("key").isNull().alias("last"), F.col("key").alias("key"), F.col("row").alias("row"), F.col("start").alias("start"))
    firsts = stored(candidates.groupBy("w1", "w2").agg(F.min(where).alias("first"), F.count("*").alias("places"))
                    .where("places > 1").select("w1", "w2", "first"), "line-firsts")
    later = windows.join(firsts, ["w1", "w2"]).where(where > F.col("first"))
    return later.select("row", F.explode("nos").alias("no")).groupBy("row").agg(F.collect_set("no").alias("nos"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> tuple[DataFrame, str, str]:
    """The documents with later repeated runs cut out of ``text``; and the names of two new columns: lines, deleted lines.

    ``docs`` must be read from stored files. NULL texts stay NULL and have 0 lines. Repeated rows: the first keeps its
    lines. A text that repeats itself keeps the first copy. Other columns are kept as they are.
    """
    numbered, row = with_row(docs)
    gone = repeated_lines(numbered, row, key, text, min_words)
    gone = stored(gone.select(F.col("row").alias("gone_row"), F.col("nos").alias("gone_nos")), "line-deletions")
    total, deleted = free_name(docs, "n_lines"), free_name(docs, "n_deleted")
    # Merged at every size: the texts with deletions grow with the corpus, and a join by size would change its plan.
    joined = numbered.alias("d").join(gone.hint("merge").alias("g"), F.col(f"d.`{row}`") == F.col("g.gone_row"), "left")
    own, every, nos = F.col(f"d.`{text}`"), free_name(docs, "every_line"), free_name(docs, "gone_lines")
    # Split before lines are picked: inside the picking the text would be split once per line.
    split = joined.select(*[F.col(f"d.`{c}`") for c in docs.columns], F.split(own, "\n", -1).alias(every), F.col("g.gone_nos").alias(nos))
    every, nos, own = F.col(every), F.col(nos), F.col(f"`{text}`")
    count = F.when(own.isNull(), 0).otherwise(F.size(every))
    keep = F.array_except(F.sequence(F.lit(0), F.size(every) - 1), nos)
    cut = F.array_join(F.transform(keep, lambda i: F.get(every, i)), "\n")
    new = F.when(nos.isNull(), own).otherwise(cut)
    columns = [new.alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns]
    return split.select(*columns, count.alias(total), F.coalesce(F.size(nos), F.lit(0)).alias(deleted)), total, deleted
