"""Quality rules whose thresholds come from the corpus: quantile sketches per language and source, then a joined filter.

The sketch is a table of counts in log-linear buckets: exact below 32, and 16 buckets per power of two above, so a
quantile is off by at most a sixteenth. Sketches of the same measure merge by adding counts: the table per (language,
source) adds up to that per language and that of the corpus, which stand in where a group has few documents.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq
from string import ascii_uppercase

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from logweir.llm.common import WORDS_OF_TEXT, map_texts, stored, texts_of, with_row

SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\v\f\r"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
# A group with fewer documents takes the thresholds of its language, and that with fewer those of the corpus.
MIN_GROUP = 200
# Values farther than this many spreads outside the middle half are rejected.
SPREADS = 3


@dataclass(frozen=True)
class Rule:
    """A measure in whole numbers, its least spread, and the sides on which values can be out of line."""

    measure: Column
    least_spread: int
    low: bool
    high: bool


def _per(part: str, whole: str, scale: int) -> Column:
    return F.when(F.col(whole) > 0, F.floor(F.col(part) * scale / F.col(whole))).otherwise(0).cast("long")


def rules() -> dict[str, Rule]:
    return {
        "word_length": Rule(_per("word_chars", "n_words", 100), 60, True, True),
        "symbols": Rule(_per("n_symbols", "n_words", 1000), 40, False, True),
        "shouts": Rule(_per("n_shouts", "n_words", 1000), 40, False, True),
        "capitals": Rule(_per("n_capitals", "word_chars", 1000), 60, False, True),
        "dup_lines": Rule(_per("n_dup_lines", "n_lines", 1000), 120, False, True),
        "repeat_words": Rule(_per("n_repeat_words", "n_words", 1000), 60, False, True),
        "stutter": Rule(_per("n_stutters", "n_words", 1000), 40, False, True),
    }


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_shouts", "n_capitals", "n_stutters")


def repeated_words(words: list[str]) -> int:
    """Words in windows of WINDOW words that are found twice or more, overlapping or not, the first included."""
    if len(words) <= WINDOW:
        return 0
    numbers: dict[str, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    windows = ids[: 1 - WINDOW]
    for k in range(1, WINDOW):
        end = len(ids) + 1 - WINDOW + k
        windows = windows * len(numbers) + ids[k:end]
        if len(numbers) >= 1 << 12:  # renumbered, so that the next factor fits as well
            windows = np.unique(windows, return_inverse=True)[1]
    order = np.sort(windows)
    if not (order[1:] == order[:-1]).any():
        return 0
    _, which, often = np.unique(windows, return_inverse=True, return_counts=True)
    steps = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(often[which] > 1)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + WINDOW, -1)
    return int((np.cumsum(steps) > 0).sum())


def measure(text: str) -> tuple[int, ...]:
    """The MEASURES of a text.

    Words, code points in them, symbols, lines with a word that equal an earlier one, words in 5-word windows found
    twice or more (the first included), lines with a word, exclamation marks, capital letters A-Z, words
    equal to the one before.
    """
    words = WORDS_OF_TEXT(text)
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    return (len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words),
            len(lines), text.count("!"), sum(map(text.count, ascii_uppercase)), sum(map(eq, words, words[1:])))


def measured(docs: DataFrame, text: str) -> DataFrame:
    """The columns of ``docs`` but the text, and the MEASURES of each text; NULL as empty."""

    def work(part) -> dict:
        rows = [measure(x) for x in texts_of(part.column(text))]
        return dict(zip(MEASURES, zip(*rows))) if rows else {m: [] for m in MEASURES}

    keep = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text]
    return map_texts(docs, text, work, ", ".join([*keep, *(f"{m} long" for m in MEASURES)]))


def bucket(value: Column) -> Column:
    """The sketch's bucket of a value of 0 or more."""
    shift = F.length(F.bin(value)) - 5
    large = (shift + 1) * 16 + F.call_function("shiftright", value, F.greatest(shift, F.lit(0))).cast("int") - 16
    return F.when(value < 32, value.cast("int")).otherwise(large)


def least_of(number: Column) -> Column:
    """The smallest value in a bucket."""
    shift = F.greatest((number / 16).cast("int") - 1, F.lit(0))
    return F.when(number < 32, number.cast("long")).otherwise(F.call_function("shiftleft", (number % 16 + 16).cast("long"), shift))


def sketch(values: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by..., bucket, n): a mergeable quantile sketch per group."""
    return values.groupBy(*by, bucket(F.col(value)).alias("bucket")).agg(F.count("*").alias("n"))


def merged(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of smaller groups added up to those of larger ones."""
    return sketches.groupBy(*by, "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketches: DataFrame, by: list[str]) -> DataFrame:
    """(by..., size, q1, q3) per group; a group has at most about a thousand buckets."""
    upto = W.partitionBy(*by).orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
    total = W.partitionBy(*by)
    seen = sketches.select(*by, "bucket", F.sum("n").over(upto).alias("seen"), F.sum("n").over(total).alias("size"))

    def at(quarters: int) -> Column:
        return least_of(F.min(F.when(F.col("seen") * 4 >= F.col("size") * quarters, F.col("bucket"))))

    return seen.groupBy(*by).agg(F.max("size").alias("size"), at(1).alias("q1"), at(3).alias("q3"))


def thresholds(values: DataFrame) -> DataFrame:
    """(lang, source, low, high): maps from a rule's name to its bounds, for each language and source of ``values``."""
    made = rules()
    long = values.select("lang", "source", F.explode(F.map_from_arrays(
        F.array(*map(F.lit, made)), F.array(*[r.measure for r in made.values()]))).alias("rule", "value"))
    fine = stored(sketch(long, ["lang", "source", "rule"], "value"), "quality-sketch")
    own = quartiles(fine, ["lang", "source", "rule"]).alias("o")
    mid = quartiles(merged(fine, ["lang", "rule"]), ["lang", "rule"]).alias("m")
    every = quartiles(merged(fine, ["rule"]), ["rule"]).alias("a")
    joined = own.join(mid, (F.col("o.rule") == F.col("m.rule")) & F.col("o.lang").eqNullSafe(F.col("m.lang"))).join(
        every, F.col("o.rule") == F.col("a.rule"))

    def pick(q: str) -> Column:
        return F.when(F.col("o.size") >= MIN_GROUP, F.col(f"o.{q}")).when(F.col("m.size") >= MIN_GROUP, F.col(f"m.{q}")).otherwise(F.col(f"a.{q}"))

    least = F.create_map(*[F.lit(x) for n, r in made.items() for x in (n, r.least_spread)])[F.col("o.rule")]
    spread = SPREADS * F.greatest(pick("q3") - pick("q1"), least)
    bounds = joined.select(F.col("o.lang").alias("lang"), F.col("o.source").alias("source"), F.col("o.rule").alias("rule"),
                           (pick("q1") - spread).alias("low"), (pick("q3") + spread).alias("high"))
    return bounds.groupBy("lang", "source").agg(*[
        F.map_from_entries(F.collect_list(F.struct("rule", b))).alias(b) for b in ("low", "high")])


def judged(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per document: key, the MEASURES, base_failed, kept.

    base_failed: fewer than 10 words, or over 20 % of the words in repeated windows. The thresholds are learnt from the
    documents that pass; ``kept`` is that no measure lies outside those of the document's language and source. NULL
    languages and sources are groups like any other; a NULL text has no words and fails. Repeated rows count each, and
    other columns are not read.
    """
    values = measured(docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(source).alias("source")), "text")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    values = stored(values.withColumn("base_failed", failed), "quality-measures")
    bounds = stored(thresholds(values.where("NOT base_failed")).select(
        F.col("lang").alias("of_lang"), F.col("source").alias("of_source"), "low", "high"), "quality-thresholds")
    fine = ~F.col("base_failed")
    for name, rule in rules().items():
        if rule.low:
            fine &= rule.measure >= F.col("low")[name]
        if rule.high:
            fine &= rule.measure <= F.col("high")[name]
    joined = values.join(bounds, values["lang"].eqNullSafe(bounds["of_lang"]) & values["source"].eqNullSafe(bounds["of_source"]), "left")
    return joined.select("key", *MEASURES, "base_failed", F.coalesce(fine, F.lit(False)).alias("kept"))


def kept_documents(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that the rules keep, as they are. ``docs`` must be read from stored files."""
    numbered, row = with_row(docs)
    kept = stored(judged(numbered, row, text, lang, source).where("kept").select(F.col("key").alias("kept_row")), "quality-kept")
    # Merged at every size: what is kept grows with the corpus, and a join by size would change its plan.
    return numbered.join(kept.hint("merge"), numbered[row] == F.col("kept_row"), "left_semi").drop(row)
