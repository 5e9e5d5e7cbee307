"""Mixing sources to target weights: hash-random order within each source, distributed prefix sums, a cut at the budget."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from logweir.llm.common import copies_numbered, free_name, n_words, stored, with_row

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
# Documents of a source are dealt by their random key into ranges of about this many rows, each summed in one task.
RANGE_ROWS = 1000


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, source_rows, target) per source of ``sizes`` (source, size).

    The sources, by code point and NULL last, weigh ``weights`` in turn and share ``share`` times the size of all. A
    target stops at ``most`` times its source's size; the excess is shared again by weight among the others until none
    is above. One row per source is ordered in one task; the driver sees three numbers a round.
    """
    each = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
    order = W.orderBy(F.col("source").isNull(), "source")
    turn = (F.row_number().over(order) - 1) % len(weights) + 1
    each = stored(each.select("source", "source_size", "source_rows", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn).alias("weight")), "mix-sources")
    cap = most * F.col("source_size")
    total = each.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, 0
    while total:
        above = cap <= level * F.col("weight")
        fixed, weight, count = each.agg(
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)), F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)), F.count_if(above)).first()
        if weight == 0 or (level and count == full):
            break
        level, full = (share * total - fixed) / weight, count
    return each.select("source", "source_size", "source_rows", F.round(F.least(cap.cast("double"), level * F.col("weight")), 6).alias("target"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per document: key, row, size, source, source_size, target, taken.

    ``size``: words. Each source's documents are put into a random but repeatable order (by MD5 of key and text). Its
    budget, the target rounded to whole words, takes all of them as often as it holds them whole, then in that order
    until it is used up; ``taken`` is the document's words so used, part of a document at the cut. NULL keys, texts (no
    words) and sources (a source of their own) are fine; repeated rows are documents of their own. ``row`` numbers the
    rows of ``docs``, which must be read from stored files.
    """
    return _mix(*with_row(docs), key, text, source)


def _mix(numbered: DataFrame, row: str, key: str, text: str, source: str) -> DataFrame:
    mark = F.md5(F.concat_ws("|", F.coalesce(F.col(key).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))).cast("binary"))
    slim = stored(numbered.select(
        F.col(key).alias("key"), F.col(row).alias("row"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"),
        F.conv(F.substring(mark, 1, 15), 16, 10).cast("long").alias("draw")), "mix-sizes")
    plan = stored(targets(slim), "mix-targets")
    budget = F.floor(F.col("target") + 0.5)
    plan = plan.select(F.col("source").alias("of"), "source_size", "target", budget.alias("budget"),
                       F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).alias("rounds"),
                       F.ceil(F.col("source_rows") / RANGE_ROWS).alias("ranges"))
    dealt = slim.join(plan, slim["source"].eqNullSafe(plan["of"])).drop("of").withColumn(
        "part", F.shiftright(F.shiftright("draw", 28) * F.col("ranges"), 32))  # draws are below 2 ** 60
    # Equal documents have equal draws: they are summed as one, and each takes its place among them by its number.
    same = ["source", "draw", "key", "size"]
    rows = stored(copies_numbered(dealt, same, "row"), "mix-rows")
    groups = rows.groupBy("source", "part", "draw", "key", "size").agg((F.count("*") * F.col("size")).alias("words"))
    # Prefix sums in three steps, so that a source's ranges are not all summed by one task either.
    groups = stored(groups.withColumn("section", F.shiftright("part", 10)), "mix-groups")
    total, steps = groups, (["section"], ["part"], ["draw", "key", "size"])
    for depth, step in enumerate(steps):
        above = ["source", *[c for s in steps[:depth] for c in s]]
        sums = groups.groupBy(*above, *step).agg(F.sum("words").alias("words"))
        earlier = W.partitionBy(*above).orderBy(*step).rowsBetween(W.unboundedPreceding, -1)
        sums = sums.select(*[F.col(c).alias(f"at_{c}") for c in (*above, *step)], F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias(f"before_{depth}"))
        total = total.join(sums, [total[c].eqNullSafe(sums[f"at_{c}"]) for c in (*above, *step)]).drop(*[f"at_{c}" for c in (*above, *step)])
    before = sum((F.col(f"before_{depth}") for depth in range(len(steps))), F.lit(0))
    starts = stored(total.select(*[F.col(c).alias(f"of_{c}") for c in same], before.alias("before")), "mix-starts")
    joined = rows.join(starts, [rows[c].eqNullSafe(starts[f"of_{c}"]) for c in same])
    rest = F.col("budget") - F.col("rounds") * F.col("source_size") - F.col("before") - F.col("nth") * F.col("size")
    taken = F.col("rounds") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return joined.select("key", "row", "size", "source", "source_size", "target", taken.cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents of the mix: each as often as the mix takes it, that at a source's cut whole; columns as in ``docs``."""
    numbered, row = with_row(docs)
    times = _mix(numbered, row, key, text, source).where("taken > 0").select(
        F.col("row").alias("mix_row"), F.ceil(F.col("taken") / F.col("size")).cast("int").alias("mix_times"))
    # Merged at every size: what is taken grows with the corpus, and a join by size would change its plan.
    times = stored(times, "mix-times").hint("merge").alias("t")
    joined = numbered.alias("d").join(times, F.col(f"d.`{row}`") == F.col("t.mix_row"))
    again = free_name(docs, "again")
    return joined.select(*[F.col(f"d.`{c}`") for c in docs.columns],
                         F.explode(F.array_repeat(F.lit(0), F.col("t.mix_times"))).alias(again)).drop(again)
