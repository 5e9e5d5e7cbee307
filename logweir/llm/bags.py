"""Ranked lexical search in whole numbers; equal bags of words are scored once.

Items are worked on in blocks of bounded size. For a block, every document is restricted to the words of its items: the
*bag* of a document is its vector of (word, occurrences) among these. Documents of equal bags and equal length norm
have equal scores for every item, so they form a class: grouped by hash, and held apart by the whole bag. Each class is
scored once, for all items at once; a task hands on the best ``top`` classes per item. Then the winning classes are
expanded to their documents by ascending key.

``top`` classes per item are enough: classes ordered by (score, smallest key) each put a document before all documents
of the classes after them. For the same reason ``top`` documents of a class are enough.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from logweir.llm.common import bytes_of, slices, stored

# A term: a longest run of ASCII letters, digits and characters beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERMS_OF_BYTES = re.compile(rb"[0-9A-Za-z\x80-\xFF]+").findall
TOP = 50
# A block holds about so many words of items; an item is never split.
BLOCK_TERMS = 1 << 18
# About so many scores are held at once.
CELLS = 1 << 20


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, A-Z lower-cased."""
    return _TERMS_OF_BYTES(text.lower())


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """(item, own, terms): a number for each row, its key, its distinct terms as binaries."""
    lower = F.translate(F.col(f"`{text}`"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    every = F.array_distinct(F.regexp_extract_all(F.coalesce(lower, F.lit("")), F.lit(TERM), F.lit(0)))
    return items.select(F.monotonically_increasing_id().alias("item"), F.col(f"`{key}`").alias("own"), F.transform(every, lambda x: x.cast("binary")).alias("terms"))


class Block:
    """Items of a block: the vocabulary and, per word, the items that hold it."""

    def __init__(self, rows: list[tuple[int, list[bytes]]]):
        self.items = np.array([i for i, _ in rows], np.int64)
        self.words = sorted({w for _, ws in rows for w in ws})
        self.number = {w: n for n, w in enumerate(self.words)}
        pairs = sorted((self.number[w], at) for at, (_, ws) in enumerate(rows) for w in ws)
        self.holders = np.array([at for _, at in pairs], np.int64)
        self.starts = np.searchsorted(np.array([w for w, _ in pairs], np.int64), np.arange(len(self.words) + 1))

    def bag(self, words: list[bytes]) -> bytes:
        """Numbers of the block's words in ``words``, ascending, then how often each occurs."""
        found = np.fromiter(map(self.number.get, words, repeat(-1)), np.int32, len(words))
        numbers, times = np.unique(found[found >= 0], return_counts=True)
        return np.concatenate([numbers, times]).astype("<i4").tobytes()

    def scores(self, bags: list[bytes], norms: list[int], weights: np.ndarray) -> np.ndarray:
        """Scores (bags, items) in whole numbers."""
        parts = [np.frombuffer(b, "<i4").reshape(2, -1).astype(np.int64) for b in bags]
        sizes = np.array([p.shape[1] for p in parts], np.int64)
        who = np.repeat(np.arange(len(bags)), sizes)
        word, times = np.concatenate(parts, axis=1) if parts else np.zeros((2, 0), np.int64)
        gain = weights[word] * ((1_000_000_000 * times) // (1000 * times + 20 * np.array(norms, np.int64)[who]))
        fan = self.starts[word + 1] - self.starts[word]
        at = np.repeat(self.starts[word] - np.r_[0, np.cumsum(fan)[:-1]], fan) + np.arange(fan.sum())
        cell = np.repeat(who, fan) * len(self.items) + self.holders[at]
        gain, size = np.repeat(gain, fan), len(bags) * len(self.items)
        # Halves of 31 bits add up exactly in doubles.
        low = np.bincount(cell, gain & 0x7FFFFFFF, size).astype(np.int64)
        return (low + (np.bincount(cell, gain >> 31, size).astype(np.int64) << 31)).reshape(len(bags), -1)


def blocks(numbered: DataFrame, size: int) -> Iterator[Block]:
    """The items, dealt by hash into blocks of about ``size`` words each; one block at a time comes to the driver."""
    total = numbered.agg(F.sum(F.size("terms"))).first()[0] or 0
    n = max(1, -(-int(total) // size))
    mine = F.pmod(F.xxhash64("item"), F.lit(n))
    for b in range(n):
        rows = numbered.where((mine == b) & (F.size("terms") > 0)).select("item", "terms").collect()
        if rows:
            yield Block([(r["item"], [bytes(t) for t in r["terms"]]) for r in rows])


def bags(docs: DataFrame, block: Block, key: str, text: str) -> DataFrame:
    """(key, n, bag) for each document with a term: the number of its terms, and its bag in the block's words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [terms(x) for x in bytes_of(part.column("text"))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(list(map(len, found)), pa.int64()), pa.array(list(map(block.bag, found)), pa.binary())], names=["key", "n", "bag"])

    kind = docs.schema[key].dataType.simpleString()
    named = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return named.mapInArrow(run, f"key {kind}, n long, bag binary").where("n > 0")


def document_counts(held: DataFrame, words: int) -> np.ndarray:
    """How many documents hold each of the block's words; each task adds up its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(words, np.int64)
        for batch in batches:
            for bag in batch.column(0).to_pylist():
                counts[np.frombuffer(bag, "<i4")[:len(bag) // 8]] += 1
        there = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(counts[there])], names=["word", "n"])

    found = np.zeros(words, np.int64)
    for r in held.select("bag").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect():
        found[r["word"]] = r["n"]  # as many as the block has words
    return found


def best_classes(classes: DataFrame, block: Block, weights: np.ndarray, top: int) -> DataFrame:
    """(item, class, score, low): per task and item the ``top`` classes by score, then smallest key, NULL last."""
    kind = classes.schema["low"].dataType
    arrow = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(block.items)
        score, number, low = np.zeros((0, n), np.int64), np.zeros((0, n), np.int64), np.zeros((0, n), object)
        step = max(4 * top, CELLS // n)
        for batch in batches:
            for i in range(0, batch.num_rows, step):
                part = batch.slice(i, step)
                lows = np.empty(part.num_rows, object)
                lows[:] = part.column("low").to_pylist()
                new = block.scores(part.column("bag").to_pylist(), part.column("m").to_pylist(), weights)
                score = np.concatenate([score, new])
                # Rows come by ascending key, so a stable order puts the smaller key first among equal scores.
                order = np.argsort(-score, axis=0, kind="stable")[:top]
                score = np.take_along_axis(score, order, 0)
                number, low = (np.take_along_axis(np.concatenate([x, np.broadcast_to(own[:, None], new.shape)]), order, 0)
                               for x, own in ((number, part.column("class").to_numpy()), (low, lows)))
        good = score > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.broadcast_to(block.items, score.shape)[good]), pa.array(number[good]), pa.array(score[good]), pa.array(low[good].tolist(), arrow)],
            names=["item", "class", "score", "low"])

    ordered = classes.select("class", "m", "bag", "low").sortWithinPartitions(F.asc_nulls_last("low"))
    return ordered.mapInArrow(run, f"item long, class long, score long, low {kind.simpleString()}")


def _first(frame: DataFrame, by: list[str], order: list, top: int, rank: str) -> DataFrame:
    """The first ``top`` rows of each group, with their rank; tasks cut to ``top`` before the shuffle."""
    return frame.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(rank) <= top)


def _ranked(docs: DataFrame, block: Block, totals, key: str, text: str, top: int) -> DataFrame:
    held = stored(bags(docs, block, key, text), "bags")
    n, length = totals(held)
    weights = np.floor(1000 * np.log((2 * n + 2) / (2 * document_counts(held, len(block.words)) + 1))).astype(np.int64)
    product = (F.lit(50).cast("decimal(38,0)") * F.col("n") * F.lit(n)).cast("decimal(38,0)")
    norm = (F.lit(100 - 50) + F.call_function("div", product, F.lit(max(length, 1)).cast("decimal(38,0)"))).cast("long")
    signed = held.where(F.octet_length("bag") > 0).select("key", "bag", norm.alias("m")).withColumn("h", F.xxhash64("bag", "m"))
    # Grouped by hash, told apart by the bag itself.
    classes = signed.groupBy("h", "m", "bag").agg(F.min("key").alias("low"))
    classes = stored(classes.withColumn("class", F.monotonically_increasing_id()), "bag-classes")
    best = best_classes(classes, block, weights, top)
    winners = stored(_first(best, ["item"], [F.desc("score"), F.asc_nulls_last("low"), "class"], top, "place").select("item", "class", "score"), "bag-winners")
    chosen = stored(classes.join(winners.select("class").distinct(), "class", "left_semi").select("class", "h", "m", "bag"), "bag-chosen")
    near = signed.join(chosen.select("h").distinct(), "h", "left_semi")  # by hash
    some = _first(near, ["h", "m", "bag"], [F.asc_nulls_last("key")], top, "nth").select("h", "m", "bag", "key")
    members = stored(some.join(chosen, ["h", "m", "bag"]).select("class", "key"), "bag-members")  # verified
    return _first(winners.join(members, "class"), ["item"], [F.desc("score"), F.asc_nulls_last("key")], top, "rank").select("item", "rank", "key", "score")


def ranked(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
           item_text: str = "text", top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The ``top`` best documents of each item with a score above 0: own (the item's key), rank (from 1), key, score.

    A row of ``items`` is an item of its own, repeated ones too; a NULL or wordless one finds nothing. Repeated
    documents count and are found each. A NULL or wordless text has no terms and is in no count. Equal scores stand by
    ascending key, NULL last. No documents or no items: no rows. Other columns are not read. Items are taken in blocks
    of about ``block_terms`` words, at each of which the documents are read once.
    """
    if top < 1 or block_terms < 1:
        raise ValueError("top and block_terms must be 1 or more")
    numbered = stored(item_terms(items, item_key, item_text), "items")
    known: list[tuple[int, int]] = []

    def totals(held: DataFrame) -> tuple[int, int]:
        if not known:
            row = held.agg(F.count("*").alias("n"), F.sum(F.col("n").cast("decimal(38,0)")).alias("length")).first()
            known.append((row["n"], int(row["length"] or 0)))
        return known[0]

    found = docs.sparkSession.createDataFrame([], f"item long, rank int, key {docs.schema[key].dataType.simpleString()}, score long")
    for block in blocks(numbered, block_terms):
        found = found.union(stored(_ranked(docs, block, totals, key, text, top), "ranked"))
    return found.join(numbered.select("item", "own"), "item").select("own", "rank", "key", "score")
