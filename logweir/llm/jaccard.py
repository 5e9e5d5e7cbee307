"""Near-duplicate texts by wide SimHash, pigeonring filtering and exact Jaccard likeness of word shingles.

Each text has a SimHash of 256 bits over its distinct shingles. Texts of likeness 0.8 differ in about 39 of them, unrelated
ones in 128. So many differing bits can't be brought together by segments that are equal: there is no segment without a
difference. Texts meet where the minima of their hashed shingles agree (24 bands of 5: a pair of exactly 0.8 is left out
once in 14,000 times). Whatever meets passes the pigeonring filter, on fingerprints alone: of 16 segments in a ring, some
chain of consecutive ones must stay within its share of the budget at every length; then the full Hamming distance must.
What is left is confirmed by the whole sets of shingles, so no link lies below the bar.

Groups of alike texts are linked to one representative per band first. Only what that leaves apart is compared within
its band, across the groups found, so a large group of variants costs about as much as as many unrelated texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import WORDS_OF_BYTES, bytes_of, map_texts, stored
from logweir.llm.components import components

PERCENT = 80
BANDS, ROWS = 24, 5
SEED = 42
# A cell (the texts of a band's key) has about this many rows and bytes of shingles; larger keys are cut into blocks.
BLOCK = 512
BLOCK_BYTES = 8 << 20
# The fingerprint: 4 words of 64 bits; 16 segments; differing bits that two alike texts may have, and the longest chain tried.
WORDS, SEGMENTS, BITS, CHAIN = 4, 16, 72, 6
# From so many candidates on, shared shingles are counted for all rows of a cell at once.
MANY = 24
_FACTORS, _TERMS = np.random.default_rng(SEED).integers(0, 1 << 64, (2, BANDS * ROWS, 1), np.uint64)
_FACTORS |= np.uint64(1)
_WORD_FACTORS = np.random.default_rng(SEED + 1).integers(0, 1 << 64, WORDS, np.uint64) | np.uint64(1)


def words_of(text: bytes) -> list[bytes]:
    return WORDS_OF_BYTES(text.lower())


def shingles(words: list[bytes], n_gram: int) -> np.ndarray:
    """Sorted XXH64 of the distinct ``n_gram``-word shingles; fewer words are one shingle, and no word is none."""
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    last = max(len(words) - n_gram + 1, 1)
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[i:j], SEED) for i, j in zip((ends - lengths)[:last].tolist(), ends[min(n_gram, len(words)) - 1:].tolist())], np.uint64))


def bands(found: np.ndarray) -> list[int]:
    """A key per band of minima; none for a text without words."""
    if not len(found):
        return []
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for i in range(0, len(found), 4096):
        low = np.minimum(low, (found[i:i + 4096] * _FACTORS + _TERMS).min(axis=1))
    data = low.tobytes()
    size = len(data) // BANDS
    keys = [xxhash.xxh64_intdigest(data[b * size:(b + 1) * size], b) for b in range(BANDS)]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def fingerprint(found: np.ndarray) -> bytes:
    """256-bit SimHash of distinct shingles: a bit is 1 if set in over half of their hashes."""
    counts = np.zeros(64 * WORDS, np.int64)
    for i in range(0, len(found), 1 << 14):
        part = found[i:i + (1 << 14), None] * _WORD_FACTORS
        part ^= part >> np.uint64(32)
        part *= np.uint64(0x9E3779B97F4A7C15)
        part ^= part >> np.uint64(29)
        counts += np.unpackbits(part.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts > len(found), bitorder="little").tobytes()


def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of fingerprints ``a`` and ``b`` (n, 4) are BITS apart or less: the pigeonring filter, then the full distance."""
    apart = np.bitwise_count(np.ascontiguousarray(a ^ b).view(np.uint16)).astype(np.int16)  # per segment
    found = np.zeros(len(apart), bool)
    ring = np.concatenate([apart, apart[:, :CHAIN]], axis=1)
    fine, total = np.ones((len(apart), SEGMENTS), bool), np.zeros((len(apart), SEGMENTS), np.int16)
    for chain in range(1, CHAIN + 1):
        total += ring[:, chain - 1:chain - 1 + SEGMENTS]
        fine &= total * SEGMENTS <= BITS * chain
    at = np.flatnonzero(fine.any(axis=1))
    found[at] = apart[at].sum(axis=1) <= BITS
    return found


def _fingerprints(column: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<u8").reshape(-1, WORDS)


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets of shingles are PERCENT alike or more."""
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    shared = int((b[at] == a).sum())
    return 100 * shared >= PERCENT * (len(a) + len(b) - shared)


def sketches(docs: DataFrame, keep: list[str], text: str, n_gram: int) -> DataFrame:
    """The columns ``keep``, node (a digest of the words, equal for equal texts), bands, fingerprint and number of shingles for each row.

    A NULL text has no words.
    """
    def work(part: pa.RecordBatch) -> dict:
        words = [words_of(x) for x in bytes_of(part.column(text))]
        sets = [shingles(w, n_gram) for w in words]
        return {"node": [xxhash.xxh3_128_digest(b" ".join(w)) for w in words], "bands": list(map(bands, sets)),
                "fp": list(map(fingerprint, sets)), "n": list(map(len, sets))}

    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    return map_texts(docs.select(*keep, text), text, work, ", ".join([*kinds, "node binary, bands array<long>, fp binary, n long"]))


class _Cell:
    """A cell's stored texts; links enough to join what belongs together and isn't joined yet, instead of all pairs.

    ``rows``: node, the group it is known to belong to, fingerprint, shingles.
    """

    def __init__(self, rows: list[tuple[bytes, bytes, bytes, np.ndarray]]):
        self.nodes, groups, fps, self.sets = map(list, zip(*rows))
        self.fps, self.links, self.index = _fingerprints(fps), [], None
        self.numbers: dict[bytes, int] = {}
        self.parents: list[int] = []
        self.groups = np.array([self._root(g) for g in groups])
        for r in range(1, len(rows)):
            self.add(self.nodes[r], groups[r], self.fps[r], self.sets[r], r)

    def _root(self, group: bytes) -> int:
        """The number of the group that a group has become part of here."""
        n = self.numbers.setdefault(group, len(self.parents))
        if n == len(self.parents):
            self.parents.append(n)
        while self.parents[n] != n:
            n = self.parents[n]
        return n

    def add(self, node: bytes, group: bytes, fp: np.ndarray, found: np.ndarray, among: int) -> None:
        """Compare a text with the first ``among`` stored ones of other groups, and link it once to each that has one alike."""
        own = self._root(group)
        at = np.flatnonzero(self.groups[:among] != own)
        at = at[near(self.fps[at], fp)]
        others = self.groups[at]
        shared = self._shared(found) if len(at) > MANY else None
        for other in np.unique(others).tolist():
            for r in at[others == other].tolist():
                if alike(found, self.sets[r]) if shared is None else self._enough(len(found), r, shared):
                    self.links.append((node, self.nodes[r]))
                    self.parents[other] = own
                    self.groups[self.groups == other] = own
                    break

    def _enough(self, size: int, r: int, shared: np.ndarray) -> bool:
        return 100 * shared[r] >= PERCENT * (size + len(self.sets[r]) - shared[r])

    def _shared(self, found: np.ndarray) -> np.ndarray:
        """How many of the shingles each stored text has."""
        if self.index is None:
            every, who = np.concatenate(self.sets), np.repeat(np.arange(len(self.sets)), list(map(len, self.sets)))
            order = np.argsort(every, kind="stable")
            self.index = (*np.unique(every[order], return_index=True, return_counts=True), who[order])
        hashes, starts, counts, who = self.index
        at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
        at = at[hashes[at] == found]
        n = counts[at]
        places = np.repeat(starts[at] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum()) if len(at) else at
        return np.bincount(who[places], minlength=len(self.nodes))


def _across(batches):
    """Links (a, b) of rows (key, block, probe, node, label, fp, found) sorted by the first three, cells never split between tasks."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def out(links):
        return pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*links)], schema=schema)

    at, cell, rows = None, None, []
    for batch in batches:
        links = []
        values = batch.column("found").values.to_numpy().view(np.uint64)
        offsets = batch.column("found").offsets.to_pylist()
        columns = [batch.column(c).to_pylist() for c in ("key", "block", "probe", "node", "label", "fp")]
        for key, block, probe, node, label, fp, i, j in zip(*columns, offsets, offsets[1:]):
            found = values[i:j].copy()
            if at != (key, block):
                if len(rows) > 1:  # a cell without probes
                    links += _Cell(rows).links
                at, cell, rows = (key, block), None, []
            if not probe:
                rows.append((node, label, fp, found))
            elif rows or cell:
                if cell is None:
                    cell, rows = _Cell(rows), []
                cell.add(node, label, _fingerprints([fp])[0], found, len(cell.nodes))
                links += cell.links
                cell.links = []
        if links:
            yield out(links)
    if len(rows) > 1 and (links := _Cell(rows).links):
        yield out(links)


def _with_representatives(cells: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between texts and the representatives of their bands, near by fingerprint and confirmed."""
    def close(batches):
        for batch in batches:
            fine = near(*(_fingerprints(batch.column(c).to_pylist()) for c in ("fp", "rep_fp")))
            yield batch.select(["node", "rep"]).filter(pa.array(fine))

    pairs = cells.where("node != rep").select("node", "rep", "fp", "rep_fp").mapInArrow(close, "node binary, rep binary").distinct()
    first = pairs.join(sets.hint("merge"), "node")
    both = first.join(sets.select(F.col("node").alias("rep"), F.col("found").alias("other")).hint("merge"), "rep")
    shared = F.size(F.array_intersect("found", "other"))
    enough = 100 * shared >= PERCENT * (F.size("found") + F.size("other") - shared)
    return both.where(enough).select(F.col("node").alias("a"), F.col("rep").alias("b"))


def links(texts: DataFrame, sets_of, block: int | None = None) -> DataFrame:
    """Links (a, b) between nodes of ``texts`` (node, bands, fp, n; distinct), enough to connect all that meet in a band and are alike.

    ``sets_of``: from a frame of nodes to (node, found), their shingles. Bands that hold the same nodes are looked at
    once. First every text is compared with the smallest node of each of its bands. Bands whose texts that has not joined
    into one group are gone through: texts of different groups are compared, and each adds a link only to groups it
    wasn't in yet, so links stay in proportion to the rows. A band with more than ``block`` nodes is cut into blocks by
    hash: the texts of its largest group lie in one block each, the others are compared with all blocks, each block in a
    task of its own. No pair of different groups is left out.
    """
    block = block or BLOCK
    rows = texts.select("node", "fp", "n", F.explode("bands").alias("key"))
    many = rows.groupBy("key").agg(
        F.count("*").alias("rows"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64(F.lit(7), "node")).alias("y"),
        F.min(F.struct("node", "fp")).alias("rep")).where("rows > 1")
    many = many.groupBy("rows", "x", "y").agg(F.min("key").alias("key"), F.first("rep").alias("rep"))
    many = stored(many.select("key", F.col("rep.node").alias("rep"), F.col("rep.fp").alias("rep_fp")), "near-keys")
    cells = stored(rows.join(many.hint("merge"), "key"), "near-cells")
    sets = stored(sets_of(cells.select("node").distinct()), "near-sets")
    first = stored(_with_representatives(cells, sets), "near-first")
    groups = components(first).withColumnRenamed("node", "of")
    named = cells.join(groups, F.col("node") == F.col("of"), "left").select("key", "node", "fp", "n", F.coalesce("root", "node").alias("label"))
    named = stored(named, "near-named")
    by_label = named.groupBy("key", "label").agg(F.count("*").alias("rows"), F.sum("n").alias("n"))
    apart = by_label.groupBy("key").agg(F.count("*").alias("labels"), F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.max_by("label", F.struct("rows", "label")).alias("main"))
    size = F.greatest(F.ceil(F.col("rows") / block), F.ceil(8 * F.col("n") / BLOCK_BYTES)).cast("int")
    apart = stored(apart.where("labels > 1").select("key", "main", size.alias("blocks")), "near-apart")
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    every = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: F.struct(b.alias("block"), (b != mine).alias("probe")))
    places = F.when(F.col("label") == F.col("main"), F.array(F.struct(mine.alias("block"), F.lit(False).alias("probe")))).otherwise(every)
    placed = named.join(apart.hint("merge"), "key").select("key", "node", "label", "fp", F.inline(places)).join(sets.hint("merge"), "node")
    rest = (placed.select("key", "block", "probe", "node", "label", "fp", "found").repartition("key", "block")
            .sortWithinPartitions("key", "block", "probe", "node").mapInArrow(_across, "a binary, b binary"))
    return first.union(rest)


def first_rows(docs: DataFrame, order: str, row: str, text: str, n_gram: int) -> DataFrame:
    """(kept_row): of each group of near-duplicates of ``docs``, read from stored files, the ``row`` of the smallest ``order``.

    ``order``: a struct that ends in ``row``. Texts of the same words are equal, those without words as well.
    """
    signed = sketches(docs.select(order, text), [order], text, n_gram)
    texts = stored(signed.groupBy("node").agg(F.min(order).alias("low"), *[F.first(c).alias(c) for c in ("bands", "fp", "n")]), "near-texts")

    def sets_of(nodes: DataFrame) -> DataFrame:
        wanted = nodes.join(texts.select("node", F.col(f"low.{row}").alias("set_row")), "node")
        named = docs.select(F.col(f"{order}.{row}").alias("own_row"), text)
        joined = named.join(wanted.hint("merge"), F.col("own_row") == F.col("set_row")).select("node", text)
        return map_texts(joined, text, shingle_sets, "node binary, found array<bigint>")

    def shingle_sets(part: pa.RecordBatch) -> dict:
        found = [shingles(words_of(x), n_gram) for x in bytes_of(part.column(text))]
        ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
        return {"found": pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.uint64), *found]).view(np.int64)))}

    roots = components(links(texts.select("node", "bands", "fp", "n"), sets_of))
    joined = texts.select("node", "low").join(roots.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left")
    lowest = joined.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("low").alias("low"))
    return lowest.select(F.col(f"low.{row}").alias("kept_row"))
