"""Near-duplicate documents by SimHash; candidates by the pigeonring principle.

Two fingerprints with at most 4 differing bits are cut into 5 segments on a ring. Then some segment starts a chain in
which the first l segments differ by at most floor(0.8 l) bits, for every l: 0, 1, 2, 3, 4. The first two of these
bounds make a join key (a segment, and the next one with at most one bit changed); the longer chains prune what the key
brings together, before the full Hamming distance.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import WORDS_OF_BYTES, bytes_of, map_texts, stored, with_row
from logweir.llm.components import components
from logweir.llm.jaccard import first_rows

SEED = 42
BITS = 4
WIDTHS = (13, 13, 13, 13, 12)
OFFSETS = (0, 13, 26, 39, 52)
# A cell (a join key's stored fingerprints) has about this many rows; larger keys are cut into blocks compared pairwise.
BLOCK = 2048
SMALL = 32


def simhash(text: bytes, n_gram: int) -> int:
    """64-bit SimHash of the ``n_gram``-word shingles of a UTF-8 text, A-Z lower-cased; repeats count.

    Fewer words than ``n_gram``: the whole sequence is the one shingle. No word: 0. A bit is 1 if set in over half of
    the shingles' XXH64.
    """
    words = WORDS_OF_BYTES(text.lower())
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= n_gram:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[i:j], SEED) for i, j in zip((ends - lengths)[: 1 - n_gram].tolist(), ends[n_gram - 1:].tolist())]
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[i:i + (1 << 16)], np.uint64)
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, keep: list[str], text: str, n_gram: int) -> DataFrame:
    """The columns ``keep`` and fp (long) for each row; a NULL text has no words."""

    def work(part: pa.RecordBatch) -> dict:
        found = np.array([simhash(x, n_gram) for x in bytes_of(part.column(text))], np.uint64)
        return {"fp": pa.array(found.view(np.int64))}

    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    return map_texts(docs.select(*keep, text), text, work, ", ".join([*kinds, "fp long"]))


def _segment(fp: Column, i: Column) -> Column:
    offset = F.element_at(F.array(*map(F.lit, OFFSETS)), i + 1)
    width = F.element_at(F.array(*map(F.lit, WIDTHS)), i + 1)
    return F.call_function("shiftrightunsigned", fp, offset).bitwiseAND(F.call_function("shiftleft", F.lit(1), width) - 1)


def _keyed(fps: DataFrame) -> DataFrame:
    """(fp, key, probe): each fingerprint stored under its 5 chains of two segments, and probing from them.

    Of two chains that differ in one bit, the one with a 0 there probes with a 1.
    """
    j = F.col("j")
    rows = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(5 * 14 - 1))).alias("j")).select(
        "fp", (j / 14).cast("int").alias("i"), (j % 14 - 1).alias("bit"))
    i, bit = F.col("i"), F.col("bit")
    after = _segment(F.col("fp"), (i + 1) % 5)
    rows = rows.select("fp", "i", "bit", _segment(F.col("fp"), i).alias("first"), after.alias("after")).where(
        (bit < 0) | ((bit < F.element_at(F.array(*map(F.lit, WIDTHS)), (i + 1) % 5 + 1))
                     & (F.call_function("shiftright", F.col("after"), F.greatest(bit, F.lit(0))).bitwiseAND(1) == 0)))
    flipped = F.when(bit < 0, F.col("after")).otherwise(
        F.col("after").bitwiseOR(F.call_function("shiftleft", F.lit(1), F.greatest(bit, F.lit(0)))))
    key = i.cast("long") * (1 << 26) + F.col("first").cast("long") * (1 << 13) + flipped.cast("long")
    return rows.select("fp", key.alias("key"), (bit >= 0).alias("probe"))


def _near(x: np.ndarray, start: np.ndarray | int) -> np.ndarray:
    """Whether differences ``x`` pass every chain from segment ``start`` on, up to the whole ring."""
    per = [np.bitwise_count((x >> np.uint64(o)) & np.uint64((1 << w) - 1)).astype(np.int16) for o, w in zip(OFFSETS, WIDTHS)]
    if isinstance(start, int):
        ring = [per[(start + k) % 5] for k in range(5)]
    else:
        at, every = np.stack(per), np.arange(len(x))
        ring = [at[(start + k) % 5, every] for k in range(5)]
    total, fine = np.zeros(len(x), np.int16), np.ones(len(x), bool)
    for chain, d in enumerate(ring, 1):
        total = total + d
        fine &= total <= BITS * chain // 5
    return fine


class _Cell:
    """A large cell: links enough to join what belongs together, one by one, instead of all pairs."""

    def __init__(self, own: np.ndarray, start: int):
        self.own, self.start, self.labels = own, start, np.arange(len(own))
        self.links: list[tuple[int, int]] = []
        for r in range(1, len(own)):
            self.add(own[r], own[:r], r)

    def add(self, fp: np.uint64, among: np.ndarray, label: int | None = None) -> None:
        hits = np.flatnonzero(_near(among ^ fp, self.start))
        groups, first = np.unique(self.labels[hits], return_index=True)
        for g, k in zip(groups.tolist(), first.tolist()):
            self.links.append((int(fp), int(among[hits[k]])))
            if label is None:
                label = g
            elif g != label:
                self.labels[self.labels == g] = label

    def probe(self, fps: np.ndarray) -> None:
        for fp in fps:
            self.add(fp, self.own)


def _links(batches):
    """Links (a, b) of rows (key, block, probe, fp) sorted by these, cells never split between tasks."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def out(a: np.ndarray, b: np.ndarray):
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=schema)

    def small(cells: np.ndarray, starts: np.ndarray, probe: np.ndarray, fps: np.ndarray):
        found = []
        for d in range(1, SMALL):
            at = np.flatnonzero((cells[d:] == cells[:-d]) & ~probe[:-d])
            if not len(at):
                break
            at = at[_near(fps[at] ^ fps[at + d], starts[at])]
            found.append((fps[at], fps[at + d]))
        if found:
            yield out(np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found]))

    def large(cell: _Cell):
        pairs = np.array(cell.links, np.uint64).reshape(-1, 2)
        cell.links = []
        yield out(np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1]))

    held: list[np.ndarray] | None = None  # key, block, probe, fp of the last cell so far, unless it is open
    open_cell: tuple[int, int, _Cell] | None = None
    for batch in batches:
        rows = [batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False),
                batch.column(3).to_numpy().view(np.uint64)]
        if open_cell:
            same = (rows[0] == open_cell[0]) & (rows[1] == open_cell[1])
            open_cell[2].probe(rows[3][same])
            yield from large(open_cell[2])
            if same.all():
                continue
            open_cell, rows = None, [x[~same] for x in rows]
        if held:
            rows = [np.concatenate(x) for x in zip(held, rows)]
        new = np.flatnonzero((rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])) + 1
        last = new[-1] if len(new) else 0
        held = [x[last:].copy() for x in rows]
        if held[2].any() and len(held[0]) > 2 * BLOCK:  # all its stored rows are here: go on as a stream
            cell = _Cell(held[3][~held[2]], int(held[0][0] >> 26))
            cell.probe(held[3][held[2]])
            open_cell, held = (int(rows[0][-1]), int(rows[1][-1]), cell), None
            yield from large(cell)
        yield from _complete([x[:last] for x in rows], small, large)
    if held:
        yield from _complete(held, small, large)


def _complete(rows: list[np.ndarray], small, large):
    """Links of whole cells."""
    key, block, probe, fps = rows
    if not len(key):
        return
    edge = np.r_[True, (key[1:] != key[:-1]) | (block[1:] != block[:-1])]
    cells = np.cumsum(edge) - 1
    sizes = np.bincount(cells)
    owners = np.bincount(cells, ~probe)
    keep = ((sizes > 1) & (owners > 0))[cells]
    few = keep & (sizes <= SMALL)[cells]
    yield from small(cells[few], key[few] >> 26, probe[few], fps[few])
    for c in np.flatnonzero((sizes > SMALL) & (owners > 0)):
        at = slice(*np.searchsorted(cells, [c, c + 1]))
        cell = _Cell(fps[at][~probe[at]], int(key[at][0] >> 26))
        cell.probe(fps[at][probe[at]])
        yield from large(cell)


def links(fps: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp), enough to connect all that are 4 or fewer bits apart.

    A key with more than BLOCK stored fingerprints is cut into blocks by hash: a fingerprint is stored in one and
    compared with all, each block in a task of its own. No pair is left out, and within a cell each row adds a link
    only to groups it wasn't in yet, so the links stay in proportion to the rows.
    """
    rows = _keyed(fps)
    hot = stored(rows.where(~F.col("probe")).groupBy("key").count().where(F.col("count") > BLOCK)
                 .select("key", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")), "hot-keys")
    blocks = F.coalesce("blocks", F.lit(1))
    mine = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    last = blocks - 1
    places = F.when(F.col("probe"), F.transform(F.sequence(F.lit(0), last), lambda b: F.struct(b.alias("block"), F.lit(True).alias("probe")))).otherwise(
        F.concat(F.array(F.struct(mine.alias("block"), F.lit(False).alias("probe"))),
                 F.transform(F.when(mine < last, F.sequence(mine + 1, last)).otherwise(F.array().cast("array<int>")),
                             lambda b: F.struct(b.alias("block"), F.lit(True).alias("probe")))))
    cells = rows.join(hot, "key", "left").select("key", "fp", F.inline(places))
    return (cells.select("key", "block", "probe", "fp").repartition("key", "block")
            .sortWithinPartitions("key", "block", "probe", "fp").mapInArrow(_links, "a long, b long"))


def fingerprint_components(signed: DataFrame, key: str) -> DataFrame:
    """(fp, component_id) per fingerprint of ``signed`` (key, fp): the smallest key reachable over links."""
    fps = stored(signed.groupBy("fp").agg(F.min(key).alias("low")), "fingerprints")
    found = links(fps.select("fp"))
    roots = components(found)
    joined = fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    joined = stored(joined, "roots")
    lowest = joined.groupBy("root").agg(F.min("low").alias("component_id"))
    return stored(joined.join(lowest, "root").select("fp", "component_id"), "components")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", n_gram: int = 4) -> DataFrame:
    """One row per document: key, fp, component_id (the smallest key of its near-duplicates, itself included).

    A NULL or wordless text has fingerprint 0 and is linked like any other. Repeated rows give repeated rows. A NULL
    key counts as larger than any other: a component of only such rows has a NULL id. Other columns are not read.
    """
    named = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    signed = stored(fingerprints(named, ["key"], "text", n_gram), "simhash")
    return signed.join(fingerprint_components(signed, "key"), "fp").select("key", "fp", "component_id")


def without_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", n_gram: int = 5) -> DataFrame:
    """The rows of ``docs``, one of each group of near-duplicates: that with the smallest key, NULL last, the first of equal ones.

    Near-duplicates share 80 % of their ``n_gram``-word shingles (Jaccard), or are linked through such. ``docs`` must be
    read from stored files. NULL and wordless texts are near-duplicates of each other.
    """
    numbered, row = with_row(docs)
    order = F.struct(F.col(key).isNull().alias("last"), F.col(key).alias("key"), F.col(row).alias("row"))
    kept = stored(first_rows(numbered.select(order.alias("order"), F.col(text).alias("text")), "order", "row", "text", n_gram), "near-kept")
    # Merged at every size: what is kept grows with the corpus, and a join by size would change its plan.
    return numbered.join(kept.hint("merge"), numbered[row] == F.col("kept_row"), "left_semi").drop(row)
