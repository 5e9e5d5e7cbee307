"""Document fingerprints by content-defined chunking.

A gear hash rolls over the UTF-8 bytes; where it ends in enough zero bits, a chunk ends. The number of zero bits asked
for is higher before the normal size and lower after it, which keeps sizes close to normal. Boundaries depend on the 32
bytes before them only, so text that moves keeps its chunks. A fingerprint is the set of chunk digests with lengths;
the shared length of two sets, over that of the smaller, tells how much of one text the other contains.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import map_texts, slices, texts_of, with_row

SMALLEST, NORMAL, LARGEST = 16, 64, 256
STRICT, LOOSE = np.uint32(0xFF << 24), np.uint32(0x0F << 28)
GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), seed=42) for b in range(256)], np.uint32)


def boundaries(data: bytes) -> list[int]:
    """Ends of the chunks, the last one at the end of the data."""
    size = len(data)
    if size <= SMALLEST:
        return [size] if size else []
    rolled = GEAR[np.frombuffer(data, np.uint8)]
    for step in (1, 2, 4, 8, 16):
        wider = rolled.copy()
        wider[step:] += rolled[:-step] << np.uint32(step)
        rolled = wider
    loose_at = np.flatnonzero((rolled & LOOSE) == 0)
    strict = (loose_at[(rolled[loose_at] & STRICT) == 0] + 1).tolist()
    loose = (loose_at + 1).tolist()
    strict.append(size)
    loose.append(size)
    ends, start = [], 0
    while size - start > SMALLEST:
        end = strict[bisect_left(strict, start + SMALLEST)]
        if end >= start + NORMAL:
            end = min(loose[bisect_left(loose, start + NORMAL)] if start + NORMAL < size else size, start + LARGEST)
        ends.append(end)
        start = end
    if start < size:
        ends.append(size)
    return ends


def chunk_set(text: str) -> dict[str, int]:
    """Digest to length in bytes of the distinct chunks of a text."""
    data = text.encode()
    found, start, digest = {}, 0, xxhash.xxh3_64_hexdigest
    for end in boundaries(data):
        found[digest(data[start:end])[:12]] = end - start
        start = end
    return found


def written(chunks: dict[str, int]) -> str:
    """A fingerprint as text: digest:length of each chunk, sorted, comma-joined."""
    return ",".join([f"{d}:{n}" for d, n in sorted(chunks.items())])


def containment(a: dict[str, int], b: dict[str, int]) -> float:
    """Shared length over that of the smaller set; 1 for two empty ones."""
    if not a or not b:
        return 1.0 if not a and not b else 0.0
    return sum(map(a.__getitem__, a.keys() & b.keys())) / min(sum(a.values()), sum(b.values()))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint) per row, a NULL text as the empty one (an empty fingerprint)."""
    def work(part: pa.RecordBatch) -> dict:
        return {"fingerprint": [written(chunk_set(x)) for x in texts_of(part.column(text))]}

    return map_texts(docs.select(key, text), text, work, f"`{key}` {docs.schema[key].dataType.simpleString()}, fingerprint string")


def _compared(batches):
    """Rows (stretch, guest, key, text) in order: each row that is no guest compared with the row after it."""
    schema = pa.schema([("key", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
    before = None
    for batch in batches:
        for part in slices(batch, "text"):
            out = []
            for stretch, guest, key, text in zip(part.column("stretch").to_pylist(), part.column("guest").to_pylist(),
                                                 part.column("key").to_pylist(), texts_of(part.column("text"))):
                chunks = chunk_set(text)
                if before and before[0] == stretch:
                    _, old_key, old, old_chunks = before
                    cut = len(old) // 3
                    edited = old[:len(old) - cut] + text[:cut]
                    edited_chunks = chunk_set(edited)
                    out.append((old_key, len(old), hashlib.sha256(edited.encode()).hexdigest(), written(old_chunks), written(edited_chunks),
                                containment(old_chunks, edited_chunks), containment(old_chunks, chunks)))
                before = None if guest else (stretch, key, text, chunks)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)


def edited_and_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document against an edited copy of itself and against the next one, by falling key, the last one's being the first.

    Columns: key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. The edited copy has
    its last third (code points, rounded down) replaced by the first as many of the next document. Keys are whole
    numbers; NULL keys come last and repeated keys in the order of the rows. A single document is its own next. A NULL
    text is empty.

    One shuffle: the order is cut into stretches at keys that a range partitioning of the keys alone has found (the
    driver holds one per stretch); each stretch is sorted in a task, with the first row of the next as a guest.
    """
    spark = docs.sparkSession
    numbered, row = with_row(docs)
    rank = F.coalesce(F.bitwise_not(F.col(key)), F.lit((1 << 63) - 1)).alias("rank")
    count = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    slim = numbered.select(rank, F.col(row).alias("row")).repartitionByRange(count, "rank", "row")
    found = slim.groupBy(F.spark_partition_id()).agg(F.min(F.struct("rank", "row")).alias("low")).select("low.rank", "low.row.file", "low.row.index").collect()
    bounds = sorted((r["rank"], r["file"], r["index"]) for r in found)
    rows = numbered.select(rank, F.col(row).alias("row"), F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    if not bounds:
        return rows.withColumns({"stretch": F.lit(0), "guest": F.lit(False)}).select("stretch", "guest", "key", "text").mapInArrow(_compared, _COMPARED)
    limits = F.array(*[F.struct(F.lit(a).cast("long").alias("rank"), F.struct(F.lit(b).cast("long").alias("file"), F.lit(c).cast("long").alias("index")).alias("row")) for a, b, c in bounds])
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))])
    me = F.struct("rank", "row")
    # Binary search: the number of limits that are not above this row, less one.
    stretch = F.aggregate(steps, F.lit(0), lambda lo, step: F.when(
        (lo + step <= len(bounds)) & (F.element_at(limits, F.least(lo + step, F.lit(len(bounds)))) <= me), lo + step).otherwise(lo)) - 1
    rows = rows.withColumn("stretch", stretch)
    first = F.element_at(limits, F.col("stretch") + 1) == me
    host = F.pmod(F.col("stretch") - 1, F.lit(len(bounds)))
    places = F.array_compact(F.array(
        F.struct(F.col("stretch").alias("stretch"), F.lit(False).alias("guest")),
        F.when(first, F.struct(host.alias("stretch"), F.lit(True).alias("guest")))))
    placed = rows.select("rank", "row", "key", "text", F.explode(places).alias("place")).select("rank", "row", "key", "text", "place.*")
    ordered = placed.repartition("stretch").sortWithinPartitions("stretch", "guest", "rank", "row")
    return ordered.select("stretch", "guest", "key", "text").mapInArrow(_compared, _COMPARED)


_COMPARED = ("key long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")
