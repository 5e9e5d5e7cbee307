"""Quality classifier by importance resampling: hashed n-gram models of target and raw text, sampled by Gumbel top-k.

Words and word pairs (A-Z lower-cased) are hashed into buckets, of which there are more the larger the corpus is. The raw
model counts them over all documents, the target model over labelled good ones. A document's log weight is the log of
the ratio of the two models' probabilities of it: the sum of its n-grams' log ratios. With ``per_gram`` it is their mean
times that number instead, so that length does not decide. Adding Gumbel noise and taking the k largest samples without
replacement in proportion to the weights.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from logweir.llm.common import WORDS_OF_BYTES, bytes_of, copies_numbered, map_texts, slices, stored, with_row

# Buckets of the models: about GROWTH times the square root of the corpus's bytes, as vocabularies grow, a power of two
# between these bounds. The driver and each task hold one number per bucket.
LEAST_BUCKETS, MOST_BUCKETS, GROWTH = 1 << 16, 1 << 22, 12
SMOOTHING = 1.0
# The target model is fitted on this many labelled documents at most, chosen by hash of the key.
TARGET_DOCS = 20_000
PAIR = np.uint64(0x9E3779B97F4A7C15)


def buckets_for(size: int) -> int:
    """How many buckets the models of a corpus of so many bytes have."""
    return min(MOST_BUCKETS, max(LEAST_BUCKETS, 1 << round(np.log2(max(1.0, GROWTH * size ** 0.5)))))


class Features:
    """Buckets of the n-grams of texts; remembers words' hashes, up to a bound."""

    def __init__(self, buckets: int):
        self.known: dict[bytes, int] = {}
        self.shift = np.uint64(64 - buckets.bit_length() + 1)

    def of(self, text: bytes) -> np.ndarray:
        if len(self.known) > 500_000:
            self.known.clear()
        known, digest = self.known, xxhash.xxh3_64_intdigest
        words = WORDS_OF_BYTES(text.lower())
        for w in set(words).difference(known):
            known[w] = digest(w)
        one = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        two = (one[:-1] * PAIR) ^ one[1:]
        return (np.r_[one, two * PAIR] >> self.shift).astype(np.int64)


def counts(docs: DataFrame, text: str, target: str, buckets: int) -> DataFrame:
    """(bucket, raw, target): n-grams of all documents, and of those with a true ``target`` column."""

    def run(batches):
        features, raw, good = Features(buckets), np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, text):
                for data, is_target in zip(bytes_of(part.column(text)), part.column(target).to_pylist()):
                    at, n = np.unique(features.of(data), return_counts=True)
                    raw[at] += n
                    if is_target:
                        good[at] += n
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(good[at])], names=["bucket", "raw", "target"])

    parts = docs.select(text, target).mapInArrow(run, "bucket long, raw long, target long")
    return parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counted: DataFrame, buckets: int) -> np.ndarray:
    """Per bucket the log of the target's smoothed share over the raw one; the driver holds a number per bucket."""
    raw, target = np.zeros(buckets), np.zeros(buckets)
    found = counted.toArrow()
    at = found.column("bucket").to_numpy()
    raw[at], target[at] = found.column("raw").to_numpy(), found.column("target").to_numpy()
    share = [(x + SMOOTHING) / (x.sum() + SMOOTHING * buckets) for x in (target, raw)]
    return np.log(share[0] / share[1])


def weighted(docs: DataFrame, ratios: np.ndarray, keep: list[str], text: str, per_gram: float | None) -> DataFrame:
    """The columns ``keep`` and log_weight; 0 for a text without words."""
    holder: dict[str, Features] = {}

    def work(part: pa.RecordBatch) -> dict:
        features = holder.setdefault("it", Features(len(ratios)))
        found = [features.of(x) for x in bytes_of(part.column(text))]
        total = [float(ratios[x].sum()) for x in found]
        return {"log_weight": total if per_gram is None else [w * per_gram / len(x) if len(x) else 0.0 for w, x in zip(total, found)]}

    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    return map_texts(docs.select(*keep, text), text, work, ", ".join([*kinds, "log_weight double"]))


def top_k(scored: DataFrame, score: str, key: str, k: int) -> DataFrame:
    """``scored`` with a column kept, true in exactly ``k`` rows (or all): those of the largest scores, ties by key.

    The score where the cut lies is found by counting rows in bins of a 64th, then of 2 ** -30 within one of these;
    only the rows of the last bin are put in order. Bins, not rows, are summed in one task.
    """
    coarse = F.floor(F.col(score) * 64)
    fine = F.floor((F.col(score) * 64 - coarse) * (1 << 24))
    binned = scored.withColumns({"coarse": coarse, "fine": fine})
    above = W.orderBy(F.col("bin").desc()).rowsBetween(W.unboundedPreceding, W.currentRow)

    def cut(rows: DataFrame, name: str, wanted: int) -> tuple[int | None, int]:
        """The bin in which the wanted number is reached, and how many to take of it."""
        bins = rows.groupBy(F.col(name).alias("bin")).agg(F.count("*").alias("n"))
        found = bins.select("bin", "n", F.sum("n").over(above).alias("upto")).where(F.col("upto") >= wanted).orderBy(F.col("bin").desc()).first()
        return (None, 0) if found is None else (found["bin"], wanted - (found["upto"] - found["n"]))

    if k <= 0:
        return scored.withColumn("kept", F.lit(False))
    at, rest = cut(binned, "coarse", k)
    if at is None:
        return scored.withColumn("kept", F.lit(True))
    inner, rest = cut(binned.where(F.col("coarse") == at), "fine", rest)
    edge = (F.col("coarse") == at) & (F.col("fine") == inner)
    higher = (F.col("coarse") > at) | ((F.col("coarse") == at) & (F.col("fine") > inner))
    others = binned.where(~edge).withColumn("kept", higher)
    order = W.partitionBy("coarse", "fine").orderBy(F.col(score).desc(), F.col(key))
    last = binned.where(edge).withColumn("kept", F.row_number().over(order) <= rest)
    return others.unionByName(last).drop("coarse", "fine")


def resampled(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", quality: str = "quality",
              share: float | None = None, salt: int = 0, per_gram: float | None = None) -> DataFrame:
    """One row per document: key, log_weight, sample_key (with the noise), kept.

    ``labels`` (key, quality 0 or 1) gives the target documents; ``share`` of all documents is kept, by default the
    share of good ones among the labels (all if there are none). The noise is drawn from a hash of key, text, ``salt``
    and the row's number among equal ones, so a rerun gives the same sample and equal rows have noise of their own. A
    NULL text has no words and weight 0; NULL keys are never targets; repeated rows are scored alike and taken one by one.
    """
    good = labels.where(F.col(quality) == 1).select(F.col(key).alias("target_key")).where("target_key IS NOT NULL").distinct()
    # At most TARGET_DOCS keys: the bound that makes the broadcast safe.
    chosen = F.broadcast(good.orderBy(F.xxhash64("target_key"), "target_key").limit(TARGET_DOCS))
    numbered, row = with_row(docs.select(F.col(key).alias("key"), F.col(text).alias("text")))
    marked = numbered.join(chosen, F.col("key") == F.col("target_key"), "left").select("text", F.col("target_key").isNotNull().alias("target"))
    buckets = buckets_for(numbered.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    ratios = log_ratios(counts(marked, "text", "target", buckets), buckets)
    signed = numbered.select("key", F.col(row).alias("row"), F.xxhash64("text").alias("sign"), "text")
    weighed = stored(weighted(signed, ratios, ["key", "row", "sign"], "text", per_gram), "importance-weights")
    each = copies_numbered(weighed, ["key", "sign"], "row")
    # 52 bits and a half: strictly between 0 and 1 as a double.
    even = (F.xxhash64("key", "sign", "nth", F.lit(salt)).bitwiseAND((1 << 52) - 1) + 0.5) / float(1 << 52)
    scored = stored(each.select("key", "log_weight", (F.col("log_weight") - F.log(-F.log(even))).alias("sample_key")), "importance")
    if share is None:
        share = labels.agg(F.avg(quality)).first()[0]
    n = scored.count()
    return top_k(scored, "sample_key", "key", n if share is None else round(share * n))
