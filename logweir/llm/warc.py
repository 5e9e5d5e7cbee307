"""WARC records, and a Merkle audit of replicas.

Records are laid into files in order; a file's index gives each record's offset. A tree over a replica of a file has
the SHA-256 of the records at the bottom, above them nodes for ranges of RANGE bytes by the records' offsets, and nodes
for FANOUT ranges each up to the file's root. Replicas with equal roots are equal; otherwise only the children of
differing nodes are compared, down to the records. Nodes are keyed by file and range, so a file's size sets no bound on
a task: a node has at most FANOUT children, a range at most RANGE bytes of record starts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from logweir.llm.common import copies_numbered, free_name, stored, with_row

RANGE = 1 << 16
FANOUT = 16
RECORDS_PER_FILE = 1000
# First letters of a digest by which records of one number are dealt: 65,536 parts.
PREFIX = 4


def record(url: Column, number: Column, body: Column) -> Column:
    """A response record's bytes: header, body, two line ends."""
    data = F.coalesce(body, F.lit("")).cast("binary")
    header = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(number.cast("string"), F.lit("")),
        F.lit(">\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(data).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(header.cast("binary"), data, F.lit("\r\n\r\n").cast("binary"))


def laid_out(records: DataFrame, number: str, size: str, per_file: int = RECORDS_PER_FILE) -> DataFrame:
    """``records`` with columns file and offset: ``per_file`` numbers to a file, in order of number, then content.

    NULL numbers form a file of their own. Any file, number or content may hold a large share of all records: sizes are
    added up per number, per first letters of the digest, per content and per copy, each within the one before, and no
    task sees more than the parts of one step.
    """
    numbered, row = with_row(records)
    file, prefix = F.coalesce(F.floor(F.col(number) / per_file), F.lit(-1)).cast("long"), F.substring("digest", 1, PREFIX)
    names = {"file": "file", **{n: free_name(numbered, n) for n in ("prefix", "nth")}}
    rows = stored(copies_numbered(numbered.withColumns({"file": file, names["prefix"]: prefix}), ["file", number, "digest", size], row, names["nth"]), "warc-numbered")
    content = [number, names["prefix"], "digest", size]
    groups = stored(rows.groupBy("file", *content).agg((F.count("*") * F.coalesce(F.col(size), F.lit(0))).alias("all_bytes")), "warc-contents")
    places = groups
    # From the coarsest step to the finest: bytes of what comes earlier within the step above.
    for depth, steps in enumerate(([number], [names["prefix"]], ["digest", size])):
        above = ["file", *content[:depth]]
        sums = groups.groupBy(*above, *steps).agg(F.sum("all_bytes").alias("all_bytes"))
        earlier = W.partitionBy(*above).orderBy(*steps).rowsBetween(W.unboundedPreceding, -1)
        sums = sums.select(*[F.col(c).alias(f"at_{c}") for c in (*above, *steps)], F.coalesce(F.sum("all_bytes").over(earlier), F.lit(0)).alias(f"before_{depth}"))
        on = [places[c].eqNullSafe(sums[f"at_{c}"]) for c in (*above, *steps)]
        places = places.join(sums, on, "left").drop(*[f"at_{c}" for c in (*above, *steps)])
    start = sum((F.col(f"before_{depth}") for depth in range(3)), F.lit(0))
    places = stored(places.select(*[F.col(c).alias(f"at_{c}") for c in ("file", *content)], start.alias("start")), "warc-places")
    joined = rows.join(places, [rows[c].eqNullSafe(places[f"at_{c}"]) for c in ("file", *content)])
    offset = (F.col("start") + F.col(names["nth"]) * F.coalesce(F.col(size), F.lit(0))).cast("long")
    return joined.select(*records.columns, "file", offset.alias("offset"))


def _parents(level: DataFrame) -> DataFrame:
    """The level above: nodes of FANOUT ranges."""
    parts = level.groupBy("file", F.floor(F.col("node") / FANOUT).alias("parent")).agg(F.array_sort(F.collect_list(F.struct("node", "digest"))).alias("parts"))
    text = F.array_join(F.transform("parts", lambda x: F.concat_ws(":", x["node"].cast("string"), x["digest"])), "\n")
    return parts.select("file", F.col("parent").alias("node"), F.sha2(text, 256).alias("digest"))


def tree(records: DataFrame) -> list[DataFrame]:
    """Levels of (file, node, digest) from the records' ranges up to one node per file; records: file, offset, length, digest.

    A record that a replica lacks has a NULL digest, or no row. Each level is stored: the one above and the audit read it.
    """
    leaf = F.struct("offset", "length", F.coalesce("digest", F.lit("")).alias("digest"))
    text = lambda x: F.concat_ws(":", x["offset"].cast("string"), x["length"].cast("string"), x["digest"])
    levels = [stored(records.groupBy("file", F.floor(F.col("offset") / RANGE).alias("node")).agg(F.array_sort(F.collect_list(leaf)).alias("all")).select(
        "file", "node", F.sha2(F.array_join(F.transform("all", text), "\n"), 256).alias("digest")), "warc-level")]
    top = records.agg(F.max(F.floor(F.col("offset") / RANGE))).first()[0] or 0
    while top:
        levels.append(stored(_parents(levels[-1]), "warc-level"))
        top //= FANOUT
    return levels


def _differing(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose digests differ, or that one side lacks."""
    left, right = a.select(*keys, F.col("digest").alias("a")), b.select(*keys, F.col("digest").alias("b"))
    return left.join(right, keys, "full").where(~F.col("a").eqNullSafe(F.col("b"))).select(*keys)


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """Records in which two replicas differ: file, offset, first_digest, second_digest (NULL: not there).

    Both have columns file, offset, length, digest and come from stored tables. Equal roots end the work on a file; below a differing
    node only its children are joined.
    """
    a, b = tree(first), tree(second)
    # A replica that ends earlier has a lower tree; its top is carried up to the same height.
    while len(a) != len(b):
        low = a if len(a) < len(b) else b
        low.append(stored(_parents(low[-1]), "warc-level"))
    bad = stored(_differing(a[-1], b[-1], ["file", "node"]), "warc-differing")
    for x, y in zip(a[-2::-1], b[-2::-1]):
        parents = bad.select("file", F.col("node").alias("parent"))
        under = [t.join(parents, (t["file"] == parents["file"]) & (F.floor(t["node"] / FANOUT) == parents["parent"]), "left_semi") for t in (x, y)]
        bad = stored(_differing(*under, ["file", "node"]), "warc-differing")
    ranges = bad.select("file", F.col("node").alias("range"))
    under = [t.join(ranges, (t["file"] == ranges["file"]) & (F.floor(t["offset"] / RANGE) == ranges["range"]), "left_semi") for t in (first, second)]
    left = under[0].select("file", "offset", "length", F.col("digest").alias("first_digest"))
    right = under[1].select("file", "offset", F.col("length").alias("other_length"), F.col("digest").alias("second_digest"))
    same = left.join(right, ["file", "offset"], "full").where(
        ~F.col("first_digest").eqNullSafe(F.col("second_digest")) | ~F.col("length").eqNullSafe(F.col("other_length")))
    return same.select("file", "offset", F.coalesce("length", "other_length").alias("length"), "first_digest", "second_digest")
