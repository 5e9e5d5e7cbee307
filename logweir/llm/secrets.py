"""Secrets in texts, DataFrame functions only: base patterns, and weak candidates that complementary parts confirm.

A short password, a lone user name or an address says little; close together they are a credential. Identifiers, weak
secrets and endpoints are joined by interval within a scope of SCOPE code points: a weak secret is reported with an
identifier in scope, an identifier with a secret (weak or base) in scope, an endpoint with both.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from logweir.llm.common import stored, with_row

SCOPE = 200

# Kinds in the order in which spans with the same start are listed.
KINDS = ("assign", "access", "hex", "weak", "identifier", "endpoint")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LENGTH = 12
WEAK_LENGTH = 4
# Runs of 18 and 16 characters or more: a run that is too short has no other match inside it.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
WEAK = r"""(?i:pwd|pass|credential|private_?key|auth)["']?\x20*[:=]\x20*["']?([^\x20\x09-\x0D"',;]{4,})"""
IDENTIFIER = r"""(?i:user(?:_?name|_?id)?|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._+-]{3,})"""
ENDPOINT = r"""(?i:https?|ftp|sftp|ssh|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://([^\x20\x09-\x0D"'<>]+)"""


def _matches(text: Column, kind: str, pattern: str) -> Column:
    """Leftmost non-overlapping matches: kind, number, step (code points from the last match's end to this one's), size,
    and the length of the pattern's group if it has one.

    Each match is taken together with the text since the one before; \\G keeps the search from starting anew behind the
    last match.
    """
    whole = F.lit(rf"(?s)\G(.*?)({pattern})")
    groups = 3 if re.search(r"\((?!\?)", pattern) else 2
    both, hit, inner = (F.regexp_extract_all(text, whole, F.lit(g)) for g in (0, 2, groups))
    sizes = F.arrays_zip(F.transform(both, F.length).alias("step"), F.transform(hit, F.length).alias("size"), F.transform(inner, F.length).alias("length"))
    return F.transform(sizes, lambda s, i: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), i.alias("no"), s["step"].alias("step"), s["size"].alias("size"), s["length"].alias("length")))


def _candidates(text: Column) -> Column:
    """All matches of a text; a pattern runs only where a part that it needs occurs."""
    none = F.array().cast("array<struct<kind:int,no:int,step:int,size:int,length:int>>")
    paired, linked = text.contains("=") | text.contains(":"), text.contains("://")

    def found(kind: str, pattern: str, where: Column) -> Column:
        return F.when(where & text.rlike(pattern), _matches(text, kind, pattern)).otherwise(none)

    return F.concat(found("assign", ASSIGN, paired), found("access", ACCESS, text.contains("AKIA")), found("hex", HEX, F.lit(True)),
                    found("weak", WEAK, paired), found("identifier", IDENTIFIER, paired), found("endpoint", ENDPOINT, linked))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, by start, then kind, comma-joined; spans: array of struct (start, kind, end)."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _linked(parts: DataFrame, scope: int) -> DataFrame:
    """The weak parts that have their complement in scope: row, kind, start, end."""
    kind = F.col("kind")
    role = F.when(kind == KINDS.index("endpoint"), "endpoint").when(
        kind.isin(KINDS.index("identifier"), KINDS.index("access")), "identifier").otherwise("secret")
    parts = parts.withColumns({"role": role, "stretch": (F.col("start") / scope).cast("int")})
    # First and last place of each role in a stretch: one of them is the nearest to any part of the stretches beside it.
    held = parts.groupBy("row", "stretch").agg(*[
        f(F.when(F.col("role") == r, F.col("start"))).alias(f"{n}_{r}") for r in ("identifier", "secret") for n, f in (("first", F.min), ("last", F.max))])
    weak = parts.where(kind >= KINDS.index("weak"))
    near_by = weak.select("row", "kind", "start", "end", "role", F.explode(F.array(*[F.col("stretch") + d for d in (-1, 0, 1)])).alias("stretch"))

    def near(r: str) -> Column:
        close = [F.abs(F.col(f"{n}_{r}") - F.col("start")) <= scope for n in ("first", "last")]
        return (F.col("role") != r) & (close[0] | close[1])

    flags = near_by.join(held, ["row", "stretch"]).groupBy("row", "kind", "start", "end", "role").agg(*[
        F.max(F.coalesce(near(r), F.lit(False))).alias(r) for r in ("identifier", "secret")])
    return flags.where(F.expr("""CASE role WHEN 'secret' THEN identifier WHEN 'identifier' THEN secret ELSE identifier AND secret END""")).select(
        "row", "kind", "start", "end")


def secret_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per document: key, base and linked, both arrays of spans (start, kind, end; code points, end exclusive).

    base: assignments of 12 characters or more, access identifiers of 18 or more, hex runs of 16 or more. linked: weak
    secrets (4 characters or more), identifiers and endpoints with their complement in scope. NULL texts have none.
    ``docs`` must be read from stored files; repeated rows are looked at one by one. Parts meet only in neighbouring
    stretches of a text, reduced to two places each, so a text's spans are never all paired.
    """
    numbered, row = with_row(docs)
    found = stored(numbered.select(F.col(key).alias("key"), F.col(row).alias("row"), _candidates(F.coalesce(F.col(text), F.lit(""))).alias("found")), "secret-candidates")
    upto = W.partitionBy("row", "kind").orderBy("no").rowsBetween(W.unboundedPreceding, 0)
    each = found.select("row", F.inline("found")).withColumn("end", F.sum("step").over(upto).cast("int"))
    short = (F.col("kind") == KINDS.index("assign")) & (F.col("length") < ASSIGN_LENGTH)
    spans = stored(each.where((F.col("kind") != KINDS.index("assign")) | (F.col("length") >= WEAK_LENGTH)).select("row", F.when(short, KINDS.index("weak")).otherwise(F.col("kind")).alias("kind"),
                                                    (F.col("end") - F.col("size")).alias("start"), "end"), "secret-spans")
    span, base = F.struct("start", "kind", "end"), F.col("kind") < KINDS.index("weak")
    all_ = spans.where(base).select("row", span.alias("base"), F.lit(None).cast("struct<start:int,kind:int,end:int>").alias("linked")).union(
        _linked(spans, scope).select("row", F.lit(None).cast("struct<start:int,kind:int,end:int>"), span))
    by_row = all_.groupBy(F.col("row").alias("span_row")).agg(F.collect_list("base").alias("base"), F.collect_list("linked").alias("linked"))
    joined = found.select("key", "row").join(by_row, F.col("row") == F.col("span_row"), "left")
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return joined.select("key", F.coalesce("base", none).alias("base"), F.coalesce("linked", none).alias("linked"))
