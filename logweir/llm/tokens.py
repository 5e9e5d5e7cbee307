"""Token counts per section of a text: each document encoded once, tokens attributed by their character spans.

Byte-level tokens put one after the other are the text's bytes, so their lengths give their spans. A token that crosses
a section's end goes to one section by an explicit rule: "first" gives it to the section of its first character,
"most" to the one that holds most of its characters (the earlier of equal ones).
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from logweir.llm.common import bytes_of, slices

RULES = ("first", "most")
# How the vocabulary's texts are cut before their bytes are merged (a fixed value of the vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# White space of the pattern; from so many characters on it is cut out before the pattern sees the text: it looks ahead
# from each of them and overflows the stack on very long runs.
SPACES = "[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
LONG_RUN = 1000


def encoded(text: str, encode: Callable[[str], list[int]], merge: Callable[[str], list[int]], long_run: int = LONG_RUN) -> list[int]:
    """The tokens of a text. ``encode`` cuts by the pattern and merges, ``merge`` merges without cutting.

    By the pattern a run of white space is one piece, but its last character goes on with what follows; so a long run is
    merged by itself, and what ``encode`` gets begins with that character. The tokens are the same for every ``long_run``.
    """
    tokens, done = [], 0
    for run in re.finditer(f"{SPACES}{{{long_run},}}", text):
        stop = run.end() - (run.end() < len(text))
        tokens += encode(text[done:run.start()]) + merge(text[run.start():stop])
        done = stop
    return tokens + encode(text[done:])


def load_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file: a token in base 64 and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def line_starts(data: bytes) -> np.ndarray:
    """Where the lines of a text start, in bytes; a line holds its line feed."""
    breaks = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
    return np.r_[0, breaks[breaks < len(data)]] if data.endswith(b"\n") else np.r_[0, breaks]


def attributed(data: bytes, sizes: np.ndarray, starts: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per section: its start in code points, its tokens, and how many of these reach beyond it.

    ``sizes``: bytes of the tokens. ``starts``: bytes at which sections start, the first 0.
    """
    letters = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    char_of = np.r_[0, np.cumsum(letters)]  # characters that begin before a byte
    ends = np.cumsum(sizes)
    first = char_of[np.minimum(ends - sizes + 1, len(data))] - 1 if len(sizes) else np.zeros(0, np.int64)
    last = char_of[ends] - 1  # the character that holds the token's last byte
    limits = char_of[starts]
    a, b = np.searchsorted(limits, first, "right") - 1, np.searchsorted(limits, last, "right") - 1
    home = a.copy()
    if rule == "most":
        for t in np.flatnonzero(b > a).tolist():
            edges = np.clip(np.r_[limits[a[t]:b[t] + 1], last[t] + 1], first[t], last[t] + 1)
            home[t] = a[t] + int(np.argmax(np.diff(edges)))
    n = len(starts)
    return limits, np.bincount(home, minlength=n), np.bincount(home[b > a], minlength=n)


def section_tokens(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", rule: str = "first") -> DataFrame:
    """One row per document and line: key, section (from 0), start, n_chars (code points, the line feed included), n_tokens, n_crossing.

    The n_tokens of a document's sections add up to those of the whole text; n_crossing of them reach into another
    section. An empty or NULL text has one empty section. ``vocabulary``: path of a file of byte-level BPE ranks, read by
    the driver and sent with the job (bounded by the file). Repeated rows give repeated rows; other columns are not read.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    ranks = load_ranks(vocabulary)
    kind = docs.schema[key].dataType

    def run(batches):
        import tiktoken

        encode, merge = (tiktoken.Encoding("ranks", pat_str=p, mergeable_ranks=ranks, special_tokens={}).encode_ordinary for p in (PATTERN, r"(?s).+"))
        width = np.zeros(max(ranks.values()) + 1, np.int64)
        width[list(ranks.values())] = list(map(len, ranks))
        for batch in batches:
            for part in slices(batch, text):
                rows, columns = [], ([], [], [], [], [])
                for k, data in enumerate(bytes_of(part.column(text))):
                    sizes = width[np.array(encoded(data.decode(), encode, merge), np.int64)]
                    starts, tokens, crossing = attributed(data, sizes, line_starts(data), rule)
                    total = int(((np.frombuffer(data, np.uint8) & 0xC0) != 0x80).sum())
                    rows += [k] * len(starts)
                    for c, x in zip(columns, (np.arange(len(starts)), starts, np.diff(np.r_[starts, total]), tokens, crossing)):
                        c.append(x)
                if rows:
                    arrays = [pa.array(np.concatenate(c).astype(np.int64)) for c in columns]
                    yield pa.RecordBatch.from_arrays([part.column(key).take(pa.array(rows)), *arrays],
                                                     names=[key, "section", "start", "n_chars", "n_tokens", "n_crossing"])

    return docs.select(key, text).mapInArrow(
        run, f"`{key}` {kind.simpleString()}, section long, start long, n_chars long, n_tokens long, n_crossing long")
