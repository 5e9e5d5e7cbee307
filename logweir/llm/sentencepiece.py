"""SentencePiece encoding and decoding by batched Viterbi in numpy.

The distinct words of a batch (a run of spaces and what follows, up to the next space) are encoded once. Words of equal
length advance together, one end position after the other: the hashes of the substrings that end there are looked up
in the sorted hashes of the pieces, each candidate is scored, the maximum over its lengths is kept with a backpointer,
and the pointers are walked back at the end.

Scores. A unigram model adds up the pieces' scores. A BPE model's scores are ranks of merges, and sums of them mean
nothing; there a candidate scores 0 if merging would leave the last piece before it and itself side by side, and minus
infinity if not. Every prefix of a word has exactly one last piece with score 0, so the maximum is the segmentation
that merging by rank gives, and the ids equal those of the SentencePiece library.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from logweir.llm.common import map_texts, texts_of

SPACE = "▁"
UNITS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+").findall
BASE = np.uint64(0x9E3779B97F4A7C15)
# Words longer than this are encoded one by one; a task remembers about this many words.
LONG = 64
# Bytes of text encoded at once: the more, the fewer and larger the groups of words that advance together.
SLICE = 4 << 20
REMEMBERED = 250_000
# Leading bits that say whether a hash can be a key, and those that say where to look: tables that fit a core's cache.
FILTER_BITS, PLACE_BITS = 19, 18


@dataclass
class Vocabulary:
    """A SentencePiece model's pieces, as arrays. ``ranks`` and the tables after it are for BPE models."""

    pieces: list[str]
    scores: np.ndarray
    plain: np.ndarray
    bytes_first: int
    dummy_prefix: bool
    keys: np.ndarray
    ids: np.ndarray
    longest: int
    ranks: np.ndarray | None = None
    left: np.ndarray | None = None
    right: np.ndarray | None = None
    odd: np.ndarray | None = None
    pair_keys: np.ndarray | None = None
    pair_ranks: np.ndarray | None = None

    @property
    def bpe(self) -> bool:
        return self.ranks is not None


def hashes_of(words: list[str]) -> np.ndarray:
    """Hashes of the prefixes of words of equal length, the empty one first: [length + 1, n]."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1).T.astype(np.uint64, order="C")
    out = np.zeros((len(codes) + 1, len(words)), np.uint64)
    for j, column in enumerate(codes):
        out[j + 1] = out[j] * BASE + column + np.uint64(1)
    return out


def vocabulary(pieces: list[str], scores: list[float], kinds: list[str], bpe: bool, dummy_prefix: bool = True) -> Vocabulary:
    """``kinds``: per piece "plain", "byte" or "other" (control, unknown, unused). All 256 byte pieces must be there, in order."""
    plain = np.array([k == "plain" for k in kinds])
    found = [i for i, k in enumerate(kinds) if k == "byte"]
    if [pieces[i] for i in found] != [f"<0x{b:02X}>" for b in range(256)] or found[-1] - found[0] != 255:
        raise ValueError("the model must have its 256 byte pieces in a row")
    if not all(re.fullmatch(f"{SPACE}*[^{SPACE}]*", pieces[i]) for i in np.flatnonzero(plain)):
        raise ValueError("a piece has a space behind another character: words can't be encoded one by one")
    by_length: dict[int, list[int]] = {}
    for i in np.flatnonzero(plain).tolist():
        by_length.setdefault(len(pieces[i]), []).append(i)
    keys, ids = [], []
    for members in by_length.values():
        keys.append(hashes_of([pieces[i] for i in members])[-1])
        ids.append(np.array(members))
    keys, ids = np.concatenate(keys), np.concatenate(ids)
    if len(np.unique(keys)) < len(keys):
        raise ValueError("two pieces have the same hash")
    made = Vocabulary(pieces, np.array(scores), plain, found[0], dummy_prefix, keys, ids, max(by_length))
    return _with_merges(made) if bpe else made


def _with_merges(v: Vocabulary) -> Vocabulary:
    """The tables of a BPE model: for each piece its last merge, and the rank of each pair that can merge."""
    number = {v.pieces[i]: i for i in np.flatnonzero(v.plain).tolist()}
    if not {c for p in number for c in p} <= number.keys():
        raise ValueError("every character of a piece must be a piece")
    v.ranks = np.unique(-v.scores, return_inverse=True)[1].astype(np.int64)
    n = len(v.pieces)
    v.left, v.right, v.odd = np.arange(n), np.arange(n), np.zeros(n, bool)
    pairs: dict[int, int] = {}
    for p, i in number.items():
        for k in range(1, len(p)):
            a, b = number.get(p[:k]), number.get(p[k:])
            if a is not None and b is not None:
                pairs[a * n + b] = int(v.ranks[i])
    for p, i in sorted(number.items(), key=lambda x: len(x[0])):
        if len(p) > 1:
            last: list[tuple[int, int]] = []
            if merge_by_rank(p, number, v.ranks, last) != [i]:
                v.plain[i] = False  # merging never makes it
                continue
            v.left[i], v.right[i] = last[-1]
            # The rank of a merge must be above those it needs, else times of merges can't be told by rank.
            v.odd[i] = any(len(v.pieces[x]) > 1 and (v.ranks[x] >= v.ranks[i] or v.odd[x]) for x in last[-1])
    keys = np.array(list(pairs), np.int64)
    v.pair_keys, v.pair_ranks = keys, np.array(list(pairs.values()), np.int64)
    return v


def merge_by_rank(word: str, number: dict[str, int], ranks: np.ndarray, merges: list | None = None) -> list:
    """BPE by its definition: the neighbours of the best rank, leftmost first, are merged until none can be. Unknown characters stay as text."""
    symbols = list(word)
    while True:
        best = min(((ranks[number[a + b]], k) for k, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in number), default=None)
        if best is None:
            return [number.get(s, s) for s in symbols]
        k = best[1]
        if merges is not None:
            merges.append((number[symbols[k]], number[symbols[k + 1]]))
        symbols[k:k + 2] = [symbols[k] + symbols[k + 1]]


def load_model(path: str) -> Vocabulary:
    """The vocabulary of a model file of the SentencePiece library, whose normaliser must be the identity."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    kinds = ["byte" if model.is_byte(i) else "other" if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else "plain"
             for i in range(len(pieces))]
    probe = "ﬁ  Aé́ "
    prefixed = SPACE + probe.replace(" ", SPACE)
    if model.normalize(probe) not in (prefixed, prefixed[1:]):
        raise ValueError("only models without text normalisation")
    scores = [model.get_score(i) for i in range(len(pieces))]
    plain = [s for s, k in zip(scores, kinds) if k == "plain"]
    # A BPE model's scores are whole numbers, a merge's rank each; a unigram model's are log probabilities.
    return vocabulary(pieces, scores, kinds, all(float(s).is_integer() for s in plain), model.normalize(probe) == prefixed)


class Encoder:
    """Encodes and decodes texts with a vocabulary; remembers words."""

    def __init__(self, v: Vocabulary):
        self.v, self.n = v, len(v.pieces)
        self.number = {v.pieces[i]: i for i in np.flatnonzero(v.plain).tolist()}
        self.unknown = float(v.scores[v.plain].min()) - 10 if v.plain.any() else -10.0
        texts = [bytes([i - v.bytes_first]) if 0 <= i - v.bytes_first < 256 else p.replace(SPACE, " ").encode() if v.plain[i] or p in self.number else b""
                 for i, p in enumerate(v.pieces)]
        self.text = np.frombuffer(b"".join(texts), np.uint8)
        self.sizes = np.array(list(map(len, texts)), np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        made = v.plain[v.ids]
        self.piece_at = SortedKeys(v.keys[made], v.ids[made])
        self.pair_at = SortedKeys(v.pair_keys.astype(np.uint64), v.pair_ranks) if v.bpe else None
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.values: list[np.ndarray] = []
        self.counts: list[int] = []
        self.pairs: dict[tuple[int, int], bool] = {}

    # --- scores

    def side_by_side(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the text of the pieces a + b gives a, b again (a < 0: the word's start or an unknown character).

        The merges that made the two are undone, the latest first; at no time may the pieces that then touch have
        merged earlier than they were merged with others.
        """
        v, fine = self.v, np.ones(len(a), bool)
        at = (a >= 0).nonzero()[0]
        x, y = a.take(at), b.take(at)
        limit = np.full(len(at), np.iinfo(np.int64).max)
        while len(at):
            hit, rank = self.pair_at.find((x * self.n + y).view(np.uint64))
            whole_x, whole_y = v.left.take(x) == x, v.left.take(y) == y
            on = ~(whole_x & whole_y)
            if len(hit):
                clash = hit.compress(rank < limit.take(hit))
                fine[at.take(clash)] = False
                on[clash] = False
            on = on.nonzero()[0]
            at, x, y, whole_x, whole_y = at.take(on), x.take(on), y.take(on), whole_x.take(on), whole_y.take(on)
            # Of equal ranks the left merge came first, so the right one is undone first, and a tie across goes before it.
            rank_x, rank_y = v.ranks.take(x), v.ranks.take(y)
            undo_x = ~whole_x & (whole_y | (rank_x > rank_y))
            limit = np.where(undo_x, rank_x, rank_y + 1)
            x, y = np.where(undo_x, v.right.take(x), x), np.where(undo_x, y, v.left.take(y))
        return fine

    # --- words

    def viterbi(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words of equal length: their pieces in a row (an unknown character is -1), the number of each, and which are odd."""
        v, length, n = self.v, len(words[0]), len(words)
        prefix = hashes_of(words)
        powers = np.cumprod(np.full(v.longest, BASE, np.uint64))
        score = np.full((length + 1, n), -np.inf)
        score[0] = 0
        last = np.full((length + 1, n), -1, np.int64)
        step = np.ones((length + 1, n), np.int16)
        odd = np.zeros(n, bool)
        for j in range(1, length + 1):
            best = score[j]
            for k in range(min(j, v.longest), 0, -1):
                i = j - k
                at, found = self.piece_at.find(prefix[j] - prefix[i] * powers[k - 1])
                if k == 1 and len(at) < n:  # an unknown character stands alone
                    rest = np.ones(n, bool)
                    rest[at] = False
                    alone = score[i] + (0 if v.bpe else self.unknown)
                    rest &= alone > best
                    best[rest], last[j, rest], step[j, rest] = alone[rest], -1, 1
                if v.bpe:
                    strange = v.odd.take(found)
                    if strange.any():
                        odd[at[strange]] = True
                    # Once a row has its maximum, 0, no other candidate can have it.
                    on = (best.take(at) < 0).nonzero()[0]
                    at, found = at.take(on), found.take(on)
                    gain = np.where(self.side_by_side(last[i].take(at), found), score[i].take(at), -np.inf)
                else:
                    gain = score[i].take(at) + v.scores.take(found)
                better = (gain > best.take(at)).nonzero()[0]
                at = at.take(better)
                best[at], last[j, at], step[j, at] = gain.take(better), found.take(better), k
        back = np.full((n, length), -1, np.int64)
        counts, position, rows = np.zeros(n, np.int64), np.full(n, length), np.arange(n)
        while len(rows):
            back[rows, counts[rows]] = last[position[rows], rows]
            counts[rows] += 1
            position[rows] -= step[position[rows], rows]
            rows = rows[position[rows] > 0]
        order = counts[:, None] - 1 - np.arange(length)
        return np.take_along_axis(back, np.maximum(order, 0), 1)[order >= 0], counts, odd

    def viterbi_long(self, word: str) -> list[int]:
        """The same for one long word: all substrings looked up at once, then position by position over the few hits."""
        v, out = self.v, []
        for piece in self.cut(word):
            length = len(piece)
            prefix = hashes_of([piece])[:, 0]
            powers, hits = np.cumprod(np.full(v.longest, BASE, np.uint64)), [[] for _ in range(length + 1)]
            for k in range(1, min(length, v.longest) + 1):
                for i, p in zip(*map(np.ndarray.tolist, self.piece_at.find(prefix[k:] - prefix[:-k] * powers[k - 1]))):
                    hits[i + k].append((k, p))
            if v.bpe and any(v.odd[p] for h in hits for _, p in h):
                out += self.merged_long(piece)
                continue
            score, last, step = [0.0] + [-np.inf] * length, [-1] * (length + 1), [1] * (length + 1)
            for j in range(1, length + 1):
                if not hits[j] or hits[j][0][0] > 1:
                    score[j] = score[j - 1] + (0 if v.bpe else self.unknown)
                for k, p in hits[j]:
                    gain = score[j - k]
                    if v.bpe:
                        if gain > -np.inf and not self.touching(last[j - k], p):
                            gain = -np.inf
                    else:
                        gain += float(v.scores[p])
                    if gain > score[j]:
                        score[j], last[j], step[j] = gain, p, k
            back, j = [], length
            while j:
                back.append(last[j] if last[j] >= 0 else piece[j - 1])
                j -= step[j]
            out += back[::-1]
        return out

    def touching(self, a: int, b: int) -> bool:
        key = (a, b)
        if key not in self.pairs:
            if len(self.pairs) > REMEMBERED:
                self.pairs.clear()
            self.pairs[key] = bool(self.side_by_side(np.array([a]), np.array([b]))[0])
        return self.pairs[key]

    def cut(self, word: str) -> list[str]:
        """The word cut between characters that are next to each other in no piece: no piece can cross there."""
        if not hasattr(self, "bigrams"):
            self.bigrams = {p[i:i + 2] for p in self.number for i in range(len(p) - 1)}
        ends = [i for i in range(1, len(word)) if word[i - 1:i + 1] not in self.bigrams]
        return [word[i:j] for i, j in zip([0, *ends], [*ends, len(word)])]

    def merged_long(self, word: str) -> list:
        """Merging by rank with a heap, for long words with pieces whose times can't be told by rank (runs of spaces)."""
        import heapq

        symbols: list[str | None] = list(word)
        after, before = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
        heap: list[tuple[int, int, str]] = []

        def offer(k: int) -> None:
            if after[k] < len(symbols):
                text = symbols[k] + symbols[after[k]]
                if text in self.number:
                    heapq.heappush(heap, (int(self.v.ranks[self.number[text]]), k, text))

        for k in range(len(symbols) - 1):
            offer(k)
        while heap:
            _, k, text = heapq.heappop(heap)
            if symbols[k] is None or after[k] >= len(symbols) or symbols[k] + symbols[after[k]] != text:
                continue
            gone = after[k]
            symbols[k], symbols[gone], after[k] = text, None, after[gone]
            if after[k] < len(symbols):
                before[after[k]] = k
            offer(k)
            if before[k] >= 0:
                offer(before[k])
        return [self.number.get(s, s) for s in symbols if s is not None]

    def learn(self, words: list[str]) -> None:
        """Encode words that aren't known yet."""
        groups: dict[int, list[str]] = {}
        for w in words:
            groups.setdefault(len(w), []).append(w)
        for length, members in groups.items():
            if length > LONG:
                for w in members:
                    self.remember([w], [self.spelled(w, self.viterbi_long(w))])
                continue
            flat, counts, odd = self.viterbi(members)
            ends = np.cumsum(counts)
            unknown = np.diff(np.r_[0, np.cumsum(flat < 0)][np.r_[0, ends]]) > 0
            special = np.flatnonzero(unknown | odd)
            plain = np.ones(len(members), bool)
            plain[special] = False
            self.remember([w for w, p in zip(members, plain.tolist()) if p], [flat[np.repeat(plain, counts)]], counts[plain])
            for k in special.tolist():
                w = members[k]
                found = merge_by_rank(w, self.number, self.v.ranks) if odd[k] else flat[ends[k] - counts[k]:ends[k]].tolist()
                self.remember([w], [self.spelled(w, found)])

    def spelled(self, word: str, found: list) -> np.ndarray:
        """Ids of a word's pieces, unknown characters (-1, or the character) as their bytes."""
        ids, at = [], 0
        for p in found:
            if isinstance(p, str) or p < 0:
                ids += [self.v.bytes_first + b for b in word[at].encode()]
                at += 1
            else:
                ids.append(p)
                at += len(self.v.pieces[p])
        return np.array(ids, np.int32)

    def remember(self, words: list[str], values: list[np.ndarray], counts: np.ndarray | None = None) -> None:
        self.known.update(zip(words, range(len(self.counts), len(self.counts) + len(words))))
        self.values += [x.astype(np.int32) for x in values]
        self.counts += counts.tolist() if counts is not None else [len(values[0])]

    # --- texts

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of ids of each text."""
        if len(self.known) > REMEMBERED:
            self.forget()
        prefix = SPACE if self.v.dummy_prefix else ""
        units = [UNITS(prefix + t.replace(" ", SPACE)) if t else [] for t in texts]
        flat_units = list(chain.from_iterable(units))
        new = set(flat_units).difference(self.known)
        if new:
            self.learn(list(new))
        words = np.fromiter(map(self.known.__getitem__, flat_units), np.int64, len(flat_units))
        counts = np.array(self.counts, np.int64)
        flat = np.concatenate(self.values) if self.values else np.zeros(0, np.int32)
        ids = _gather(flat, (np.cumsum(counts) - counts)[words], counts[words])
        per_word = np.r_[0, np.cumsum(counts[words])]
        ends = np.cumsum([len(us) for us in units], dtype=np.int64)
        return ids, np.diff(per_word[np.r_[0, ends]])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of rows of ids: pieces and bytes put together, the leading space that encoding put in front removed."""
        sizes = self.sizes[ids]
        data = _gather(self.text, self.starts[ids], sizes).tobytes()
        ends = np.r_[0, np.cumsum(sizes)][np.r_[0, np.cumsum(counts)]].tolist()
        texts = [data[i:j].decode("utf-8", "replace") for i, j in zip(ends, ends[1:])]
        return [t[1:] if self.v.dummy_prefix and t.startswith(" ") else t for t in texts]


class SortedKeys:
    """Distinct 64-bit hashes, multiplied to spread them and sorted, probed from where their leading bits begin."""

    def __init__(self, hashes: np.ndarray, values: np.ndarray):
        keys = hashes * BASE  # one to one: BASE is odd
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        self.maybe = np.zeros(1 << FILTER_BITS, bool)
        self.maybe[self.keys >> np.uint64(64 - FILTER_BITS)] = True
        lead = self.keys >> np.uint64(64 - PLACE_BITS)
        self.first = np.searchsorted(lead, np.arange(1 << PLACE_BITS, dtype=np.uint64)).astype(np.int32)
        self.most = int(np.bincount(lead.astype(np.int64)).max(initial=0)) if len(keys) else 0

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in ``hashes`` the keys stand, and their values."""
        hashes = hashes * BASE
        likely = self.maybe.take((hashes >> np.uint64(64 - FILTER_BITS)).view(np.int64)).nonzero()[0]
        wanted = hashes.take(likely)
        at = self.first.take((wanted >> np.uint64(64 - PLACE_BITS)).view(np.int64))
        for _ in range(self.most - 1):  # on to the first key that is not smaller
            at = at + (self.keys.take(at, mode="clip") < wanted)
        hit = (self.keys.take(at, mode="clip") == wanted).nonzero()[0]
        return likely.take(hit), self.values.take(at.take(hit))


def _gather(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` one after the other."""
    total = int(counts.sum())
    if not total:
        return flat[:0]
    shift = np.repeat(starts - (np.cumsum(counts) - counts), counts)
    return flat[shift + np.arange(total)]


def encoded(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: key, the columns ``keep``, n_tokens, token_ids, exact (decoding gives the text again).

    ``model``: path of a model file, read by the driver; executors get its pieces with the job (bounded by the model).
    A NULL text is encoded as the empty one: no ids. A text with the character U+2581 itself, which the format uses for
    spaces, is encoded but not exact. Repeated rows give repeated rows; other columns are not read.
    """
    vocabulary_ = load_model(model)
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in (key, *keep))
    holder: dict[str, Encoder] = {}

    def work(part: pa.RecordBatch) -> dict:
        if not holder:
            holder["it"] = Encoder(vocabulary_)
        encoder = holder["it"]
        texts = texts_of(part.column(text))
        ids, counts = encoder.encode(texts)
        decoded = encoder.decode(ids, counts)
        offsets = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))
        return {"n_tokens": pa.array(counts.astype(np.int64)), "token_ids": pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))),
                "exact": [a == b for a, b in zip(texts, decoded)]}

    return map_texts(docs.select(key, *keep, text), text, work, f"{kinds}, n_tokens long, token_ids array<int>, exact boolean", SLICE)


def decoded(rows: DataFrame, model: str, key: str = "doc_id", ids: str = "token_ids") -> DataFrame:
    """(key, text) of rows of ids; NULL ids give a NULL text."""
    vocabulary_ = load_model(model)
    kind = rows.schema[key].dataType.simpleString()

    def run(batches):
        encoder = Encoder(vocabulary_)
        for batch in batches:
            found = batch.column(1).to_pylist()
            flat = np.array([i for x in found for i in x or []], np.int64)
            texts = encoder.decode(flat, np.array([len(x or []) for x in found], np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([t if x is not None else None for t, x in zip(texts, found)], pa.string())], names=[key, "text"])

    return rows.select(key, ids).mapInArrow(run, f"`{key}` {kind}, text string")
