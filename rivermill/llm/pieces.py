"""SentencePiece (BPE models) encoding by suffix-array matching, and decoding.

A task joins the segments of its texts that it has not met yet into one batch text and sorts its suffixes as deep as the
longest piece. Every piece of the vocabulary is binary-searched in that array; its occurrence range gives the edges of
the lattice. Edges are sorted by where they end and relaxed in that order: an edge holds if the token before it
and its own piece would stay apart when merged by rank, which is true of exactly one edge at every place, the last
token of the model's own encoding up to there. So the ids are those of the model, without replaying its merges.

Spaces are written as the mark, one leads every text, and no piece crosses from a character into a mark or a line
break; segments cut there are encoded once per task and looked up afterwards. Characters outside the vocabulary become
byte pieces (or the unknown id). A null or empty text has no ids; null counts as empty when compared. A mark inside a
text decodes as a space, as in the model. The model must not normalise texts and must prepend a space.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

MARK = "▁"
#: Characters of texts encoded together, and segments remembered by a task; both bound its memory.
BATCH_CHARS = 2 << 20
REMEMBERED = 250_000
#: Characters packed into one sort key; codes have 12 bits.
PACKED, CODE_BITS = 5, 12
NONE = np.int64(1) << 40


@dataclass(frozen=True)
class Vocabulary:
    """Pieces by id with their scores; `kinds`: n normal, b byte, c control, u unknown."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: str

    @staticmethod
    def load(path: str) -> Vocabulary:
        """Reads a model file on the driver; the vocabulary is what tasks get."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        kind = lambda i: "b" if model.is_byte(i) else "c" if model.is_control(i) else "u" if model.is_unknown(i) else "n"
        return Vocabulary(tuple(map(model.id_to_piece, ids)), tuple(map(model.get_score, ids)), "".join(map(kind, ids)))


class Encoder:
    """Tables of one vocabulary, and the segments met so far.

    Nodes: 0 any character without a piece, then characters, then longer pieces in the order in which they merge. A node's number
    thus tells which of two was formed later.
    """

    def __init__(self, vocabulary: Vocabulary):
        v = vocabulary
        normal = [i for i, kind in enumerate(v.kinds) if kind == "n"]
        runs = {i for i in normal if len(v.pieces[i]) > 1 and not v.pieces[i].strip(MARK)}
        chars = [i for i in normal if len(v.pieces[i]) == 1]
        longer = sorted((i for i in normal if len(v.pieces[i]) > 1 and i not in runs), key=lambda i: -v.scores[i])
        if len({v.scores[i] for i in longer}) < len(longer) or any(MARK in v.pieces[i].lstrip(MARK) or "\n" in v.pieces[i] for i in normal):
            raise ValueError("the vocabulary is not of the supported kind: tied scores, or a mark or line break inside a piece")
        if len(chars) + 2 >= 1 << CODE_BITS or runs and longer and max(v.scores[i] for i in runs) >= v.scores[longer[-1]]:
            raise ValueError("the vocabulary is not of the supported kind: too many characters, or runs of marks that merge early")
        self.vocabulary = v
        self.n_chars = len(chars)
        self.ids = np.array([0, *chars, *longer], np.int64)
        names = ["", *(v.pieces[i] for i in self.ids[1:])]
        self.length = np.array([1, *map(len, names[1:])], np.int64)
        self.code = {c: k + 2 for k, c in enumerate(sorted(names[1 : self.n_chars + 1]))}  # 0 separates, 1 is any other
        self.run_id = {1: v.pieces.index(MARK), **{len(v.pieces[i]): i for i in runs}}
        self.byte_id = {int(v.pieces[i][3:5], 16): i for i, kind in enumerate(v.kinds) if kind == "b"}
        self.unknown = v.kinds.find("u")
        self._pairs(names)
        self._patterns(names)
        self._forget()
        self.surface = [self._surface(i) for i in range(len(v.pieces))]

    # -- tables ------------------------------------------------------------------------------------------------------

    def _pairs(self, names: list[str]) -> None:
        """Which two nodes join to which node, and of which two a node is made (nothing: it never comes about)."""
        node = {name: k for k, name in enumerate(names) if k}
        joins: dict[tuple[int, int], int] = {}
        left, right = list(range(len(names))), list(range(len(names)))
        reachable = [True] * len(names)

        def apart(a: int, b: int, limit: int) -> bool:
            while True:
                if joins.get((a, b), limit) < limit:
                    return False
                if a > b:
                    if a <= self.n_chars:
                        return True
                    limit, a = a, right[a]
                else:
                    if b <= self.n_chars:
                        return True
                    limit, b = b + 1, left[b]

        for k in range(self.n_chars + 1, len(names)):
            name, made = names[k], False
            for cut in range(1, len(name)):
                a, b = node.get(name[:cut]), node.get(name[cut:])
                if a and b:
                    if not made and a < k and b < k and reachable[a] and reachable[b] and apart(a, b, k):
                        left[k], right[k], made = a, b, True
                    joins[a, b] = k
            reachable[k] = made
        # a join of two later pieces into an earlier one stands in the table too: merging goes by the result's rank
        keys = np.array([a << 16 | b for a, b in joins], np.int64)
        order = np.argsort(keys)
        self.join_keys, self.join_nodes = keys[order], np.array(list(joins.values()), np.int64)[order]
        self.left, self.right = np.array(left, np.int64), np.array(right, np.int64)
        self.reachable = np.array(reachable)

    def _patterns(self, names: list[str]) -> None:
        """Every usable piece as packed codes, filled up with the lowest and the highest code."""
        self.words = -(-int(self.length.max()) // PACKED)
        self.targets = np.flatnonzero(self.reachable)[1:]
        width = self.words * PACKED
        low = np.zeros((len(self.targets), width), np.int64)
        high = np.full((len(self.targets), width), (1 << CODE_BITS) - 1, np.int64)
        for row, k in enumerate(self.targets):
            codes = [self.code[c] for c in names[k]]
            low[row, : len(codes)] = high[row, : len(codes)] = codes
        pack = lambda m: [_packed(m[:, w * PACKED : (w + 1) * PACKED].T) for w in range(self.words)]
        self.low, self.high = pack(low), pack(high)

    @cached_property
    def code_table(self) -> np.ndarray:
        table = np.ones(0x110000, np.int16)
        for c, k in self.code.items():
            table[ord(c)] = k
        return table

    # -- encoding ----------------------------------------------------------------------------------------------------

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and how many each text has."""
        if len(self.known) > REMEMBERED:
            self._forget()
        cut = re.compile(f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+").findall
        found: list[str] = []
        counts = np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            if text:
                parts = cut((MARK + text).replace(" ", MARK))
                counts[k] = len(parts)
                found += parts
        fresh = [s for s in dict.fromkeys(found) if s not in self.known]
        if fresh:
            self._learn(fresh)
        at = np.fromiter(map(self.known.__getitem__, found), np.int64, len(found))
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.flat[np.repeat(self.starts[at] - (ends - sizes), sizes) + np.arange(total)]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return flat, np.diff(bounds)

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.starts, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, segments: list[str]) -> None:
        nodes, sizes, codes = self._lattice(segments)
        ids = self.ids[nodes]
        if (nodes == 0).any() or any(s[:2] == MARK * 2 for s in segments):
            ids, sizes = self._finish(segments, nodes, ids, sizes, codes)
        starts = len(self.flat) + np.cumsum(sizes) - sizes
        self.known.update(zip(segments, range(len(self.sizes), len(self.sizes) + len(segments))))
        self.flat = np.concatenate([self.flat, ids.astype(np.int32)])
        self.starts, self.sizes = np.concatenate([self.starts, starts]), np.concatenate([self.sizes, sizes])

    def _lattice(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nodes of all segments in text order, how many each has, and the characters where node 0 stands."""
        text = np.frombuffer("\0".join([*segments, ""]).encode("utf-32-le"), np.uint32)
        sizes = np.fromiter(map(len, segments), np.int64, len(segments))
        begins = np.cumsum(sizes + 1) - sizes - 1
        ends = begins + sizes
        codes = self.code_table[text].astype(np.int64)
        codes[ends] = 0
        start, node = self._edges(codes)
        owner = np.repeat(begins, sizes + 1)
        reach = start + self.length[node] - owner[start]
        order = np.argsort(reach, kind="stable")
        start, node, reach = start[order], node[order], reach[order]
        last = np.full(len(codes), -1, np.int64)
        upto = np.searchsorted(reach, np.arange(1, sizes.max() + 2))
        for d in range(len(upto) - 1):
            s, n = start[upto[d] : upto[d + 1]], node[upto[d] : upto[d + 1]]
            before = last[s]
            holds = (before < 0) & (owner[s] == s)
            rest = np.flatnonzero(before >= 0)
            pairs, back = np.unique(before[rest] << 16 | n[rest], return_inverse=True)
            holds[rest] = self._apart(pairs >> 16, pairs & 0xFFFF)[back]
            last[s[holds] + self.length[n[holds]]] = n[holds]
        cuts = np.zeros(len(codes), bool)
        here, open_ = ends.copy(), np.flatnonzero(sizes)
        while len(open_):
            cuts[here[open_]] = True
            here[open_] -= self.length[last[here[open_]]]
            open_ = open_[here[open_] > begins[open_]]
        places = np.flatnonzero(cuts)
        nodes = last[places]
        counts = np.searchsorted(places, ends, "right") - np.searchsorted(places, begins, "right")
        return nodes, counts, text[places[nodes == 0] - 1]

    def _edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and node of every occurrence of every piece."""
        n = len(codes)
        padded = np.concatenate([codes, np.zeros(self.words * PACKED, np.int64)])
        key = _packed([padded[k : k + n + (self.words - 1) * PACKED] for k in range(PACKED)])
        rank, depth = key[:n], PACKED
        suffixes = np.argsort(rank)
        while depth < self.words * PACKED:  # twice as deep each time, as ranks
            rank = np.empty(n, np.int64)
            ordered = key[suffixes] if depth == PACKED else joint[suffixes]
            rank[suffixes] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
            later = np.concatenate([rank[depth:] + 1, np.zeros(min(depth, n), np.int64)])[:n]
            joint = rank * (n + 1) + later
            suffixes, depth = np.argsort(joint), depth * 2
        first, after = self._search(key, suffixes, self.low, False), self._search(key, suffixes, self.high, True)
        hits = after - first
        at = np.repeat(first - (np.cumsum(hits) - hits), hits) + np.arange(int(hits.sum()))
        other = np.flatnonzero(codes == 1)
        return np.concatenate([suffixes[at], other]), np.concatenate([np.repeat(self.targets, hits), np.zeros(len(other), np.int64)])

    def _search(self, key: np.ndarray, suffixes: np.ndarray, wanted: list[np.ndarray], behind_equal: bool) -> np.ndarray:
        low, high = np.zeros(len(wanted[0]), np.int64), np.full(len(wanted[0]), len(suffixes), np.int64)
        while (low < high).any():
            middle = (low + high) >> 1
            at = suffixes[np.minimum(middle, len(suffixes) - 1)]
            less, same = np.zeros(len(low), bool), np.ones(len(low), bool)
            for w, target in enumerate(wanted):
                k = key[at + w * PACKED]
                less |= same & (k < target)
                same &= k == target
            less = (less | same if behind_equal else less) & (low < high)
            low, high = np.where(less, middle + 1, low), np.where(less | (low >= high), high, middle)
        return low

    def _apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the pieces stay two when their characters are merged by rank.

        Undoes the later of the two again and again; a join across the border that would have come first decides.
        """
        result = np.ones(len(a), bool)
        limit = np.full(len(a), NONE)
        open_, a, b = np.arange(len(a)), a.copy(), b.copy()
        while len(open_):
            keys = a << 16 | b
            at = np.minimum(np.searchsorted(self.join_keys, keys), len(self.join_keys) - 1)
            joined = np.where(self.join_keys[at] == keys, self.join_nodes[at], NONE)
            wrong = joined < limit
            result[open_[wrong]] = False
            later_left = a > b
            go = ~wrong & (np.where(later_left, a, b) > self.n_chars)
            limit = np.where(later_left, a, b + 1)[go]
            a, b = np.where(later_left, self.right[a], a)[go], np.where(later_left, b, self.left[b])[go]
            open_ = open_[go]
        return result

    def _finish(self, segments: list[str], nodes: np.ndarray, ids: np.ndarray, sizes: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes for characters without a piece; runs of marks, which merge last and from the left."""
        parts, new, at, seen = [], sizes.copy(), 0, 0
        mark = self.run_id[1]
        for k, segment in enumerate(segments):
            own, of = ids[at : at + sizes[k]], nodes[at : at + sizes[k]]
            at += sizes[k]
            odd = int((of == 0).sum())
            if odd:
                chars = iter(other[seen : seen + odd])
                seen += odd
                own = np.array([i for n, o in zip(of, own) for i in ([o] if n else self._bytes(next(chars)))], np.int64)
            if segment.startswith(MARK * 2):
                run = int(np.argmax(own != mark)) if (own != mark).any() else len(own)
                own = np.concatenate([self._run(run), own[run:]])
            new[k] = len(own)
            parts.append(own)
        return np.concatenate(parts), new

    def _bytes(self, char: int) -> list[int]:
        return [self.byte_id[b] for b in chr(char).encode()] if self.byte_id else [self.unknown]

    def _run(self, n: int) -> np.ndarray:
        stack: list[int] = []
        for _ in range(n):
            stack.append(1)
            while len(stack) > 1 and stack[-1] + stack[-2] in self.run_id:
                stack.append(stack.pop() + stack.pop())
        return np.array([self.run_id[k] for k in stack], np.int64)

    # -- decoding ----------------------------------------------------------------------------------------------------

    def _surface(self, i: int) -> bytes:
        kind, piece = self.vocabulary.kinds[i], self.vocabulary.pieces[i]
        return {"n": piece.replace(MARK, " ").encode(), "b": bytes([int(piece[3:5], 16)]) if kind == "b" else b"", "c": b"", "u": " ⁇ ".encode()}[kind]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.surface.__getitem__, ids)).removeprefix(b" ").decode("utf-8", "replace")


def _packed(columns) -> np.ndarray:
    key = np.zeros_like(columns[0])
    for c in columns:
        key = key << CODE_BITS | c
    return key


_ENCODERS: dict[int, Encoder] = {}


def encoder_of(vocabulary: Vocabulary) -> Encoder:
    """The encoder that this process has built for the vocabulary."""
    key = hash(vocabulary)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(vocabulary)
    return _ENCODERS[key]


def _pieces_of(texts: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """Runs of texts of about BATCH_CHARS bytes; a longer text is a run of its own."""
    sizes = np.nan_to_num(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.float64))
    begin, held = 0, 0.0
    for k, size in enumerate(sizes):
        if held and held + size > BATCH_CHARS:
            yield begin, texts.slice(begin, k - begin).to_pylist()
            begin, held = k, 0.0
        held += size
    if begin < len(texts):
        yield begin, texts.slice(begin).to_pylist()


def encode(spark: SparkSession, docs: DataFrame, model: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """`doc_id`, `ids`, `n_tokens`, and `restored`: whether the decoded ids give the text again.

    `model`: path of the model file on the driver. Tasks get its pieces, whose number the vocabulary bounds.
    """
    shipped = spark.sparkContext.broadcast(Vocabulary.load(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder_of(shipped.value)
        for batch in batches:
            for begin, texts in _pieces_of(batch.column(1)):
                flat, counts = own.encode(texts)
                bounds = np.concatenate([[0], np.cumsum(counts)])
                restored = [own.decode(flat[a:b].tolist()) == (t or "") for a, b, t in zip(bounds[:-1], bounds[1:], texts)]
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, len(texts)), lists, pa.array(counts, pa.int64()), pa.array(restored, pa.bool_())], ["doc_id", "ids", "n_tokens", "restored"],
                )

    source = docs.select(doc_id, text)
    kind = source.schema[doc_id].dataType.simpleString()
    out = source.mapInArrow(run, f"doc_id {kind}, ids array<int>, n_tokens long, restored boolean")
    return out.withColumnRenamed("doc_id", doc_id)


def decode(spark: SparkSession, encoded: DataFrame, model: str, ids: str = "ids", doc_id: str = "doc_id") -> DataFrame:
    """`doc_id` and the text that the ids stand for; null ids are an empty text."""
    shipped = spark.sparkContext.broadcast(Vocabulary.load(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder_of(shipped.value)
        for batch in batches:
            texts = [own.decode(i or []) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    source = encoded.select(doc_id, ids)
    return source.mapInArrow(run, f"doc_id {source.schema[doc_id].dataType.simpleString()}, text string").withColumnRenamed("doc_id", doc_id)
