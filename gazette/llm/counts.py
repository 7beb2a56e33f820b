"""Token counts of whole texts by a transducer compiled from a merge tokenizer.

The tokenizer is a sentencepiece BPE model. Which tokens a text has so far depends on
little: the last token before each place where a token that goes on may have begun.
That is a state. A transition reads one character and is annotated with the tokens
that it adds to the count, which is less than nothing where it joins some. So the
machine is deterministic, needs no look-ahead and is exact: of the tokens that end at a
place, the one that stands is the one that merging it with the last token before
it leaves alone.

Transitions are compiled when a text first takes them, and kept in a hash table of
arrays. Texts are cut into chunks that run at the same time, a character of each
chunk a step. No token reaches over a place where white space begins or beside
an unknown character, so chunks that start there start in state 0. A chunk in the middle of a
longer run has a map from the states it may be entered in to the state it is left
in and a count. Such maps are made for the entries that the chunk before can bring
about, and composed by a prefix scan.
"""

from __future__ import annotations

import struct
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import arrow_map

CHUNK = 256  # characters, of runs that have no place to start anew
BATCH_CHARS = 1 << 20
MOST_STATES = 300_000  # then a worker forgets its machine and compiles anew
LIMIT = 4096
_SPACE = "▁"
_ANY = -1  # no last token: whatever begins here stands alone
_UNKNOWN = 0  # the class of characters in no piece

_machines: dict = {}


class Transducer:
    """Counts the tokens of texts; ``path`` is a sentencepiece BPE model's file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        normal, kind = model.normalizer_spec, model.trainer_spec
        pieces = SentencePieceProcessor(model_file=path)
        score = {
            pieces.id_to_piece(i): pieces.get_score(i)
            for i in range(pieces.get_piece_size())
            if not (pieces.is_control(i) or pieces.is_unknown(i) or pieces.is_byte(i))
        }
        plain = kind.model_type == kind.BPE and not normal.precompiled_charsmap
        plain = plain and normal.escape_whitespaces and not normal.remove_extra_whitespaces
        plain = plain and not kind.treat_whitespace_as_suffix and kind.byte_fallback
        plain = plain and all(x.type in (1, 2, 3, 6) for x in model.pieces)
        if not plain or any(_SPACE in piece.lstrip(_SPACE) for piece in score):
            raise ValueError("only BPE with byte fallback, as it is, with spaces before words")
        self.prefix = _SPACE if normal.add_dummy_prefix else ""
        # pieces of one score have one rank: then the place decides
        steps = {x: n for n, x in enumerate(sorted(set(score.values()), reverse=True))}
        self.rank = {piece: steps[x] for piece, x in score.items()}
        self.text = list(score)
        alphabet = sorted({c for piece in score for c in piece})
        self.classes = np.zeros(0x110000, np.uint16)
        self.classes[[ord(c) for c in alphabet]] = np.arange(1, len(alphabet) + 1)
        self.classes[ord(" ")] = self.classes[ord(_SPACE)]
        self.space = int(self.classes[ord(_SPACE)])
        self.width = len(alphabet) + 1
        self.child: dict[tuple[int, int], int] = {}
        self.token: dict[int, int] = {}  # of a node of the prefix tree
        number = {c: n for n, c in enumerate(alphabet, 1)}
        for i, piece in enumerate(score):
            node = 0
            for c in piece:
                node = self.child.setdefault((node, number[c]), len(self.child) + 1)
            self.token[node] = i
        self.inner = {node for node, _ in self.child}
        # a character that is no piece by itself falls back to its bytes
        self.cost = {number[c]: 1 if c in score else len(c.encode()) for c in alphabet}
        self.forget()

    # --- compiling --------------------------------------------------------------------

    def forget(self) -> None:
        """Back to state 0 alone."""
        self.states = [self._packed(_ANY, [])]
        self.number = {self.states[0]: 0}
        self.stands: dict[tuple[int, int], bool] = {}
        self._table(1 << 16)
        self.used = 0

    @staticmethod
    def _packed(last: int, open_: list[tuple[int, int, int]]) -> bytes:
        """A state: the last token; for each place where a token that goes on may have begun
        the node it has come to, the token before it, and the count there less that here."""
        return struct.pack(f"{1 + 3 * len(open_)}i", last, *chain.from_iterable(open_))

    def _table(self, size: int) -> None:
        self.keys = np.full(size, -1, np.int64)
        self.next = np.zeros(size, np.int32)
        self.adds = np.zeros(size, np.int16)

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text: the best pair is joined first, the leftmost of equals."""
        parts, rank, none = list(text), self.rank.get, len(self.rank)
        pairs = [rank(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while pairs and (best := min(pairs)) < none:
            at = pairs.index(best)
            joined = parts[at] + parts[at + 1]
            parts[at : at + 2] = [joined]
            del pairs[at]
            if at:
                pairs[at - 1] = rank(parts[at - 1] + joined, none)
            if at < len(pairs):
                pairs[at] = rank(joined + parts[at + 1], none)
        return parts

    def _stands(self, before: int, token: int) -> bool:
        """Whether ``token`` stays as it is after the token ``before``."""
        key = (before, token)
        if key not in self.stands:
            own = [self.text[x] for x in key if x != _ANY]
            self.stands[key] = self.merged("".join(own)) == own
        return self.stands[key]

    def _step(self, state: int, read: int) -> tuple[int, int]:
        """The next state and what the character adds to the count."""
        last, *flat = struct.unpack(f"{len(self.states[state]) // 4}i", self.states[state])
        open_ = zip(flat[::3], flat[1::3], flat[2::3], strict=True)
        grown = [
            (self.child[node, read], before, since)
            for node, before, since in open_
            if (node, read) in self.child
        ]
        # if no token can reach over the place before the character, all begins anew there
        grown.append((self.child[0, read], last if grown else _ANY, 0))
        ends = [
            (self.token[node], since)
            for node, before, since in grown
            if node in self.token and self._stands(before, self.token[node])
        ]
        if len(ends) > 1:
            raise ValueError("the merges of this vocabulary do not settle its tokens")
        if ends:
            last, adds = ends[0][0], ends[0][1] + 1
        elif len(grown) == 1:
            last, adds = _ANY, self.cost[read]
        else:
            raise ValueError("a character that is no piece by itself may be joined to others")
        open_ = [(node, b, since - adds) for node, b, since in grown if node in self.inner]
        key = self._packed(last, open_) if open_ else self.states[0]
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
        return self.number[key], adds

    def _places(self, keys: np.ndarray) -> np.ndarray:
        """Where keys are in the table, or the free places where they belong."""
        mask = len(self.keys) - 1
        at = ((keys * 0x9E3779B97F4A7C1) >> 20) & mask
        off = np.flatnonzero((self.keys[at] != keys) & (self.keys[at] != -1))
        while len(off):
            at[off] = (at[off] + 1) & mask
            held = self.keys[at[off]]
            off = off[(held != keys[off]) & (held != -1)]
        return at

    def _learn(self, keys: np.ndarray) -> None:
        keys = np.unique(keys)
        steps = np.array([self._step(*divmod(key, self.width)) for key in keys.tolist()])
        while 2 * (self.used + len(keys)) > len(self.keys):
            full = self.keys >= 0
            old = self.keys[full], self.next[full], self.adds[full]
            self._table(2 * len(self.keys))
            self._enter(*old)
        self._enter(keys, *steps.T)
        self.used += len(keys)

    def _enter(self, keys: np.ndarray, state: np.ndarray, adds: np.ndarray) -> None:
        while len(keys):
            at = self._places(keys)
            own, first = np.unique(at, return_index=True)  # one key a place, the others look on
            self.keys[own], self.next[own], self.adds[own] = keys[first], state[first], adds[first]
            left = np.ones(len(keys), bool)
            left[first] = False
            keys, state, adds = keys[left], state[left], adds[left]

    # --- running ----------------------------------------------------------------------

    def _run(self, classes, start, length, state) -> tuple[np.ndarray, np.ndarray]:
        """The states in which chunks are left and their counts."""
        order = np.argsort(-length, kind="stable")
        start, state = start[order], state[order].astype(np.int64)
        count = np.zeros(len(start), np.int64)
        steps = int(length.max()) if len(length) else 0
        active = len(length) - np.searchsorted(np.sort(length), np.arange(steps), side="right")
        for step, n in enumerate(active.tolist()):
            keys = state[:n] * self.width + classes[start[:n] + step]
            at = self._places(keys)
            new = self.keys[at] != keys
            if new.any():
                self._learn(keys[new])
                at = self._places(keys)
            state[:n] = self.next[at]
            count[:n] += self.adds[at]
        left, counted = np.empty_like(state), np.empty_like(count)
        left[order], counted[order] = state, count
        return left, counted

    def _composed(self, classes, start, length, goes_on) -> np.ndarray:
        """The counts that chunks add; ``goes_on``: the chunk before is of the same run."""
        state, count = self._run(classes, start, length, np.zeros(len(start), np.int64))
        if not goes_on.any():
            return count
        # Maps of the chunks of longer runs: (chunk, entry) -> (exit, count)
        part = np.flatnonzero(goes_on | np.append(goes_on[1:], False))
        maps = {(c, 0): (s, n) for c, s, n in zip(part.tolist(), state[part].tolist(), count[part].tolist(), strict=True)}
        todo = list(maps)
        while todo:
            entries = {
                (c + 1, maps[c, e][0]) for c, e in todo if c + 1 < len(goes_on) and goes_on[c + 1]
            }
            todo = sorted(entries - maps.keys())
            if todo:
                chunk, entry = np.array(todo).T
                found = self._run(classes, start[chunk], length[chunk], entry)
                maps.update(zip(todo, zip(*(x.tolist() for x in found), strict=True), strict=True))
        # Compose them: after k rounds each stands for 2^k chunks
        names = list(maps)
        place = {name: i for i, name in enumerate(names)}
        end = len(names)
        on = np.full(end + 1, end)
        for i, (c, e) in enumerate(names):
            if c + 1 < len(goes_on) and goes_on[c + 1]:
                on[i] = place[c + 1, maps[c, e][0]]
        total = np.append(np.array([maps[x][1] for x in names], np.int64), 0)
        while (on != end).any():
            total, on = total + total[on], on[on]
        out = np.where(goes_on, 0, count)
        for c in part[~goes_on[part]].tolist():
            out[c] = total[place[c, 0]]
        return out

    def counts(self, texts: list[str]) -> np.ndarray:
        """The number of tokens of each text."""
        if len(self.states) > MOST_STATES:
            self.forget()
        whole = [self.prefix + t if t else "" for t in texts]
        points = np.frombuffer("".join(whole).encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(t) for t in whole])
        if not len(points):
            return np.zeros(len(texts), np.int64)
        classes = self.classes[points].astype(np.int64)
        unknown, space = classes == _UNKNOWN, classes == self.space
        fresh = unknown.copy()
        fresh[1:] |= unknown[:-1] | (space[1:] & ~space[:-1])
        begins = np.append(0, ends[:-1])
        fresh[begins[begins < len(points)]] = True
        start = np.flatnonzero(fresh)
        run_length = np.diff(np.append(start, len(points)))
        chunks = -(-run_length // CHUNK)
        within = np.arange(chunks.sum()) - np.repeat(np.cumsum(chunks) - chunks, chunks)
        start = np.repeat(start, chunks) + CHUNK * within
        length = np.minimum(np.repeat(run_length, chunks) - CHUNK * within, CHUNK)
        known = ~unknown[start]
        adds = np.empty(len(start), np.int64)
        at = points[start]
        adds[~known] = (1 + (at > 0x7F).astype(int) + (at > 0x7FF) + (at > 0xFFFF))[~known]
        adds[known] = self._composed(classes, start[known], length[known], within[known] > 0)
        sums = np.append(0, np.cumsum(adds))[np.searchsorted(start, np.append(0, ends))]
        return np.diff(sums)


def _machine(path: str) -> Transducer:
    if path not in _machines:
        _machines[path] = Transducer(path)
    return _machines[path]


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs``, in one pass.

    ``tokenizer`` is the path, on every machine, of a sentencepiece BPE model with byte
    fallback. Null texts count as empty: no tokens. Ids may be null, repeated and of any
    type; each row gives one row, and other columns are not looked at.
    """

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        machine, found, held, size = _machine(tokenizer), [], [], 0
        for text in batch.column("_text").to_pylist():
            held.append(text)
            size += len(text)
            if size >= BATCH_CHARS:
                found.append(machine.counts(held))
                held, size = [], 0
        found.append(machine.counts(held))
        return [pa.array(np.concatenate(found), pa.int64())]

    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), text.alias("_text"))
    counted = arrow_map(rows, run, "n_tokens long", drop=("_text",))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
