"""Byte-level BPE by dynamic programming over byte prefixes.

For every prefix of a byte string there is exactly one token that can be the
last of the prefix's encoding: the token ``t`` that ends there and is
compatible with the last token of the prefix before it. Storing that token per
prefix gives the encoding of every prefix at once: appending costs one step per
new byte, and an edit leaves all earlier prefixes as they are.

Two tokens are compatible when byte-pair merging of their joined bytes ends in
exactly these two. That depends on the pieces along the boundary only: the
pieces at the right edge of the first token and at the left edge of the second
exist one after another while merging goes on, and a merge across happens if
two of them that exist together have a joint rank lower than the ranks that
take them into their own tokens (at equal ranks the left merge comes first).
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices
from .pieces import TextEncoder, ids_to_bytes

#: Larger than any rank.
NEVER = 1 << 60
#: Pairs whose compatibility is remembered per worker, and ways of the automaton found late.
PAIR_ENTRIES = 1_000_000
#: Bits of a rank in a pair's key.
RANK_BITS = 24


class PrefixBpe:
    """A rank table with the merge history of each token.

    An automaton over the tokens' bytes reads a text byte by byte; its state is
    the longest end of what was read that begins a token, and each state lists the
    tokens that end there, longest first. So only tokens that really end at a
    prefix are tried as its last one.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {r: b for b, r in ranks.items()}
        # pieces along an edge, from the single byte up to the token itself
        self.right_edge: dict[int, list[int]] = {}
        self.left_edge: dict[int, list[int]] = {}
        self._pairs: dict[int, bool] = {}
        for rank in sorted(self.bytes_of):
            self._learn(rank)
        self.reach = max(len(self.bytes_of[r]) for r in self.right_edge)
        self._build()

    def _build(self) -> None:
        """The automaton: ways by state and byte, shorter ends, tokens that end there."""
        self._ways: dict[int, int] = {}
        ends: list[tuple[int, int] | None] = [None]
        for rank in self.right_edge:
            state = 0
            for byte in self.bytes_of[rank]:
                way = state << 8 | byte
                state = self._ways.get(way, 0)
                if not state:
                    state = self._ways[way] = len(ends)
                    ends.append(None)
            ends[state] = rank, len(self.bytes_of[rank])
        self._shorter = [0] * len(ends)
        self._tokens: list[tuple[tuple[int, int], ...]] = [()] * len(ends)
        # ways are in the order of insertion, so go by depth
        level = [(s, 0, w & 255) for w, s in self._ways.items() if w < 256]
        below: dict[int, list[tuple[int, int]]] = {}
        for way, state in self._ways.items():
            below.setdefault(way >> 8, []).append((state, way & 255))
        while level:
            deeper = []
            for state, parent, byte in level:
                short = self._next(self._shorter[parent], byte) if parent else 0
                self._shorter[state] = short
                own = ends[state]
                self._tokens[state] = ((own,) if own else ()) + self._tokens[short]
                deeper += [(s, state, b) for s, b in below.get(state, ())]
            level = deeper
        self._spare = PAIR_ENTRIES

    def _next(self, state: int, byte: int) -> int:
        """The state after one more byte, over shorter ends where there is no way."""
        while True:
            found = self._ways.get(state << 8 | byte)
            if found is not None or not state:
                return found or 0
            state = self._shorter[state]

    def _learn(self, rank: int) -> None:
        """Edges of a token from its final merge; tokens no merge reaches get none."""
        token = self.bytes_of[rank]
        if len(token) == 1:
            self.right_edge[rank] = self.left_edge[rank] = [rank]
        else:
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if (a is not None and b is not None and a in self.right_edge
                        and b in self.right_edge and a < rank and b < rank
                        and self._stay_apart(a, b, rank)):
                    self.right_edge[rank] = self.right_edge[b] + [rank]
                    self.left_edge[rank] = self.left_edge[a] + [rank]
                    break
            else:
                return

    def _stay_apart(self, a: int, b: int, below: int = NEVER) -> bool:
        """Whether no merge of a rank lower than ``below`` crosses from a to b."""
        left, right, i, j = self.right_edge[a], self.left_edge[b], 0, 0
        while True:
            left_gone = left[i + 1] if i + 1 < len(left) else NEVER
            right_gone = right[j + 1] if j + 1 < len(right) else NEVER
            joint = self.ranks.get(self.bytes_of[left[i]] + self.bytes_of[right[j]], NEVER)
            if joint < below and joint < left_gone and joint <= right_gone:
                return False
            if left_gone == right_gone == NEVER:
                return True
            if left_gone <= right_gone:
                i += 1
            else:
                j += 1

    def compatible(self, a: int, b: int) -> bool:
        """Whether the joined bytes of two tokens encode to exactly these two."""
        key = a << RANK_BITS | b
        known = self._pairs.get(key)
        if known is None:
            known = self._stay_apart(a, b)
            if len(self._pairs) < PAIR_ENTRIES:
                self._pairs[key] = known
        return known

    def extend(self, data: bytes, last: list[int], states: list[int], stop: int) -> None:
        """Append the last tokens and states of the prefixes up to ``stop`` bytes, given
        those of all shorter ones."""
        ways, tokens, pairs = self._ways, self._tokens, self._pairs
        state = states[-1]
        for end in range(len(last), stop + 1):
            byte = data[end - 1]
            way = ways.get(state << 8 | byte)
            if way is None:
                before, way = state, self._next(state, byte)
                if self._spare:
                    self._spare -= 1
                    ways[before << 8 | byte] = way
            state = way
            for token, size in tokens[state]:
                if size == end:
                    break
                left = last[end - size]
                fits = pairs.get(left << RANK_BITS | token)
                if fits or (fits is None and self.compatible(left, token)):
                    break
            else:
                raise ValueError("the vocabulary lacks a single byte")
            last.append(token)
            states.append(state)

    def encode(self, data: bytes) -> list[int]:
        """Ids of one match; a match that is a token is that token."""
        if data in self.ranks:
            return [self.ranks[data]]
        last = [-1]
        self.extend(data, last, [0], len(data))
        out, end, bytes_of = [], len(data), self.bytes_of
        while end:
            out.append(last[end])
            end -= len(bytes_of[last[end]])
        return out[::-1]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class PrefixEncoding:
    """Editable encoding of one byte string: the last token of every prefix."""

    def __init__(self, bpe: PrefixBpe, data: bytes = b""):
        self.bpe, self.data, self.last, self.states = bpe, b"", [-1], [0]
        self.append(data)

    def append(self, more: bytes) -> None:
        """Add bytes at the end; one step per byte, nothing is redone."""
        self.data += more
        self.bpe.extend(self.data, self.last, self.states, len(self.data))

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in place of ``data[start:stop]``; returns the prefixes redone.

        Prefixes up to ``start`` keep their tokens. Behind the edit, prefixes
        are redone until as many in a row as the longest token has bytes have
        the token they had before: from there on nothing can differ.
        """
        old, old_states, tail = self.last, self.states, len(self.data) - stop
        self.data = self.data[:start] + new + self.data[stop:]
        self.last, self.states = old[:start + 1], old_states[:start + 1]
        same, reach = 0, self.bpe.reach
        size = len(self.data)
        for end in range(start + 1, size + 1):
            self.bpe.extend(self.data, self.last, self.states, end)
            token = self.last[end]
            before = end - size + len(old) - 1
            is_behind = end - (start + len(new)) > 0 and tail > 0
            same = same + 1 if is_behind and old[before] == token else 0
            if same >= reach:
                self.last += old[before + 1:]
                self.states += old_states[before + 1:]
                return end - start
        return size - start

    def tokens(self, end: int | None = None) -> list[int]:
        """Ids of the prefix of ``end`` bytes (default: all)."""
        end = len(self.data) if end is None else end
        out = []
        while end:
            out.append(self.last[end])
            end -= len(self.bpe.bytes_of[self.last[end]])
        return out[::-1]


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: per line a token in base64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}


_LOADED: dict[str, tuple[PrefixBpe, TextEncoder]] = {}


def prefix_encoder(name: str) -> tuple[PrefixBpe, TextEncoder]:
    """The operator over a rank file by its name; one per worker process."""
    if name not in _LOADED:
        import public_tokenizers

        bpe = PrefixBpe(read_ranks(public_tokenizers.path(name)))
        _LOADED[name] = bpe, TextEncoder(public_tokenizers.PATTERN,
                                         lambda m: ids_to_bytes(bpe.encode(m.encode())))
    return _LOADED[name]


def encode_documents(df: DataFrame, id_col: str, text_col: str, ranks_name: str) -> DataFrame:
    """Ids of every whole text, and the bytes they decode to: doc_id, ids, decoded.

    ``ids`` is binary, little-endian unsigned 32-bit integers. Null texts count
    as empty (no ids); rows that repeat stay apart; other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, encoder = prefix_encoder(ranks_name)
        for batch in slices(batches):
            ids = [encoder.encode(t) if t else b"" for t in batch.column(1).to_pylist()]
            decoded = [bpe.decode(memoryview(x).cast("I")) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())],
                names=["doc_id", "ids", "decoded"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary, decoded binary")
