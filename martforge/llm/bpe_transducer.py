"""Byte-level BPE by a lazily determinised finite-state transducer.

A token sequence is what the ranked merges give exactly when every token is
what the merges make of its own bytes and every adjacent pair survives when
the two are encoded together.  So reading a piece byte by byte, a
nondeterministic machine guesses where the current token began: a
configuration is a node of the vocabulary trie together with the token before
it.  The subset construction runs lazily: the set of live trie nodes is named
by its deepest one (the others are its suffixes), and a state and a byte are
expanded once, when first met, and kept.  At each position exactly one token
ends that fits the token before it; the machine notes it.  A token is emitted
as soon as all live configurations go back to it; in a long piece that is
looked for every ``FLUSH`` bytes, so the bytes waiting stay bounded.

Decoding joins token bytes and runs them through an incremental UTF-8 machine
that holds back an unfinished character between chunks.

Null text is the empty text: no ids.  Repeated rows give repeated results;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from martforge.llm import common

PIECES_KEPT = 600_000  # bound on remembered pieces per worker; the rest is encoded again
PAIRS_KEPT = 1_000_000  # bound on remembered token pairs per worker
FLUSH = 4096  # bytes of one piece after which certain tokens are emitted

# fixed value: the split pattern of the rank files
SPACE_LED = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BESIDE_SPACE = re.compile(r"^ |\s | \s| $").search
LONE_SPACE = re.compile(r"(?<=\S) (?=\S)").split


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


def merge_by_rank(piece: bytes, ranks: dict[bytes, int], below: int = 1 << 62) -> list[int]:
    """Reference merge loop over ranks under ``below``; used on the bytes of one token."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best = min(((ranks.get(a + b), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))
                    if ranks.get(a + b, below) < below), default=None)
        if best is None:
            break
        i = best[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


class Transducer:
    """Deterministic states are built when first needed; there are at most as
    many as trie nodes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.trie: dict[int, int] = {}  # node << 8 | byte -> node
        self.token_at: list[int] = [-1]
        self.came: list[int] = [0]  # the trie edge that leads to a node
        for token, rank in ranks.items():
            node = 0
            for b in token:
                key = node << 8 | b
                nxt = self.trie.get(key)
                if nxt is None:
                    nxt = self.trie[key] = len(self.token_at)
                    self.token_at.append(-1)
                    self.came.append(key)
                node = nxt
            self.token_at[node] = rank
        self.delta: dict[int, int] = {}
        self._fail: dict[int, int] = {0: 0}
        self._ending: dict[int, tuple[tuple[int, int], ...]] = {0: ()}
        self._whole: dict[int, bool] = {}
        self._split: dict[int, tuple[int, int] | None] = {}
        self._fits: dict[int, bool] = {}

    def _step(self, node: int, byte: int) -> int:
        """The state after one more byte (the subset construction, one step)."""
        key = node << 8 | byte
        out = self.delta.get(key)
        if out is None:
            out = self.trie.get(key)
            if out is None:
                out = self._step(self._suffix(node), byte) if node else 0
            self.delta[key] = out
        return out

    def _suffix(self, node: int) -> int:
        """The deepest other live node."""
        out = self._fail.get(node)
        if out is None:
            parent, byte = self.came[node] >> 8, self.came[node] & 255
            out = self._fail[node] = self._step(self._suffix(parent), byte) if parent else 0
        return out

    def ending(self, node: int) -> tuple[tuple[int, int], ...]:
        """(token, length) of the tokens that may end in this state, longest first."""
        out = self._ending.get(node)
        if out is None:
            out, token = self.ending(self._suffix(node)), self.token_at[node]
            if token >= 0 and self.whole(token):
                out = ((token, len(self.bytes_of[token])),) + out
            self._ending[node] = out
        return out

    def whole(self, token: int) -> bool:
        ok = self._whole.get(token)
        if ok is None:
            ok = self._whole[token] = merge_by_rank(self.bytes_of[token], self.ranks) == [token]
        return ok

    def _fit(self, left: int, right: int) -> bool:
        if len(self._fits) >= PAIRS_KEPT:
            self._fits.clear()
        ok = self._fits[left << 32 | right] = self._survives(left, right)
        return ok

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a single byte."""
        if token not in self._split:
            data = self.bytes_of[token]
            if len(data) == 1:
                self._split[token] = None
            else:
                earlier = merge_by_rank(data, self.ranks, token)
                self._split[token] = (earlier[0], earlier[1]) if len(earlier) == 2 else None
        return self._split[token]

    def _survives(self, left: int, right: int) -> bool:
        """Whether no merge crosses the border when both are encoded together.

        Merges are undone in falling order of rank, so that the two tokens at
        the border are seen at every moment of the merging; a pair there merges
        if its rank comes before the rank that changes either of them next."""
        bytes_of, ranks = self.bytes_of, self.ranks
        until = len(ranks) + 1  # the border pair must not merge before this moment
        while True:
            pair = ranks.get(bytes_of[left] + bytes_of[right])
            if pair is not None and pair < until:
                return False
            a, b = self._halves(left), self._halves(right)
            if a is None and b is None:
                return True
            # of two equal ranks the leftmost merges first, so the right one is undone first
            if b is None or (a is not None and left > right):
                until, left = left, a[1]
            else:
                until, right = right + 1, b[0]

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:  # a piece that is itself a token is that token
            return [whole]
        delta, ending, fits = self.delta, self._ending, self._fits
        out: list[int] = []
        last = [-1]  # last[i]: the one token that ends the encoding of the first i bytes
        size = [0]
        node = at = 0
        for byte in piece:
            key = node << 8 | byte
            node = delta[key] if key in delta else self._step(node, byte)
            at += 1
            for token, n in ending[node] if node in ending else self.ending(node):
                left = last[at - n]
                if left < 0:
                    break
                ok = fits.get(left << 32 | token)
                if ok or (ok is None and self._fit(left, token)):
                    break
            last.append(token)
            size.append(n)
            if at == FLUSH:
                at = self._emit(last, size, self._depth(node), out)
        tail = []
        while size[at]:
            tail.append(last[at])
            at -= size[at]
        out.extend(reversed(tail))
        return out

    def _depth(self, node: int) -> int:
        n = 0
        while node:
            node, n = self.came[node] >> 8, n + 1
        return n

    @staticmethod
    def _emit(last: list[int], size: list[int], depth: int, out: list[int]) -> int:
        """Emit the tokens that every live configuration goes back to, and drop
        their bytes; returns the number of bytes still waiting."""
        end = len(last) - 1
        live = set(range(end - depth, end + 1))  # where the current token may begin
        while len(live) > 1:
            top = max(live)
            live.remove(top)
            live.add(top - size[top])
        sure = at = live.pop()
        tail = []
        while size[at]:
            tail.append(last[at])
            at -= size[at]
        out.extend(reversed(tail))
        # what is left starts after the last certain token
        del last[:sure], size[:sure]
        size[0] = 0
        return end - sure


class Utf8Stream:
    """Incremental UTF-8 machine: text of all characters finished so far; up to
    three bytes of an unfinished one wait for the next chunk."""

    def __init__(self):
        self.rest = b""

    @staticmethod
    def _unfinished(data: bytes) -> int:
        """Number of trailing bytes that begin, but do not end, a character."""
        for back in range(1, min(3, len(data)) + 1):
            b = data[-back]
            if b >= 0xC0:
                need = 2 if b < 0xE0 else 3 if b < 0xF0 else 4
                return back if need > back else 0
            if b < 0x80:
                return 0
        return 0

    def feed(self, chunk: bytes) -> str:
        data = self.rest + chunk
        hold = self._unfinished(data)
        self.rest = data[len(data) - hold:] if hold else b""
        return (data[:-hold] if hold else data).decode("utf-8", "replace")

    def close(self) -> str:
        out, self.rest = self.rest.decode("utf-8", "replace"), b""
        return out


class Remembered(dict):
    """Results of ``make`` by key, a bounded number of them."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        if len(self) >= PIECES_KEPT:
            self.clear()
        out = self[key] = self.make(key)
        return out


class Codec:
    """Encoder and streaming decoder for one vocabulary and split pattern."""

    def __init__(self, data: bytes, pattern: str):
        self.ranks = read_ranks(data)
        self.machine = Transducer(self.ranks)
        self.split = regex.compile(pattern).findall
        # The patterns of byte-level BPE give a lone space to the piece after
        # it, so a text may be cut before every lone space.
        self.blocks_at_spaces = pattern == SPACE_LED
        self.pieces = Remembered(
            lambda piece: " ".join(map(str, self.machine.encode_piece(piece.encode("utf-8")))))
        self.first = Remembered(lambda block: " ".join(map(self.pieces.__getitem__, self.split(block))))
        self.others = Remembered(lambda block: self.first.make(" " + block))

    def encode_decimal(self, text: str) -> str:
        """Ids of the text, decimal, joined by one space."""
        if not self.blocks_at_spaces:
            return " ".join(map(self.pieces.__getitem__, self.split(text)))
        if not text:
            return ""
        if BESIDE_SPACE(text):
            blocks = LONE_SPACE(text)
        else:
            blocks = text.split(" ")
        rest = iter(blocks)
        return " ".join([self.first[next(rest)], *map(self.others.__getitem__, rest)])

    def encode(self, text: str) -> list[int]:
        return list(map(int, self.encode_decimal(text).split()))

    def decode_chunks(self, ids: Iterable[int], chunk: int = 16_384) -> Iterator[str]:
        """Text of an id stream, chunk by chunk."""
        token, stream, ids = self.machine.bytes_of.__getitem__, Utf8Stream(), list(ids)
        for i in range(0, len(ids), chunk):
            yield stream.feed(b"".join(map(token, ids[i:i + chunk])))
        yield stream.close()

    def decode(self, ids: Iterable[int]) -> str:
        return "".join(self.decode_chunks(ids))


_codecs: dict[tuple, Codec] = {}


def codec(data: bytes, pattern: str) -> Codec:
    """The codec of this worker process, built once."""
    key = (hashlib.sha256(data).digest(), pattern)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(data, pattern)
    return _codecs[key]


def encode(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id, ids array<int> of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(common.file_bytes(vocabulary))

    def run(batch: pa.RecordBatch) -> dict:
        c = codec(shared.value, pattern)
        return {"doc_id": batch.column(0), "ids": [c.encode(t) for t in common.texts_of(batch)]}

    return common.map_batches(common.id_and_text(docs), run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id, text of every id list (null ids: empty text)."""
    shared = encoded.sparkSession.sparkContext.broadcast(common.file_bytes(vocabulary))

    def run(batch: pa.RecordBatch) -> dict:
        c = codec(shared.value, pattern)
        return {"doc_id": batch.column(0), "text": [c.decode(i or ()) for i in batch.column(1).to_pylist()]}

    return common.map_batches(encoded.select("doc_id", "ids"), run, "doc_id long, text string")


def round_trip_digests(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """Encode and decode every text in one pass; only digests leave the task."""
    shared = docs.sparkSession.sparkContext.broadcast(common.file_bytes(vocabulary))

    def run(batch: pa.RecordBatch) -> dict:
        c = codec(shared.value, pattern)
        n, ids_sha, text_sha = [], [], []
        for text in common.texts_of(batch):
            decimal = c.encode_decimal(text)
            ids = list(map(int, decimal.split()))
            back = hashlib.sha256()
            for part in c.decode_chunks(ids):
                back.update(part.encode("utf-8"))
            n.append(len(ids))
            ids_sha.append(hashlib.sha256(decimal.encode()).hexdigest())
            text_sha.append(back.hexdigest())
        return {"doc_id": batch.column(0), "n_tokens": n, "ids_sha256": ids_sha, "decoded_sha256": text_sha}

    return common.map_batches(common.id_and_text(docs), run,
                              "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
