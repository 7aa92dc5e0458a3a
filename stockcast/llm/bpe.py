"""Byte-level BPE encoding and decoding with a finite-state transducer.

A token sequence is the encoding of its bytes exactly when every adjacent pair
is: merging the pair's bytes by rank gives the pair back. So each prefix of a
piece has one last token, and reading left to right needs only the positions
at which a token may still start. A state of the transducer is those open
positions: for each, the last token before it and the bytes read since. States
and transitions are made when a byte first needs them (lazy determinisation);
a transition tells the token that ends at its byte. Tokens on which all open
positions agree are emitted after a bounded lookahead (open positions lie at
most the longest token back); the end of the piece flushes the rest.

Decoding streams ids to bytes through an incremental UTF-8 machine that carries
an unfinished character from chunk to chunk.

Edge cases: null text counts as empty (no ids, the digests of the empty
string). Repeated rows and rows without id are coded each for itself. An empty
table gives an empty result. Extra columns are ignored. Piece and state memories
are emptied when they reach a fixed size; results don't depend on it.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockcast.llm.common import give_back

CACHED_PIECES = 1 << 19
CACHED_STATES = 1 << 18
LOOKAHEAD = 1 << 10  # bytes after which agreed tokens are emitted; more than the longest token
CHUNK = 1 << 15  # tokens decoded at once


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Transducer:
    def __init__(self, ranks: dict[bytes, int], most: int | None = None):
        self.most = most or CACHED_STATES
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        # trie of the vocabulary: child node by node << 8 | byte, token by node
        self.child: dict[int, int] = {}
        self.token_at: dict[int, int] = {}
        self.depth = [0]
        inner = set()
        for t, i in ranks.items():
            node = 0
            for k, byte in enumerate(t):
                inner.add(node)
                node = self.child.setdefault(node << 8 | byte, len(self.child) + 1)
                if node == len(self.depth):
                    self.depth.append(k + 1)
            self.token_at[node] = i
        self.inner = inner  # nodes that a longer token passes through
        self.fits: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}
        self.reset()

    def reset(self) -> None:
        # an open position: (last token before it or -1, trie node of the bytes since)
        self.states: list[tuple] = [((-1, 0),)]
        self.number = {self.states[0]: 0}
        self.moves: dict[int, int] = {}  # next state << 20 | token + 1, in one number to save memory

    def merged(self, text: bytes) -> list[int]:
        """Encoding by merging the lowest rank first; for pairs of tokens only."""
        parts = [text[k : k + 1] for k in range(len(text))]
        ranks = self.ranks
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                rank = ranks.get(parts[k] + parts[k + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def follows(self, a: int, b: int) -> bool:
        """Whether token b can stand after token a (-1: at the start)."""
        known = self.fits.get(a << 32 | b)
        if known is None:
            if (whole := self.whole.get(b)) is None:
                whole = self.whole[b] = self.merged(self.tokens[b]) == [b]
            known = whole and (a < 0 or self.merged(self.tokens[a] + self.tokens[b]) == [a, b])
            if len(self.fits) > 2 * self.most:
                self.fits.clear()
            self.fits[a << 32 | b] = known
        return known

    def move(self, state: int, byte: int) -> int:
        """The transition made on first use: (next state, token that ends here)."""
        after, ended = [], -1
        child, token_at, inner = self.child, self.token_at, self.inner
        for last, node in self.states[state]:
            node = child.get(node << 8 | byte)
            if node is not None:
                if ended < 0 and (token := token_at.get(node)) is not None and self.follows(last, token):
                    ended = token
                if node in inner:
                    after.append((last, node))
        after.append((ended, 0))
        key = tuple(after)
        to = self.number.get(key)
        if to is None:
            to = self.number[key] = len(self.states)
            self.states.append(key)
        move = self.moves[state << 8 | byte] = to << 20 | ended + 1
        return move

    def encode(self, piece: bytes) -> list[int]:
        if len(self.states) > self.most:
            self.reset()
        state, moves = 0, self.moves
        out: list[int] = []
        ended: list[int] = []  # the token that ends at each position not yet emitted
        for byte in piece:
            move = moves.get(state << 8 | byte)
            if move is None:
                move = self.move(state, byte)
            state = move >> 20
            ended.append((move & 0xFFFFF) - 1)
            if len(ended) >= LOOKAHEAD:
                out += self.agreed(state, ended)
        return out + self.path(ended, len(ended))

    def path(self, ended: list[int], at: int) -> list[int]:
        """The tokens up to a position, by stepping back over their lengths."""
        back = []
        while at > 0:
            back.append(ended[at - 1])
            at -= len(self.tokens[back[-1]])
        return back[::-1]

    def agreed(self, state: int, ended: list[int]) -> list[int]:
        """Takes the tokens that all open positions share off ``ended``."""
        paths = [self.path(ended, len(ended) - self.depth[node]) for _, node in self.states[state]]
        shared = 0
        while all(len(p) > shared and p[shared] == paths[0][shared] for p in paths):
            shared += 1
        out = paths[0][:shared]
        del ended[: sum(len(self.tokens[t]) for t in out)]
        return out


class Utf8:
    """Incremental UTF-8 machine: its state is the unfinished character, at most
    three bytes; ``feed`` returns the text finished so far."""

    def __init__(self):
        self.rest = b""

    def feed(self, data: bytes) -> str:
        data = self.rest + data
        cut = len(data)
        for back in range(1, min(4, len(data) + 1)):
            lead = data[-back]
            if lead >= 0xC0:  # a lead byte: is its character complete?
                if back < (2 if lead < 0xE0 else 3 if lead < 0xF0 else 4):
                    cut -= back
                break
            if lead < 0x80:
                break
        self.rest = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        last, self.rest = self.rest, b""
        return last.decode("utf-8", "replace")


class Coder:
    """Texts to ids and back, with a bounded memory of pieces (``memory``; half
    as many states)."""

    def __init__(self, path: str, pattern: str, memory: int | None = None):
        self.machine = Transducer(read_ranks(path), memory and memory // 2)
        self.find = regex.compile(pattern)
        self.bytes_of = {str(i): t for i, t in self.machine.tokens.items()}
        self.pieces = _Pieces(self.machine, memory or CACHED_PIECES)

    def written(self, text: str) -> str:
        """The ids in decimal, joined by commas."""
        self.pieces.age()
        found = self.find.findall(text) if len(text) < 1 << 20 else (m.group() for m in self.find.finditer(text))
        return ",".join(map(self.pieces.__getitem__, found))

    def decoded(self, ids):
        """Bytes and text of decimal ids, chunk by chunk."""
        machine, ids = Utf8(), iter(ids)
        while chunk := list(islice(ids, CHUNK)):
            data = b"".join(map(self.bytes_of.__getitem__, chunk))
            yield data, machine.feed(data)
        if rest := machine.close():
            yield b"", rest


class _Pieces(dict):
    """Ids of pieces seen lately; what is still in use moves on when it ages."""

    def __init__(self, machine: Transducer, most: int):
        super().__init__()
        self.machine, self.most, self.old = machine, most, {}

    def age(self) -> None:
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()

    def __missing__(self, piece: str) -> str:
        ids = self.old.get(piece)
        if ids is None:
            ids = ",".join(map(str, self.machine.encode(piece.encode())))
        self[piece] = ids
        return ids


_coders: dict[tuple, Coder] = {}


def coder(path: str, pattern: str, memory: int | None = None) -> Coder:
    """One coder a worker and vocabulary; it keeps its states between tasks."""
    key = (path, pattern, memory)
    if key not in _coders:
        _coders[key] = Coder(path, pattern, memory)
        gc.collect()
        gc.freeze()  # the tables hold no cycles; don't walk them again and again
        gc.set_threshold(200_000, 50, 1000)
    return _coders[key]


def forget() -> None:
    """Drops the worker's coders. A worker outlives its tasks and any idle one
    may get the next, so a coder kept by each of them adds up."""
    _coders.clear()
    gc.unfreeze()
    gc.collect()
    give_back()


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) for every row. ``path``: a rank file that every
    executor can read at that place."""

    def run(batches):
        own = coder(path, pattern)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):  # ids of a few texts at a time
                part = batch.slice(k, 256)
                ids = [np.array(s.split(",") if s else [], np.int32) for s in (own.written(t or "") for t in part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""

    def run(batches):
        own = coder(path, pattern)
        for batch in batches:
            texts = ["".join(t for _, t in own.decoded(map(str, ids or ()))) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    encoded = encoded.select("doc_id", "ids")
    return encoded.mapInArrow(run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, memory: int | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, same[, ids]): encodes every
    text, decodes the ids again and compares. ``memory``: pieces a worker remembers,
    in one task; by default more, and from task to task."""

    def run(batches):
        own = coder(path, pattern, memory)
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                rows, ids_of = [], []
                for text in part.column(1):
                    text = text.as_py() or ""
                    ids = own.written(text)
                    digest, at, same = hashlib.sha256(), 0, True
                    each = ids.split(",") if ids else []
                    for data, piece in own.decoded(each):
                        digest.update(data)
                        same = same and text.startswith(piece, at)
                        at += len(piece)
                    rows.append((len(each), hashlib.sha256(ids.encode()).hexdigest(), digest.hexdigest(), same and at == len(text)))
                    if with_ids:
                        ids_of.append(np.array(each, np.int32))
                cols = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.string(), pa.string(), pa.bool_()))]
                more = [pa.array(ids_of, pa.list_(pa.int32()))] if with_ids else []
                yield pa.RecordBatch.from_arrays([part.column(0), *cols, *more], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "same", *(["ids"] if with_ids else [])])
        del own
        if memory:
            forget()
        else:
            give_back()

    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string, same boolean"
    return docs.mapInArrow(run, kind + (", ids array<int>" if with_ids else ""))
