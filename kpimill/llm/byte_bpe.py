"""Byte-level BPE as a lazily determinised transducer, and a streaming decoder.

The merges are compiled into a trie of the tokens' bytes and a test of which two tokens may stand next to one another:
a token sequence is the BPE encoding of its bytes exactly when every neighbouring pair survives merging. While bytes
come in, a state holds one item per place where a token could have begun: a trie node, and the tokens before that
place which are not decided yet. Tokens that all items agree on are emitted; that is after at most the longest token's
bytes. States and transitions are made when they are first met and kept, up to a bound, after which the machine starts
with an empty table again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpimill.llm.base import by_batch, kept, texts_of
from kpimill.llm.chunks import ChunkEncoder, ids_of

KEPT_TRANSITIONS = 600_000
KEPT_PAIRS = 500_000
KEPT_MATCHES = 400_000
KEPT_CHUNKS = 700_000


def load_ranks(path: str) -> dict[bytes, int]:
    """A ranks file: base64 of a token's bytes and its rank per line."""
    import base64

    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f) if token}


class Merges:
    """What the ranks say about single tokens and pairs of tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._pairs: dict[int, bool] = {}
        self._edges: tuple[dict, dict] = {}, {}

    def merged(self, text: bytes, below: int) -> list[bytes]:
        """Plain merging with ranks under ``below``: always the lowest rank first, the leftmost of equals."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge gives this one; None for single bytes. A token that merging never makes: (-1, -1)."""
        if token not in self._halves:
            text = self.tokens[token]
            parts = self.merged(text, token) if len(text) > 1 else []
            self._halves[token] = None if len(text) == 1 else (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else (-1, -1)
        return self._halves[token]

    def made(self, token: int) -> bool:
        return self.halves(token) != (-1, -1)

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens at one end (side 0: left end, 1: right end) while ``token`` is built, and the rank that ends each."""
        known = self._edges[side].get(token)
        if known is None:
            known, at, ends = [], token, float("inf")
            while True:
                known.append((at, ends))
                parts = self.halves(at)
                if parts is None:
                    break
                ends, at = at, parts[side]
            self._edges[side][token] = known
        return known

    def may_follow(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both keeps them as these two tokens (left -1: nothing stands before)."""
        key = (left + 1) << 32 | right
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= KEPT_PAIRS:
                self._pairs.clear()
            known = self._pairs[key] = self.made(right) and (left < 0 or self._border_holds(left, right))
        return known

    def _border_holds(self, left: int, right: int) -> bool:
        """No merge across the border comes first. One takes place if its rank is under the one that takes its left part
        away, and not over the one that takes its right part away (of equal ranks the left place merges first)."""
        get, tokens = self.ranks.get, self.tokens
        heads = [(tokens[b], end) for b, end in self._edge(right, 0)]
        for a, a_end in self._edge(left, 1):
            text = tokens[a]
            for b, b_end in heads:
                rank = get(text + b)
                if rank is not None and rank < a_end and rank <= b_end:
                    return False
        return True

class Transducer:
    """Bytes in, tokens out. An item of a state: (trie node, pending tokens before it); the last one is where a token
    would begin now. ``last`` is the last token already emitted (-1 at the start)."""

    def __init__(self, ranks: dict[bytes, int], bound: int = KEPT_TRANSITIONS):
        self.merges, self.bound = Merges(ranks), bound
        self.children: dict[int, int] = {}  # node * 256 + byte -> node
        self.token: list[int] = [-1]
        self.inner: list[bool] = [True]  # whether a node has children
        children = self.children
        for text, rank in ranks.items():
            node = 0
            for byte in text:
                nxt = children.get(node << 8 | byte)
                if nxt is None:
                    self.inner[node] = True
                    nxt = children[node << 8 | byte] = len(self.token)
                    self.token.append(-1)
                    self.inner.append(False)
                node = nxt
            self.token[node] = rank
        self._reset()

    def _reset(self) -> None:
        start = (-1, ((0, ()),))
        for moves in getattr(self, "number", {}).values():
            moves.clear()  # states point at one another in circles
        self.start: dict = {None: start}
        self.number: dict[tuple, dict] = {start: self.start}
        self.made = 0

    def _step(self, state: tuple, byte: int) -> tuple[tuple, tuple[int, ...]]:
        last, items = state
        children, tokens, inner = self.children, self.token, self.inner
        live, done = [], None
        for item in items:
            child = children.get(item[0] << 8 | byte)
            if child is None:
                continue
            path = item[1]
            if done is None and (token := tokens[child]) >= 0:
                before = path[-1] if path else last
                if self.merges.may_follow(before, token):
                    done = path + (token,)
            if inner[child]:
                live.append((child, path))
        if done is None:
            raise ValueError(f"byte {byte} is no token")
        live.append((0, done))
        common = live[0][1]
        if not common:
            return (last, tuple(live)), ()
        for _, path in live[1:]:
            if path[0] != common[0]:
                # every item has tokens of its own before it: the last one emitted no longer matters
                return (-2, tuple(live)), ()
        for _, path in live[1:]:
            n = 1
            while n < len(common) and n < len(path) and common[n] == path[n]:
                n += 1
            common = common[:n]
        n = len(common)
        live = [(node, path[n:]) for node, path in live]
        return (common[-1] if not live[0][1] or not all(path for _, path in live) else -2, tuple(live)), common

    def encode(self, text: bytes) -> list[int]:
        """The tokens of one stretch of bytes."""
        out: list[int] = []
        at = self.start
        for byte in text:
            move = at.get(byte)
            if move is None:
                state = at[None]
                if self.made >= self.bound:
                    self._reset()
                    at = self._place(state)
                nxt, emitted = self._step(state, byte)
                move = at[byte] = (self._place(nxt), emitted)
                self.made += 1
            at, emitted = move
            if emitted:
                out += emitted
        out += at[None][1][-1][1]
        return out

    def _place(self, state: tuple) -> dict:
        """The moves of a state: byte -> (moves of the next state, tokens emitted); the state itself is under None."""
        moves = self.number.get(state)
        if moves is None:
            moves = self.number[state] = {None: state}
        return moves


def transducer_encoder(ranks: dict[bytes, int], pattern: str, bound: int = KEPT_MATCHES):
    """Many chunks to ids: each match of the pattern goes through the transducer by itself. The ids of short matches are
    kept, up to a bound."""
    machine, find = Transducer(ranks), regex.compile(pattern).findall
    known: dict[str, tuple[int, ...]] = {}

    def many(chunks: list[str]) -> list[bytes]:
        out = []
        for chunk in chunks:
            ids: list[int] = []
            for match in find(chunk):
                found = known.get(match)
                if found is None:
                    found = machine.encode(match.encode())
                    if len(match) < 40:
                        if len(known) >= bound:
                            known.clear()
                        known[match] = tuple(found)
                ids += found
            out.append(pack(f"<{len(ids)}I", *ids))
        return out

    return many


class Utf8Machine:
    """Incremental UTF-8: bytes in pieces of any size, characters out as soon as they are whole.

    The state is the bytes of the character that has begun and the range the next byte must lie in. A byte that does
    not fit ends the broken character as U+FFFD and is looked at afresh, as in Unicode's recommended practice.
    """

    def __init__(self):
        self.held = b""
        self.need, self.low, self.high = 0, 0x80, 0xBF

    def feed(self, data: bytes) -> str:
        out: list[str] = []
        i, n = 0, len(data)
        while i < n:
            if not self.need:
                # whole stretches at once: up to the last byte that could begin an unfinished character
                j = n
                while j > i and n - j < 3 and 0x80 <= data[j - 1] <= 0xBF:
                    j -= 1
                if j > i and data[j - 1] >= 0xC0:
                    j -= 1
                else:
                    j = n
                if j > i:
                    try:
                        out.append(data[i:j].decode())
                        i = j
                        continue
                    except UnicodeDecodeError as broken:
                        out.append(data[i : i + broken.start].decode())
                        i += broken.start
            i = self._byte(data, i, out)
        return "".join(out)

    def _byte(self, data: bytes, i: int, out: list[str]) -> int:
        """One byte through the state machine; the place of the next byte to look at."""
        b = data[i]
        if not self.need:
            if b < 0x80:
                out.append(chr(b))
            elif 0xC2 <= b <= 0xF4:
                self.held = data[i : i + 1]
                self.need = 1 if b < 0xE0 else 2 if b < 0xF0 else 3
                self.low = {0xE0: 0xA0, 0xF0: 0x90}.get(b, 0x80)
                self.high = {0xED: 0x9F, 0xF4: 0x8F}.get(b, 0xBF)
            else:
                out.append("�")
            return i + 1
        if self.low <= b <= self.high:
            self.held += data[i : i + 1]
            self.need, self.low, self.high = self.need - 1, 0x80, 0xBF
            if not self.need:
                out.append(self.held.decode())
                self.held = b""
            return i + 1
        out.append("�")
        self.held, self.need, self.low, self.high = b"", 0, 0x80, 0xBF
        return i

    def finish(self) -> str:
        left = "�" if self.need else ""
        self.__init__()
        return left


class StreamDecoder:
    """Ids to text, a piece at a time."""

    def __init__(self, ranks: dict[bytes, int]):
        self.token = [b""] * (max(ranks.values(), default=-1) + 1)
        for text, rank in ranks.items():
            self.token[rank] = text

    def decode(self, ids: list[int], piece: int = 4096) -> Iterable[str]:
        machine = Utf8Machine()
        for i in range(0, len(ids), piece):
            yield machine.feed(b"".join(map(self.token.__getitem__, ids[i : i + piece])))
        yield machine.finish()


def encode_decode(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", content: bool = True) -> DataFrame:
    """Encode every text and decode its ids again: one row per input row with doc_id, n_tokens, ids_sha256 (of the decimal
    ids joined by a space), decoded_sha256 and, unless ``content`` is off, ids (array<int>) and decoded (string).

    Every match of the pattern is encoded separately; there are no special tokens. Null and empty texts have no tokens
    and the digests of nothing; rows with equal or null ids each give a row; an empty table gives none; other columns of
    the input are ignored. Memory in a task: one Arrow batch, and tables of bounded size.
    """

    def make():
        ranks = load_ranks(ranks_path)
        decoder = StreamDecoder(ranks)
        encode = kept(f"transducer {ranks_path} {pattern}", lambda: ChunkEncoder(transducer_encoder(ranks, pattern), KEPT_CHUNKS))
        decimal = [str(i) for i in range(max(ranks.values()) + 1)]

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, ids_hex, text_hex, all_ids, decoded = [], [], [], [], []
            for text in texts_of(batch, "text"):
                found = ids_of(encode(text))
                ids = found.tolist()
                back = list(decoder.decode(ids))
                n.append(len(ids))
                ids_hex.append(hashlib.sha256(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                digest = hashlib.sha256()
                for piece in back:
                    digest.update(piece.encode())
                text_hex.append(digest.hexdigest())
                if content:
                    all_ids.append(found.view(np.int32))
                    decoded.append("".join(back))
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_hex), pa.array(text_hex)]
            if content:
                ends = np.cumsum([0, *map(len, all_ids)], dtype=np.int32)
                columns += [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(all_ids), pa.int32())), pa.array(decoded, pa.string())]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][: len(columns)])

        return step

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return by_batch(rows, make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if content else ""))
