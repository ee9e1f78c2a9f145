"""Repeated word windows: Rabin-Karp hashes of every window of ``width`` words, counted by hash; repeated ones merge into
maximal removal intervals.

Words get 64-bit ids from their bytes; two rolling (Rabin-Karp) hashes over those ids name every window of every text. A
window is removed from a document if it also starts in a document with a smaller id, so all that is asked of a window is
the smallest document that holds it. Tasks sort the windows of a bounded stretch of texts, keep each hash once with the
smallest document they know, and send the rest on as found already: a window in a third of all documents reaches the
counting task once per stretch. The second hash deals windows to buckets of bounded size, and both must agree, so the
chance of a false match stays small as buckets are added with the data.

What is shuffled are blocks: the windows of one stretch in one bucket as sorted hashes, stored as differences, some eight
bytes a window with the document, instead of one row for each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpimill.llm.base import texts_of

WIDTH = 13
STRETCH = 1 << 20  # windows that a task sorts at once
BUCKET_BYTES = 16 << 20  # text behind a bucket of windows, and behind a shard of documents
SLICE = 1 << 16  # words that are hashed at once


def _odd(seed: int) -> int:
    return int(np.random.default_rng(seed).integers(0, 2**61)) * 8 + 3


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, np.uint64(base))
    p[:1] = 1
    return np.multiply.accumulate(p)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Rabin-Karp hashes modulo 2**64 of stretches of a sequence, from running sums of values times falling powers."""

    def __init__(self, seed: int):
        base = _odd(seed)
        self.base, self.inverse, self.up, self.down = base, pow(base, -1, 2**64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)

    def _sums(self, values: np.ndarray) -> np.ndarray:
        n = len(values)
        if len(self.up) < n:
            self.up, self.down = _powers(self.base, max(n, SLICE)), _powers(self.inverse, max(n, SLICE))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * self.down[:n], out=sums[1:])
        return sums

    def between(self, values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        sums = self._sums(values)
        return mixed((sums[stop] - sums[start]) * self.up[start])

    def windows(self, values: np.ndarray, width: int) -> np.ndarray:
        sums, n = self._sums(values), len(values) - width + 1
        return mixed((sums[width:] - sums[:n]) * self.up[:n])


class Windows:
    """The two hashes of every window of a text."""

    def __init__(self, width: int):
        self.width, self.letters, self.first, self.second = width, Rolling(1), Rolling(2), Rolling(3)
        self.byte = np.random.default_rng(4).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def ids(self, words: list[bytes]) -> np.ndarray:
        """64-bit ids of words, a bounded number of them at a time."""
        out = [np.zeros(0, np.uint64)]
        for a in range(0, len(words), SLICE):
            data = np.frombuffer(b" ".join(words[a : a + SLICE]), np.uint8)
            stop = np.append(np.flatnonzero(data == 32), len(data))
            out.append(self.letters.between(self.byte[data], np.concatenate([[0], stop[:-1] + 1]), stop))
        return np.concatenate(out)

    def of_ids(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(ids) < self.width:
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        return self.first.windows(ids, self.width), self.second.windows(mixed(ids + np.uint64(1)), self.width)


def words_of(text: str) -> list[bytes]:
    """Maximal runs of bytes other than space, tab, newline, vertical tab, form feed and carriage return."""
    return text.encode(errors="surrogatepass").split()


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """The maximal intervals (start, stop) of n words that windows at these places cover."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    inside = np.concatenate([[0], (np.cumsum(edge[:-1]) > 0).astype(np.int8), [0]])
    turns = np.flatnonzero(np.diff(inside))
    return turns.reshape(-1, 2)


# --- blocks of hashes -------------------------------------------------------------------------------------------------------


def _planes(a: np.ndarray) -> bytes:
    """A number column byte plane by byte plane, compressed: high planes are mostly zeros."""
    return zstandard.ZstdCompressor(level=1).compress(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())


def _unplaned(blob: bytes, kind: np.dtype) -> np.ndarray:
    raw, size = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8), np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


def dump_block(hashes: np.ndarray, docs: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Ascending hashes with the document of each: differences, the documents that occur, and the place of each among them."""
    known, place = np.unique(docs, return_inverse=True)
    return _planes(np.diff(hashes, prepend=np.uint64(0))), _planes(np.diff(known, prepend=0)), _planes(place.astype(np.uint32))


def load_block(hashes: bytes, known: bytes, place: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(_unplaned(hashes, np.uint64), dtype=np.uint64), np.cumsum(_unplaned(known, np.int64))[_unplaned(place, np.uint32)]


BLOCK = "at int, sure boolean, hashes binary, known binary, place binary"
NAMES = ["at", "sure", "hashes", "known", "place"]


def _block_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], NAMES)


def _blocks(at: np.ndarray, sure: bool, hashes: np.ndarray, docs: np.ndarray) -> Iterator[tuple]:
    """Block rows of pairs dealt by ``at``; hashes ascend within each."""
    order = np.lexsort((hashes, at))
    at, hashes, docs = at[order], hashes[order], docs[order]
    cuts = np.append(np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])), len(at)) if len(at) else np.zeros(1, int)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        yield (int(at[a]), sure, *dump_block(hashes[a:b], docs[a:b]))


def split_later(hashes: np.ndarray, other: np.ndarray | None, docs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Pairs (window, document) sorted by hash as two: those of the smallest document of each window, and those of a
    larger one; a pair that stands several times counts once in the first part."""
    order = np.argsort(hashes, kind="stable")
    hashes, docs = hashes[order], docs[order]
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    if other is not None:
        other = other[order]
        new[1:] |= other[1:] != other[:-1]
    cuts = np.flatnonzero(new)
    least = np.repeat(np.minimum.reduceat(docs, cuts), np.diff(np.append(cuts, len(docs)))) if len(docs) else docs
    later = docs > least
    return hashes, other, docs, new, later, least


def post_windows(rows: DataFrame, width: int, buckets: int, shards: int) -> DataFrame:
    """Blocks of (window, document): to be counted in bucket ``at``, or ``sure``, found to be repeated already, for shard ``at``
    of the documents. Rows with a null id post nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, held, count = Windows(width), [], 0

        def flush() -> list[tuple]:
            h, g, d = (np.concatenate(x) for x in zip(*held))
            h, g, d, new, later, least = split_later(h, g, d)
            lead = np.flatnonzero(new)
            out = list(_blocks((g[lead] % np.uint64(buckets)).astype(np.int32), False, h[lead], least[lead]))
            return out + list(_blocks(shard_of(d[later], shards), True, h[later], d[later]))

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch, "text")):
                if doc is None:
                    continue
                h, g = make.of_ids(make.ids(words_of(text)))
                # a long text is dealt with by the stretch as well
                for a in range(0, len(h), STRETCH):
                    held.append((h[a : a + STRETCH], g[a : a + STRETCH], np.full(len(h[a : a + STRETCH]), doc, np.int64)))
                    count += len(held[-1][0])
                    if count >= STRETCH:
                        yield _block_rows(flush())
                        held, count = [], 0
        if count:
            yield _block_rows(flush())

    return rows.mapInArrow(run, BLOCK)


def shard_of(docs: np.ndarray, shards: int) -> np.ndarray:
    return (mixed(docs.astype(np.int64).view(np.uint64)) % np.uint64(shards)).astype(np.int32)


def count_windows(blocks: DataFrame, buckets: int, shards: int) -> DataFrame:
    """Blocks of (window, document) by shard of the documents, for windows that a smaller document holds too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def close() -> list[tuple]:
            h, d = (np.concatenate(x) for x in zip(*(load_block(*b) for b in held)))
            h, _, d, _, later, _ = split_later(h, None, d)
            return list(_blocks(shard_of(d[later], shards), True, h[later], d[later]))

        for batch in batches:
            out = []
            for row in zip(*(batch.column(c).to_pylist() for c in NAMES)):
                if row[1]:
                    out.append(row)
                    continue
                if row[0] != at and held:
                    out += close()
                    held = []
                at = row[0]
                held.append(row[2:])
            if out:
                yield _block_rows(out)
        if held and (out := close()):
            yield _block_rows(out)

    return blocks.repartitionById(buckets, "at").sortWithinPartitions("at", "sure").mapInArrow(run, BLOCK)


def pack_words(rows: DataFrame, shards: int) -> DataFrame:
    """(at, doc_id, packed): every document's words, compressed, with the shard it belongs to; null ids are spread by text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            if batch.num_rows:
                packed = [packer.compress(b" ".join(words_of(t))) for t in texts_of(batch, "text")]
                ids = batch.column("doc_id").to_pylist()
                key = np.array([len(p) if i is None else i for i, p in zip(ids, packed)], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(shard_of(key, shards)), batch.column("doc_id"), pa.array(packed, pa.binary())], ["at", "doc_id", "packed"])

    return rows.mapInArrow(run, "at int, doc_id long, packed binary")


FOUND = "doc_id long, n_words long, n_removed long, spans array<struct<start:int,stop:int>>, kept_sha256 string, kept_text string"


def _cut(width: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, unpack = Windows(width), zstandard.ZstdDecompressor()
        at, held, hashes, docs, cuts = None, [], None, None, None

        def gone(doc: int | None) -> np.ndarray:
            """Hashes of the windows to remove from a document."""
            if doc is None or docs is None:
                return np.zeros(0, np.uint64)
            i = np.searchsorted(docs, doc)
            return hashes[cuts[i] : cuts[i + 1]] if i < len(docs) and docs[i] == doc else np.zeros(0, np.uint64)

        for batch in batches:
            out = []
            for part, doc, packed, *block in zip(*(batch.column(c).to_pylist() for c in ("at", "doc_id", "packed", "hashes", "known", "place"))):
                if part != at:
                    at, held, hashes, docs, cuts = part, [], None, None, None
                if packed is None:
                    held.append(load_block(*block))
                    continue
                if held:  # the shard's blocks come before its documents
                    h, d = (np.concatenate(x) for x in zip(*held))
                    order = np.argsort(d, kind="stable")
                    hashes, d, held = h[order], d[order], []
                    docs, cuts = np.unique(d, return_index=True)
                    cuts = np.append(cuts, len(d))
                words, found = unpack.decompress(packed).split(), gone(doc)
                kept, spans = words, []
                if len(found):
                    h, _ = make.of_ids(make.ids(words))
                    spans = covered(np.flatnonzero(np.isin(h, found)), width, len(words)).tolist()
                    kept, last = [], 0
                    for a, b in spans:
                        kept += words[last:a]
                        last = b
                    kept += words[last:]
                rest = b" ".join(kept)
                out.append((doc, len(words), len(words) - len(kept), [{"start": a, "stop": b} for a, b in spans], hashlib.sha256(rest).hexdigest(), rest.decode(errors="surrogatepass") if with_text else None))
            if out:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["doc_id", "n_words", "n_removed", "spans", "kept_sha256", "kept_text"])

    return run


def remove_windows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, with_text: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, spans (maximal removed intervals of words, [start, stop)),
    kept_sha256 (of the kept words joined by one space, UTF-8) and kept_text (only ``with_text``, else null).

    Words are maximal runs of characters other than space, tab, newline, vertical tab, form feed and carriage return, as
    they stand. Removed is every word covered by a window of ``width`` words that also starts in a document with a smaller
    id; windows overlap, never cross texts, and are judged on the input. A null or empty text has no words; shorter texts
    have no window and keep all. A row with a null id is no document to others and loses nothing. Rows that share an id
    don't count against one another, whatever their texts. An empty table gives no rows; other columns are ignored.
    """
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = buckets = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    found = count_windows(post_windows(rows, width, buckets, shards), buckets, shards)
    nothing = [F.lit(None).cast("binary").alias(c) for c in ("hashes", "known", "place")]
    texts = pack_words(rows, shards).select("at", "doc_id", "packed", *nothing)
    blocks = found.select("at", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("packed"), "hashes", "known", "place")
    dealt = blocks.unionByName(texts).repartitionById(shards, "at").sortWithinPartitions("at", F.col("packed").isNotNull())
    return dealt.mapInArrow(_cut(width, with_text), FOUND)
