"""Token ids in files: frequency ranks in byte-aligned variable-length coding with separate control bytes.

An id is written as its rank by corpus frequency (0: the commonest) in one to four bytes, least byte first. The
control bytes stand apart from the data: two bits per id (bytes less one), four ids a byte. Reading needs no loop over
ids: the control bytes index a table of lengths, their running sum gives the places, masks cut the values.

A token file set is a folder with two tables: ``ranks`` (rank, id) and ``blocks``, whose rows hold whole documents in
ascending id order as one binary block each, with the place of the block's first id in the whole stream.

Block layout, little endian: ``TKF1``, documents (u32), ids (u32), doc ids (i64 each; a bitmap of nulls before them),
ids per document (u32 each), control bytes, data bytes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpimill.llm.base import give_back, kept, parts_by_bytes
from kpimill.llm.chunks import CompiledVocabulary, ids_of
from kpimill.session import scratch_path

MAGIC = b"TKF1"
BLOCK_IDS = 1 << 16
COUNTERS = 8
# lengths of the four ids that a control byte speaks of
LENGTHS = np.stack([(np.arange(256) >> shift & 3) + 1 for shift in (0, 2, 4, 6)], axis=1).astype(np.uint8)
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def pack_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    code = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) <= code[:, None]]
    code = np.append(code, np.zeros(-len(code) % 4, np.uint8)).reshape(-1, 4).astype(np.uint8)
    return (code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6).tobytes(), data.tobytes()


def unpack_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    at = np.cumsum(lengths, dtype=np.int64) - lengths
    raw = np.append(np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)).astype(np.uint32)
    wide = raw[at] | raw[at + 1] << 8 | raw[at + 2] << 16 | raw[at + 3] << 24
    return wide & MASKS[lengths]


def write_block(doc_ids: list[int | None], counts: list[int], ranks: np.ndarray) -> bytes:
    control, data = pack_ranks(ranks)
    nulls = np.packbits([d is None for d in doc_ids], bitorder="little").tobytes()
    return b"".join([
        MAGIC, np.array([len(doc_ids), len(ranks)], "<u4").tobytes(), nulls, np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array(counts, "<u4").tobytes(), control, data,
    ])


def read_block(block: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Doc ids, ids per document, ranks of all documents in a row."""
    if block[:4] != MAGIC:
        raise ValueError("not a token block")
    docs, n = (int(x) for x in np.frombuffer(block[4:12], "<u4"))
    at = 12 + -(-docs // 8)
    nulls = np.unpackbits(np.frombuffer(block[12:at], np.uint8), count=docs, bitorder="little")
    ids = np.frombuffer(block, "<i8", docs, at).tolist()
    counts = np.frombuffer(block, "<u4", docs, at + 8 * docs)
    at += 12 * docs
    end = at + -(-n // 4)
    return [None if z else i for i, z in zip(ids, nulls)], counts, unpack_ranks(block[at:end], block[end:], n)


def write_token_files(df: DataFrame, path: str, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", block_ids: int = BLOCK_IDS) -> None:
    """Encode every text, append ``end_id`` and write the ids in ascending id order as a token file set under ``path``.

    Documents are dealt by ranges of their id (equal ids by their text, null ids first), encoded once and staged in
    order; the frequency of every id over all documents gives the ranks, and a second pass writes the blocks. The driver
    gets one row per id of the vocabulary and one per range.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("tie", F.xxhash64("text"))

    compiled = CompiledVocabulary(vocabulary)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, total = TaskContext.get().partitionId(), 0, np.zeros(0, np.int64)
        end = np.array([end_id], "<u4").tobytes()
        run = kept(f"chunks {vocabulary} {end_id}", lambda: compiled.batch_encoder(end))
        names = ["part", "start", "doc_id", "n", "ids"]
        for batch in (part for whole in batches for part in parts_by_bytes(whole, "text")):
            found = run(batch.column("text"))
            counts = pc.binary_length(found).to_numpy().astype(np.int64) // 4
            starts = place + np.cumsum(counts) - counts
            place += int(counts.sum())
            used = np.bincount(np.frombuffer(found.buffers()[2], "<u4", int(counts.sum())), minlength=len(total))
            used[: len(total)] += total
            total = used
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), part, np.int32)), pa.array(starts), batch.column("doc_id"), pa.array(counts), found], names)
            del found
        give_back()
        # the task's last row holds how often it used every id
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([-1], pa.int64()), pa.array([None], pa.int64()), pa.array([-1], pa.int64()), pa.array([total.astype("<i8").tobytes()], pa.binary())], names
        )

    stage = scratch_path(spark, "token-stage")
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    schema = "part int, start long, doc_id long, n long, ids binary"
    ordered.mapInArrow(encode, schema).write.option("compression", "zstd").parquet(stage)
    staged = spark.read.schema(schema).parquet(stage)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for blob in batch.column("ids").to_pylist():
                n = np.frombuffer(blob, "<i8")
                total, n = (total, n) if len(total) >= len(n) else (n, total)
                total = total.copy()
                total[: len(n)] += n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"])

    # summed in a few tasks first, so that no more rows are made than those tasks have ids
    gathered = staged.filter("n < 0").select("ids").repartition(COUNTERS)
    used = gathered.mapInArrow(counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    staged = staged.filter("n >= 0")
    by_rank = [r["id"] for r in sorted(used, key=lambda r: (-r["n"], r["id"]))]
    spark.createDataFrame(list(enumerate(by_rank)), "rank int, id int").coalesce(1).write.parquet(f"{path}/ranks")
    rank_of = np.zeros(max(by_rank, default=0) + 1, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank))
    parts = {r["part"]: r["n"] for r in staged.groupBy("part").agg(F.sum("n").alias("n")).collect()}
    before, place = {}, 0
    for p in sorted(parts):
        before[p] = place
        place += parts[p]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, counts, held, first, end, size = [], [], [], None, None, 0

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array([first], pa.int64()), pa.array([write_block(docs, counts, rank_of[np.concatenate(held)])], pa.binary())], ["start", "block"]
            )

        for batch in batches:
            for part, start, doc, n, blob in zip(*(batch.column(c).to_pylist() for c in ("part", "start", "doc_id", "n", "ids"))):
                start += before[part]
                # a block holds neighbours in the stream only
                if docs and (size >= block_ids or start != end):
                    yield out()
                    docs, counts, held, size = [], [], [], 0
                if not docs:
                    first = start
                docs.append(doc)
                counts.append(n)
                held.append(ids_of(blob))
                size += n
                end = start + n
        if docs:
            yield out()

    staged.mapInArrow(blocks, "start long, block binary").write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Every document of a token file set: doc_id, start (ids before it), n_tokens, ids (little-endian uint32), ids_crc32."""
    ranks = spark.read.parquet(f"{path}/ranks").collect()
    id_of = np.zeros(len(ranks), "<u4")
    for r in ranks:
        id_of[r["rank"]] = r["id"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, block in zip(batch.column("start").to_pylist(), batch.column("block").to_pylist()):
                docs, counts, found = read_block(block)
                blob = id_of[found].tobytes()
                ends = np.cumsum(counts, dtype=np.int64)
                cuts = (np.append(0, ends) * 4).tolist()
                ids = [blob[a:b] for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(docs, pa.int64()), pa.array(start + ends - counts, pa.int64()), pa.array(counts, pa.int64()),
                        pa.array(ids, pa.binary()), pa.array([zlib.crc32(b) for b in ids], pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids", "ids_crc32"],
                )

    return spark.read.parquet(f"{path}/blocks").mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary, ids_crc32 long")


def token_files(df: DataFrame, vocabulary: str, end_id: int = 2, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write a token file set (in the shared folder, or at ``path``) and read it back.

    Null and empty texts give the end id alone; null ids come first in the stream; rows with one id are all written, in
    the order of a hash of their text; an empty table gives an empty set; other columns of the input are ignored.
    """
    path = path or scratch_path(df.sparkSession, "token-files")
    write_token_files(df, path, vocabulary, end_id, id_col, text_col)
    return read_token_files(df.sparkSession, path)
