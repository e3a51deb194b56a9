"""Token-ID output in training order.

Texts are encoded, joined by an end token and cut into sequences of
``length`` ids (the last of each task is filled up with end tokens).  A keyed
Feistel permutation with cycle-walking maps the ordinal of every sequence to
a slot in 0 .. N - 1, so the order looks random, needs no sort or state, and
can be inverted.  Ranges of slots are the shards: little-endian 16-bit ids in
files of a fixed stride, where slot s stands in shard s // per_shard at byte
(s % per_shard) * stride.  Reading from any slot on is a seek.

Ordinals follow the files and rows as scanned; they are frozen in a written
table before any slot is given, so lost executors never change them.  What
reaches the driver is one count for each partition of that table.  A task
has the slots of consecutive shards; its partition is computed from the slot,
so tasks are equal in size and none is empty.

The output folder must be new and seen by all executors; its path is made
whole on the driver, so a plain one lies on Spark's default file system for
every part of the output.  A shard is written among the attempts, under a
name of the task's own, and renamed when it is whole; an attempt that comes
after another one leaves that file in place.  At the end the attempts and
the frozen sequences are deleted, number and bytes of the shards are
compared with what is due (an error if executors wrote to disks of their
own), and the table ``about`` is written last: a folder with it is whole.

Defined results: a null text is empty; an empty text is an end token only
and has one piece of no ids; ids of any type are kept, null ids too;
identical rows each have their place; an empty table has no sequence, no
shard and no rows; other columns aren't read.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from slaflow.llm.common import shared_path, text_or_empty
from slaflow.llm.words import mix
from slaflow.plans.publication import qualified

LENGTH = 2048
PER_SHARD = 4096
ROUNDS = 6
#: Of the ids on their way from the scan to their shard.
PACK_LEVEL = 9
#: Bytes of the shards that one task writes, at most (one shard at least).
TASK_BYTES = 256 << 20


class Permutation:
    """A keyed bijection of 0 .. n - 1."""

    def __init__(self, n: int, key: int):
        self.n = n
        self.half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        self.keys = mix(np.uint64(key & 0xFFFFFFFFFFFFFFFF) + np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def _once(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for k in self.keys:
            left, right = right, left ^ (mix(right ^ k) & self.mask)
        return (left << self.half) | right

    def _back(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for k in self.keys[::-1]:
            left, right = right ^ (mix(left ^ k) & self.mask), left
        return (left << self.half) | right

    def _walk(self, x: np.ndarray, step) -> np.ndarray:
        x = step(np.asarray(x).astype(np.uint64))
        while len(out := np.flatnonzero(x >= np.uint64(self.n))):
            x[out] = step(x[out])
        return x.astype(np.int64)

    def slot(self, ordinals: np.ndarray) -> np.ndarray:
        return self._walk(ordinals, self._once)

    def ordinal(self, slots: np.ndarray) -> np.ndarray:
        return self._walk(slots, self._back)


def encoding(path: str):
    """The byte-level BPE of a rank file, with the cut pattern of its library."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _pieces_type(id_type: DataType) -> str:
    return f"array<struct<doc_id:{id_type.simpleString()},piece:int,start:int,n_tokens:int>>"


def _cut(path: str, length: int, end: int, id_type: DataType):
    """Of (part, doc_id, text): the sequences of a task with their pieces."""
    a_piece = pa.struct([("doc_id", to_arrow_type(id_type)), ("piece", pa.int32()), ("start", pa.int32()), ("n_tokens", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(path)
        held = np.zeros(0, np.uint16)
        pieces: list[list[dict]] = [[]]
        pos, part = 0, None

        def take(whole: bool) -> pa.RecordBatch | None:
            nonlocal held, pieces, pos
            n = len(held) // length
            if whole and len(held) % length:
                held = np.append(held, np.full(-len(held) % length, end, np.uint16))
                n += 1
            if not n:
                return None
            rows = held[: n * length].astype("<u2").reshape(n, length)
            out = pa.RecordBatch.from_arrays(
                [pa.array([part] * n, pa.int32()), pa.array(range(pos, pos + n), pa.int64()),
                 pa.array([r.tobytes() for r in rows], pa.binary()), pa.array(pieces[:n], pa.list_(a_piece))],
                ["part", "pos", "tokens", "pieces"],
            )
            held, pieces, pos = held[n * length :], pieces[n:] or [[]], pos + n
            return out

        for batch in batches:
            if batch.num_rows:
                part = batch.column(0)[0].as_py()
            for doc, text in zip(batch.column(1).to_pylist(), batch.column(2)):
                ids = np.array([*encoder.encode_ordinary(text.as_py()), end], np.uint16)
                at, done, piece = len(held), 0, 0
                held = np.append(held, ids)
                while done < len(ids):
                    k, start = divmod(at + done, length)
                    n = min(length - start, len(ids) - done)
                    own = min(n, len(ids) - 1 - done)  # without the end token
                    while len(pieces) <= k:
                        pieces.append([])
                    if own or not piece:
                        pieces[k].append({"doc_id": doc, "piece": piece, "start": start, "n_tokens": own})
                    done, piece = done + n, piece + 1
                if len(held) >= 64 * length and (out := take(False)):
                    yield out
        if out := take(True):
            yield out

    return run


def _deal(offsets: dict[int, int], order: Permutation):
    """Slots of (part, pos, tokens, pieces); the ids go on compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(PACK_LEVEL).compress
        for batch in batches:
            first = np.array([offsets[p] for p in batch.column(0).to_pylist()], np.int64)
            slots = order.slot(first + batch.column(1).to_numpy())
            packed = pa.array([pack(t) for t in batch.column(2).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(slots), packed, batch.column(3)], ["slot", "packed", "pieces"])

    return run


def filesystem(path: str):
    """The file system of a path or URI, and the path in it."""
    import re

    import pyarrow.fs

    path = re.sub(r"^file:/+", "/", path)
    return pyarrow.fs.FileSystem.from_uri(path) if "://" in path else (pyarrow.fs.LocalFileSystem(), path)


def shard_name(shard: int) -> str:
    return f"shard-{shard:08d}.u16"


def _keep(fs, own: str, target: str, size: int) -> None:
    """Rename a whole shard, unless an attempt before has done so."""
    if fs.get_file_info(target).size != size:
        try:
            return fs.move(own, target)
        except OSError:  # some file systems refuse a name that another attempt has just taken
            if fs.get_file_info(target).size != size:
                raise
    fs.delete_file(own)


def _write(path: str, per_shard: int, stride: int):
    """Write the shards of (shard, slot, packed, pieces), sorted by slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        fs, folder = filesystem(path)
        shard, out, own, due = None, None, None, 0

        def close() -> None:
            if out is not None:
                out.close()
                _keep(fs, own, f"{folder}/shards/{shard_name(shard)}", (due - shard * per_shard) * stride)

        for batch in batches:
            for k, slot, packed in zip(*(batch.column(c).to_pylist() for c in (0, 1, 2))):
                if k != shard:
                    close()
                    shard, own = k, f"{folder}/attempts/{shard_name(k)}-{uuid.uuid4().hex}"
                    out, due = fs.open_output_stream(own), k * per_shard
                if slot != due:
                    raise ValueError(f"slot {slot} where {due} is due")
                out.write(unpack(packed))
                due += 1
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3)], ["shard", "slot", "pieces"])
        close()

    return run


def write_training_order(
    docs: DataFrame,
    ranks_path: str,
    path: str | None = None,
    key: int = 20240601,
    length: int = LENGTH,
    per_shard: int = PER_SHARD,
    end_id: int = 50256,
    id_col: str = "doc_id",
    text_col: str = "text",
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """Write shards and index of a table under ``path`` (default: a new shared
    folder); the rows are the pieces of the texts: (doc_id, piece, slot,
    shard, start, n_tokens)."""
    spark = docs.sparkSession
    hadoop, root = qualified(spark, path or shared_path(spark, "training-order"))
    path, stride = root.toString(), 2 * length
    below = lambda name: spark._jvm.org.apache.hadoop.fs.Path(root, name)
    rows = docs.select(F.spark_partition_id().alias("part"), F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType
    pieces = _pieces_type(id_type)
    cut = rows.mapInArrow(_cut(ranks_path, length, end_id, id_type), f"part int, pos long, tokens binary, pieces {pieces}")
    packed = {"compression": "zstd", "parquet.compression.codec.zstd.level": PACK_LEVEL}
    cut.write.options(**packed).parquet(f"{path}/sequences")
    sequences = spark.read.parquet(f"{path}/sequences")
    counts = sorted((r["part"], r["count"]) for r in sequences.groupBy("part").count().collect())
    offsets, n = {}, 0
    for part, count in counts:
        offsets[part], n = n, n + count

    hadoop.mkdirs(below("shards"))
    hadoop.mkdirs(below("attempts"))
    dealt = sequences.mapInArrow(_deal(offsets, Permutation(n, key)), f"slot long, packed binary, pieces {pieces}")
    ranges = dealt.select(F.floor(F.col("slot") / per_shard).cast("int").alias("shard"), "slot", "packed", "pieces")
    n_shards = -(-n // per_shard)
    spread = n_shards // spark.sparkContext.defaultParallelism
    per_task = max(1, min(spread, task_bytes // (per_shard * stride)))
    n_tasks = max(1, -(-n_shards // per_task))
    task = F.floor(F.col("shard") / per_task).cast("int")
    index = ranges.repartitionById(n_tasks, task).sortWithinPartitions("slot").mapInArrow(
        _write(path, per_shard, stride), f"shard int, slot long, pieces {pieces}"
    )
    index.write.parquet(f"{path}/index")
    for name in ("attempts", "sequences"):
        hadoop.delete(below(name), True)
    found = hadoop.getContentSummary(below("shards"))
    if (found.getFileCount(), found.getLength()) != (n_shards, n * stride):
        raise RuntimeError(
            f"{found.getFileCount()} shards of {found.getLength()} bytes in {path}/shards instead of {n_shards} of "
            f"{n * stride}: the folder must be one that all executors share"
        )
    about = [(n, length, stride, per_shard, key, end_id)]
    spark.createDataFrame(
        about, "sequences long, length int, stride int, per_shard int, key long, end_id int"
    ).coalesce(1).write.parquet(f"{path}/about")
    return spark.read.parquet(f"{path}/index").select("slot", "shard", F.explode("pieces").alias("p")).select(
        "p.doc_id", "p.piece", "slot", "shard", "p.start", "p.n_tokens"
    )


def read_slots(path: str, first: int, count: int, length: int = LENGTH, per_shard: int = PER_SHARD) -> Iterator[np.ndarray]:
    """The sequences of ``count`` slots from ``first`` on (fewer at the end
    of the last shard): a seek, then sequential reads.  A path without a scheme
    is a local one here."""
    import pyarrow.fs

    fs, folder = filesystem(path)
    stride, slot = 2 * length, first
    while slot < first + count:
        name = f"{folder}/shards/{shard_name(slot // per_shard)}"
        if fs.get_file_info(name).type == pyarrow.fs.FileType.NotFound:
            return
        with fs.open_input_file(name) as f:
            f.seek(slot % per_shard * stride)
            for _ in range(min(per_shard - slot % per_shard, first + count - slot)):
                record = f.read(stride)
                if len(record) < stride:
                    return
                yield np.frombuffer(record, "<u2")
                slot += 1
