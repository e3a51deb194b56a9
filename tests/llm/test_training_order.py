from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from slaflow.llm import training_order as to

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 63, 64, 65, 1000, 4097])
def test_permutation_is_a_bijection_with_an_inverse(n):
    order = to.Permutation(n, 99)
    slots = order.slot(np.arange(n))
    assert sorted(slots) == list(range(n))
    assert np.array_equal(order.ordinal(slots), np.arange(n))
    if n > 60:
        assert not np.array_equal(slots, to.Permutation(n, 100).slot(np.arange(n)))
        assert np.mean(np.abs(slots - np.arange(n))) > n / 5


def texts_back(rows, sequences):
    encoder = to.encoding(PATH)
    pieces = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append((r["piece"], r["slot"], r["start"], r["n_tokens"]))
    out = {}
    for doc, own in pieces.items():
        assert sorted(p[0] for p in own) == list(range(len(own)))
        ids = [int(x) for _, slot, start, n in sorted(own) for x in sequences[slot][start : start + n]]
        assert 50256 not in ids
        out[doc] = encoder.decode(ids)
    return out


def test_round_trip(spark, tmp_path):
    from conftest import SF001
    from llm.conftest import load

    path = str(tmp_path / "out")
    docs = spark.read.parquet(f"{SF001}/documents.parquet").repartition(3)
    rows = to.write_training_order(docs, PATH, path, length=128, per_shard=100).collect()
    sequences = list(to.read_slots(path, 0, 10**6, 128, 100))
    assert texts_back(rows, sequences) == {r["doc_id"]: r["text"] for r in load(f"{SF001}/documents.parquet")}
    assert {r["slot"] for r in rows} <= set(range(len(sequences))) and all(r["shard"] == r["slot"] // 100 for r in rows)
    about = spark.read.parquet(f"{path}/about").first()
    assert about["sequences"] == len(sequences) and about["stride"] == 256
    # reading goes on from any slot, across shards
    for first in (0, 37, 99, 100, 201, len(sequences) - 1, len(sequences)):
        got = list(to.read_slots(path, first, 150, 128, 100))
        assert len(got) == min(150, len(sequences) - first)
        assert all(np.array_equal(a, b) for a, b in zip(got, sequences[first:]))


def plain_slot(ordinal, n, key):
    """The permutation in whole numbers, written out anew."""
    word = (1 << 64) - 1

    def scramble(x):
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & word
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & word
        return x ^ (x >> 31)

    bits = 1
    while (1 << (2 * bits)) < n:
        bits += 1
    keys = [scramble((key + r * 0x9E3779B97F4A7C15) & word) for r in range(1, 7)]
    x = ordinal
    while True:
        left, right = divmod(x, 1 << bits)
        for k in keys:
            left, right = right, left ^ (scramble(right ^ k) % (1 << bits))
        x = (left << bits) + right
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 5, 64, 257, 5000])
def test_slots_of_an_independent_permutation(n):
    assert [plain_slot(i, n, 7) for i in range(n)] == to.Permutation(n, 7).slot(np.arange(n)).tolist()


def plain_sequences(spark, table, length, key):
    """Sequences in training order, from the texts of each scanned partition."""
    encoder, every = to.encoding(PATH), []
    parts = table.select(to.F.spark_partition_id().alias("part"), "text").toPandas()
    for _, group in parts.groupby("part", sort=True):
        ids = [x for t in group["text"] for x in [*encoder.encode_ordinary(t or ""), 50256]]
        ids += [50256] * (-len(ids) % length)
        every += [ids[i : i + length] for i in range(0, len(ids), length)]
    out = [None] * len(every)
    for i, ids in enumerate(every):
        out[plain_slot(i, len(every), key)] = ids
    return out


def test_query_at_production_parameters(spark, monkeypatch, tmp_path):
    from conftest import SF001
    from llm.conftest import load

    from slaflow.llm.queries import QUERIES

    path = str(tmp_path / "out")
    monkeypatch.setattr(to, "shared_path", lambda *_: path)
    rows = QUERIES["op7_training_order"](spark, SF001).collect()
    sequences = list(to.read_slots(path, 0, 10**6))
    expected = plain_sequences(spark, spark.read.parquet(f"{SF001}/documents.parquet"), 2048, 20240601)
    assert [s.tolist() for s in sequences] == expected
    assert texts_back(rows, sequences) == {r["doc_id"]: r["text"] for r in load(f"{SF001}/documents.parquet")}


@pytest.mark.parametrize("task_bytes", [1, 4 * 100 * 256])
def test_tasks_of_several_shards(spark, tmp_path, task_bytes):
    from conftest import SF001

    path = str(tmp_path / "out")
    docs = spark.read.parquet(f"{SF001}/documents.parquet").repartition(3)
    to.write_training_order(docs, PATH, path, length=128, per_shard=10, task_bytes=task_bytes)
    n = spark.read.parquet(f"{path}/about").first()["sequences"]
    names = sorted(f.name for f in (tmp_path / "out" / "shards").iterdir() if not f.name.endswith(".crc"))
    assert names == [to.shard_name(k) for k in range(-(-n // 10))]
    assert not (tmp_path / "out" / "attempts").exists() and not (tmp_path / "out" / "sequences").exists()
    assert len(list(to.read_slots(path, 0, 10**6, 128, 10))) == n


def shard_batches(length, per_shard, n):
    import pyarrow as pa
    import zstandard

    pack = zstandard.ZstdCompressor().compress
    for s in range(n):
        yield pa.RecordBatch.from_arrays(
            [pa.array([s // per_shard], pa.int32()), pa.array([s], pa.int64()), pa.array([pack(np.full(length, s, "<u2").tobytes())]), pa.array([[]], pa.list_(pa.int32()))],
            ["shard", "slot", "packed", "pieces"],
        )


def test_a_task_run_again_leaves_one_file(tmp_path):
    for name in ("shards", "attempts"):
        (tmp_path / name).mkdir()
    write = to._write(str(tmp_path), 4, 16)
    cut_off = write(shard_batches(8, 4, 10))
    for _ in range(6):  # the first shard is renamed, the second is open when the task dies
        next(cut_off)
    first = (tmp_path / "shards" / to.shard_name(0)).stat().st_ino
    for _ in range(2):
        assert sum(b.num_rows for b in write(shard_batches(8, 4, 10))) == 10
    assert sorted(f.name for f in (tmp_path / "shards").iterdir()) == [to.shard_name(k) for k in range(3)]
    assert (tmp_path / "shards" / to.shard_name(0)).stat().st_ino == first
    assert [int(s[0]) for s in to.read_slots(str(tmp_path), 0, 99, 8, 4)] == list(range(10))


def test_a_rename_that_is_refused(tmp_path):
    """Of two attempts at once, the second finds the name taken."""
    import pyarrow.fs

    local = pyarrow.fs.LocalFileSystem()

    class Refusing:
        def __init__(self):
            self.asked = 0

        def get_file_info(self, name):
            self.asked += 1
            if self.asked == 1:  # not there yet when first asked
                return pyarrow.fs.FileInfo(name, pyarrow.fs.FileType.NotFound)
            return local.get_file_info(name)

        def move(self, a, b):
            raise OSError("there already")

        delete_file = staticmethod(local.delete_file)

    own, target = tmp_path / "own", tmp_path / "target"
    own.write_bytes(b"1234")
    target.write_bytes(b"1234")
    to._keep(Refusing(), str(own), str(target), 4)
    assert not own.exists() and target.read_bytes() == b"1234"
    own.write_bytes(b"12345")
    with pytest.raises(OSError):
        to._keep(Refusing(), str(own), str(target), 5)


def test_a_folder_that_executors_do_not_share(spark, make_docs, tmp_path, monkeypatch):
    write = to._write
    monkeypatch.setattr(to, "_write", lambda path, *more: write(str(tmp_path / "own"), *more))
    for name in ("shards", "attempts"):
        (tmp_path / "own" / name).mkdir(parents=True)
    with pytest.raises(RuntimeError, match="all executors share"):
        to.write_training_order(make_docs([(1, "a few words")]), PATH, str(tmp_path / "out"), length=8, per_shard=2)
    assert not (tmp_path / "out" / "about").exists()


def test_text_ids(spark, tmp_path):
    path = str(tmp_path / "out")
    docs = spark.createDataFrame([("a-1", "one two three"), (None, "four"), ("b", None)], "doc_id string, text string")
    rows = to.write_training_order(docs, PATH, path, length=4, per_shard=2).collect()
    assert texts_back(rows, list(to.read_slots(path, 0, 99, 4, 2))) == {"a-1": "one two three", None: "four", "b": ""}


def test_odd_rows(odd_docs, odd_rows, tmp_path):
    path = str(tmp_path / "out")
    rows = to.write_training_order(odd_docs.where("doc_id <> 5 AND doc_id IS NOT NULL"), PATH, path, length=64, per_shard=7).collect()
    back = texts_back(rows, list(to.read_slots(path, 0, 10**6, 64, 7)))
    assert back == {i: t or "" for i, t in odd_rows if i not in (None, 5)}
    whole = str(tmp_path / "whole")
    every = to.write_training_order(odd_docs, PATH, whole, length=64).collect()
    assert sum(r["piece"] == 0 for r in every) == len(odd_rows)
    assert [s.tolist() for s in to.read_slots(whole, 0, 10**6, 64)] == plain_sequences(odd_docs.sparkSession, odd_docs, 64, 20240601)


def test_empty_table(no_docs, tmp_path):
    path = str(tmp_path / "out")
    assert to.write_training_order(no_docs, PATH, path).count() == 0
    assert list(to.read_slots(path, 0, 5)) == []
