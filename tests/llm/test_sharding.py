import random
import zlib

import pytest

from slaflow.llm import sharding
from slaflow.llm.queries import QUERIES


def test_query_is_balanced_and_gapless(spark):
    from conftest import SF01
    from llm.conftest import load

    docs = {r["doc_id"]: r["text"] for r in load(f"{SF01}/documents.parquet")}
    rows = QUERIES["op9_sharding"](spark, SF01).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    load_, slots = [0] * 16, [[] for _ in range(16)]
    for r in rows:
        raw = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
        load_[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    largest = max(len(t.encode()) for t in docs.values())
    assert max(load_) - min(load_) <= largest


def test_deal_is_near_equal():
    rng = random.Random(1)
    sizes = {k: (rng.randint(1, 1000), 1) for k in range(4096)}
    load_ = [0] * 16
    for slot, shard in sharding.deal(sizes, 16).items():
        load_[shard] += sizes[slot][0]
    assert max(load_) - min(load_) < 1000 and max(load_) / min(load_) < 1.01


def test_growth_moves_slots_only_into_the_new_shard():
    rng = random.Random(2)
    sizes = {k: (rng.randint(1, 1000), 1) for k in range(4096)}
    old = sharding.deal(sizes, 16)
    new = sharding.rebalance(old, sizes, 17)
    moved = {s for s in sizes if old[s] != new[s]}
    assert {new[s] for s in moved} == {16}
    load_ = [sum(sizes[s][0] for s in sizes if new[s] == k) for k in range(17)]
    assert max(load_) / min(load_) < 1.03
    assert len(moved) < 4096 / 17 * 1.3


def test_lost_shards_and_new_slots_are_dealt_out():
    sizes = {k: (10, 1) for k in range(100)}
    old = sharding.deal({k: v for k, v in sizes.items() if k < 90}, 5)
    new = sharding.rebalance(old, sizes, 4)
    assert set(new) == set(sizes) and set(new.values()) == set(range(4))


def test_versions_are_kept(spark, make_docs, tmp_path):
    rows = [(i, "t" * (i % 50)) for i in range(300)]
    path = str(tmp_path / "map")
    one = sharding.shard_documents(make_docs(rows), 4, 64, path, 1).collect()
    two = sharding.shard_documents(make_docs(rows), 5, 64, path, 2).collect()
    before, after = {r["doc_id"]: r["shard"] for r in one}, {r["doc_id"]: r["shard"] for r in two}
    assert {after[i] for i in after if after[i] != before[i]} == {4}
    assert sharding.read_map(spark, path, 1).count() == sharding.read_map(spark, path, 2).count()
    with pytest.raises(Exception, match="already exists"):
        sharding.shard_documents(make_docs(rows), 4, 64, path, 1)


def test_odd_rows(odd_docs, odd_rows):
    rows = sharding.shard_documents(odd_docs, 3, 32).collect()
    assert sorted((repr(r["doc_id"]), r["size"]) for r in rows) == sorted((repr(i), len((t or "").encode()) + 1) for i, t in odd_rows)
    for shard in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))


def test_empty_table(no_docs):
    assert sharding.shard_documents(no_docs, 4).count() == 0
