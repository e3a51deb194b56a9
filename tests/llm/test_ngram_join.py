import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from slaflow.llm import components as cc
from slaflow.llm import ngram_join as nj


def brute(rows):
    """(id, class, links, copies) of each row."""
    named = [(i, t or "") for i, t in rows if i is not None]
    sets = nj.shingle_sets(pa.array([t for _, t in named], pa.string()))
    keys = [nj.set_digest(s, t) for s, (_, t) in zip(sets, named)]
    n = len(named)
    like = np.zeros((n, n), bool)
    for a in range(n):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            like[a, b] = like[b, a] = keys[a] == keys[b] or (both and both * 5 >= 4 * (len(sets[a]) + len(sets[b]) - both))
    label = list(range(n))
    for a in range(n):
        for b in np.flatnonzero(like[a]):
            x, y = label[a], label[b]
            if x != y:
                label = [x if v == y else v for v in label]
    least = {}
    for k, (i, _) in enumerate(named):
        least[label[k]] = min(i, least.get(label[k], i))
    count = Counter(keys)
    out = [(i, least[label[k]], int(like[k].sum()), count[keys[k]]) for k, (i, _) in enumerate(named)]
    return sorted(out + [(None, None, 0, 1) for i, _ in rows if i is None], key=repr)


def joined(df):
    return sorted(map(tuple, df.collect()), key=repr)


def corpus(rng, n_groups=25, size=12, n_words=60, rate=0.03):
    rows = []
    for _ in range(n_groups):
        base = [f"w{rng.randint(0, 400)}" for _ in range(n_words)]
        for _ in range(rng.randint(1, size)):
            words = [f"w{rng.randint(0, 400)}" if rng.random() < rate * rng.random() else w for w in base]
            rows.append((len(rows) * 3, " ".join(words)))
    return rows


def test_against_brute_force(make_docs):
    rows = corpus(random.Random(1))
    rows += [(10_000 + k, rows[k % 7][1].upper()) for k in range(20)]  # copies
    assert joined(nj.ngram_join(make_docs(rows))) == brute(rows)


def test_large_buckets_are_split_and_dense_ones_compared_in_blocks(make_docs, monkeypatch):
    monkeypatch.setattr(nj, "BUCKET", 8)
    monkeypatch.setattr(nj, "BLOCK_SETS", 16)
    passage = " ".join(f"shared{k}" for k in range(25))
    rng = random.Random(3)
    rows = corpus(rng, n_groups=2, size=70, n_words=80, rate=0.06)
    rows += [(5_001 + 2 * k, passage + " " + " ".join(f"v{rng.randint(0, 10**6)}" for _ in range(40))) for k in range(80)]
    assert joined(nj.ngram_join(make_docs(rows), recall=0.99, depth=2)) == brute(rows)


def test_few_shuffles(make_docs, monkeypatch):
    """The groups of all levels are compared after one shuffle, pivots meet
    their buckets without any, and no other Python work follows a shuffle but
    that of the next paths."""
    monkeypatch.setattr(nj, "BUCKET", 8)
    plans = {}

    def spy(df, name, kept=nj.materialize):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return kept(df, name)

    monkeypatch.setattr(nj, "materialize", spy)
    passage = " ".join(f"shared{k}" for k in range(25))
    rng = random.Random(3)
    rows = corpus(rng, n_groups=2, size=70, n_words=80, rate=0.06)
    rows += [(5_001 + 2 * k, passage + " " + " ".join(f"v{rng.randint(0, 10**6)}" for _ in range(40))) for k in range(80)]
    links = nj.candidate_links(nj.classes(nj.sketches(make_docs(rows), "doc_id", "text")), 0.99, 2)
    assert {"paths-2", "buckets-2", "judged"} <= set(plans)
    assert links._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert "hashpartitioning" not in plans["judged"] and "MapInArrow" not in plans["classes"]


def test_short_signatures_are_the_last_bytes(make_docs):
    texts = [" ".join(f"w{k * j}" for k in range(9 + j)) for j in range(1, 9)]
    signature = nj.signatures(nj.shingle_sets(pa.array(texts)))
    assert (nj._signature(nj._binary(nj._planes(signature))) == signature).all()
    known = nj.classes(nj.sketches(make_docs(list(enumerate(texts))), "doc_id", "text")).collect()
    assert {r["first"]: bytes(r["short"]) for r in known} == {k: signature[k].astype(np.uint8).tobytes() for k in range(len(texts))}


def test_runs_reach_the_target_recall():
    """Pairs right at the threshold, over the splits of their signatures."""
    rng = np.random.default_rng(2)
    depth, pairs, runs = 2, 400, nj.n_runs(0.9, 2)
    a = rng.integers(0, 2**32, (pairs, nj.TOKENS)).astype(np.uint32)
    b = np.where(rng.random((pairs, nj.TOKENS)) < nj.THRESHOLD, a, rng.integers(0, 2**32, (pairs, nj.TOKENS))).astype(np.uint32)
    found = np.zeros(pairs, bool)
    for run in range(runs):
        paths = [{k: {nj.mix(np.array([run + 1], np.uint64) << np.uint64(20))[0]} for k in range(pairs)} for _ in (0, 1)]
        for _ in range(depth):
            for side, signature in enumerate((a, b)):
                tokens = nj._tokens(signature)
                flat = [(k, p) for k, ps in paths[side].items() for p in ps]
                at, made = nj._children(np.array([p for _, p in flat], np.uint64), tokens[[k for k, _ in flat]])
                paths[side] = {k: set() for k in range(pairs)}
                for i, p in zip(at, made):
                    paths[side][flat[i][0]].add(p)
        found |= [bool(paths[0][k] & paths[1][k]) for k in range(pairs)]
    assert found.mean() > 0.86 and nj.n_runs(0.999, 4) == 19


def test_signatures_lose_no_pairs_at_the_threshold():
    """Neither by the binomial, nor for short texts under the hashes used."""
    assert sum(math.comb(nj.TOKENS, k) * 0.8**k * 0.2 ** (nj.TOKENS - k) for k in range(nj._LEAST_EQUAL)) < 1e-5
    rng = random.Random(5)
    rows = []
    for _ in range(20_000):  # four of five shingles in common
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(9)]
        rows += [" ".join(words[:8]), " ".join(words)]
    signature = nj.signatures(nj.shingle_sets(pa.array(rows))).astype(np.uint8)
    equal = (signature[::2] == signature[1::2]).sum(1)
    assert (equal >= nj._LEAST_EQUAL).all()


def test_overlaps_are_exact():
    rng = random.Random(4)
    sets = [np.unique(np.array([rng.randint(0, 300) for _ in range(rng.randint(0, 200))], np.uint64)) for _ in range(20)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    got = nj.overlaps(sets, width=32)
    assert all(got[i][j] == want[i][j] for i in range(20) for j in range(20) if i != j)


def test_grouped_keeps_groups_whole():
    keys = [0, 0, 1, 2, 2, 2, 3, 4, 4]
    rows = pa.RecordBatch.from_arrays([pa.array(keys), pa.array(range(9))], ["k", "v"])
    for size in (1, 2, 4, 9):
        batches = [rows.slice(i, size) for i in range(0, 9, size)]
        groups = [table.column(0).to_pylist()[s:e] for table, at in nj.grouped(batches, 1, least=3) for s, e in zip(at, at[1:])]
        assert groups == [[0, 0], [1], [2, 2, 2], [3], [4, 4]]


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)]
    edges += [(rng.randint(200, 300), rng.randint(200, 300)) for _ in range(60)] + [(7, 7), (1, 0)]
    label = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(60):
        for u, v in edges:
            if u != v:
                label[u] = label[v] = min(label[u], label[v])
    got = {r["node"]: r["component"] for r in cc.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == label


def test_components_with_hot_nodes(spark, monkeypatch):
    """Stars whose centre holds most edges, and a long path between them."""
    from slaflow.llm import common

    monkeypatch.setattr(common, "HEAVY_SHARE", 5)
    monkeypatch.setattr(cc, "PORTION", 20)
    edges = [(500, k) for k in range(300, 400)] + [(501, k) for k in range(400, 480)] + [(k, k + 1) for k in range(500, 560)] + [(3, 300), (900, 901)]
    got = {r["node"]: r["component"] for r in cc.components(spark.createDataFrame(edges, "u long, v long").repartition(7)).collect()}
    assert got == {**{k: 3 for k in {x for e in edges for x in e} - {900, 901}}, 900: 900, 901: 900}


def test_components_of_stars_take_no_round(spark, monkeypatch):
    """What the tasks have tied already is read from the minima."""
    written = []
    monkeypatch.setattr(cc, "materialize", lambda df, name, kept=cc.materialize: (written.append(name), kept(df, name))[1])
    edges = [(k, k + 1) for k in range(50)] + [(70, 90), (80, 90), (90, 70), (5, 5)]
    got = {r["node"]: r["component"] for r in cc.components(spark.createDataFrame(edges, "u long, v long").coalesce(1)).collect()}
    assert got == {**{k: 0 for k in range(51)}, 70: 70, 80: 70, 90: 70}
    assert written == ["edges", "edges", "least"]


def test_components_of_no_edges(spark):
    assert cc.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_odd_rows(odd_docs, odd_rows):
    assert joined(nj.ngram_join(odd_docs)) == brute(odd_rows)


def test_empty_table(no_docs):
    assert nj.ngram_join(no_docs).count() == 0


def test_query(spark):
    from conftest import SF001
    from llm.conftest import load
    from slaflow.llm.queries import QUERIES

    rows = [(r["doc_id"], r["text"]) for r in load(f"{SF001}/documents.parquet")]
    assert joined(QUERIES["op1_ngram_join"](spark, SF001)) == brute(rows)


def test_ids_are_whole_numbers(spark):
    docs = spark.createDataFrame([("a-1", "one two"), ("7", "one two")], "doc_id string, text string")
    with pytest.raises(TypeError, match="doc_id has the type string"):
        nj.ngram_join(docs)
    short = spark.createDataFrame([(7, "one two"), (8, "one two"), (None, "one two")], "doc_id int, text string")
    rows = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in nj.ngram_join(short).collect()}
    assert rows == {7: (7, 1), 8: (7, 1), None: (None, 0)}
