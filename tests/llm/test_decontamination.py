import random

import pyarrow as pa
import pytest

from slaflow.llm import decontamination as dc
from slaflow.llm.oracle import ORACLE_SQL
from slaflow.llm.queries import QUERIES
from llm.test_words import expected as words_of

ITEMS = "item_id long, text string"


def brute(rows, items, window=10):
    """(words, words in spans, items) of each row."""
    windows = []
    for i, t in items:
        w = words_of(t)
        n = min(len(w), window)
        windows += [("null" if i is None else str(i), tuple(w[k : k + n])) for k in range(len(w) - n + 1) if n]
    out = []
    for i, t in rows:
        w, hit, found = words_of(t), set(), set()
        for name, run in windows:
            for k in range(len(w) - len(run) + 1):
                if tuple(w[k : k + len(run)]) == run:
                    hit |= set(range(k, k + len(run)))
                    found.add(name)
        out.append((i, len(w), len(hit), sorted(found)))
    return out


def judged(df):
    return sorted([(r["doc_id"], r["n_words"], r["n_hit"], list(r["items"])) for r in df.collect()], key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_matcher_against_brute_force(seed):
    rng = random.Random(seed)
    vocabulary = [chr(97 + k) for k in range(3 if seed % 2 else 6)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k % 25, text(rng.choice([0, 1, 3, 5, 8, 20]))) for k in range(12)]
    if seed > 1:
        items = [x for x in items if len(x[1].split()) >= 5]
    rows = [(k, text(rng.randint(0, 60))) for k in range(60)]
    matcher = dc.Matcher([(str(i), t) for i, t in items], 5)
    h, _, _, bounds = dc.words(*dc.string_buffers(pa.array([t for _, t in rows])))
    got = [(len(words_of(t)), set(), set()) for _, t in rows]
    for first, last, n, which in matcher.matches(h, bounds):
        d = int(dc.np.searchsorted(bounds, first, side="right")) - 1
        got[d][1].update(range(first, last + 1))
        got[d][2].update(matcher.automaton.names[k] for k in which)
        assert n == last - first + 1
    assert [(n, len(a), sorted(b)) for n, a, b in got] == [x[1:] for x in brute(rows, items, 5)]


def test_automaton_knows_all_runs_and_no_others():
    rng = random.Random(9)
    items = [("a", [rng.randint(0, 2) for _ in range(30)]), ("b", [rng.randint(0, 2) for _ in range(30)])]
    automaton = dc.SuffixAutomaton(items, 4)
    runs = {tuple(s[i:j]) for _, s in items for i in range(30) for j in range(i + 1, 31)}
    for _ in range(500):
        run = tuple(rng.randint(0, 2) for _ in range(rng.randint(1, 9)))
        state = 0
        for w in run:
            state = automaton.step[state].get(w) if state is not None else None
        assert (state is not None) == (run in runs)


def test_query_against_sql(spark):
    from conftest import SF001
    from oracle_compare import compare

    r = compare(spark, "op2", QUERIES["op2_decontamination"], ORACLE_SQL["op2_decontamination"], SF001)
    assert r["ok"], r


def test_several_automata_give_the_same(spark, make_docs, monkeypatch):
    rng = random.Random(2)
    items = [(k, " ".join(f"w{rng.randint(0, 30)}" for _ in range(12))) for k in range(30)]
    rows = [(k, " ".join(f"w{rng.randint(0, 30)}" for _ in range(8)) + " " + items[k % 30][1] + " x") for k in range(40)]
    bench = spark.createDataFrame(items, ITEMS)
    monkeypatch.setattr(dc, "PASS_BYTES", 400)
    assert len(list(dc.matchers(bench, 10, "item_id", "text"))) > 2
    assert judged(dc.find_matches(make_docs(rows), bench)) == sorted(brute(rows, items), key=repr)


def test_odd_rows(spark, odd_docs, odd_rows):
    items = [(1, "a B c d e f g h i j k l m n o p"), (2, None), (3, ""), (4, "!?"), (None, "two"), (5, "one\ntwo"), (5, "€😀")]
    bench = spark.createDataFrame(items, ITEMS)
    out = dc.find_matches(odd_docs, bench)
    assert judged(out) == sorted(brute(odd_rows, items), key=repr)
    assert len(out.columns) == len({c.lower() for c in out.columns})
    assert dc.find_matches(odd_docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_spans_and_documents_are_removed(spark, make_docs):
    item = " ".join(f"bench{k}" for k in range(14))
    own = " ".join(f"own{k}" for k in range(40))
    rows = [
        (1, f"{own}.\n{item.upper()}! {own}"), (2, item), (3, own), (4, " ".join(item.split()[:9]) + " " + own), (5, None),
        # the removal of the inner span joins the outer one
        (6, own + " " + " ".join(item.split()[:5] + item.split() + item.split()[5:]) + " " + own),
    ]
    bench = spark.createDataFrame([(7, item)], ITEMS)
    out = {r["doc_id"]: r["text"] for r in dc.decontaminate(make_docs(rows), bench).collect()}
    assert out == {1: f"{own}.\n ! {own}", 3: own, 4: rows[3][1], 5: None, 6: f"{own} {own}"}


def test_removal_keeps_clashing_columns(spark, odd_docs):
    bench = spark.createDataFrame([(7, "a b c d e f g h i j")], ITEMS)
    out = dc.decontaminate(odd_docs, bench)
    assert out.columns == odd_docs.columns
    assert {(r["items"], r["spans"], r["n_words"]) for r in out.select("items", "spans", "n_words").collect()} == {(8, 7, 6)}


def test_empty_tables(spark, no_docs):
    assert dc.decontaminate(no_docs, spark.createDataFrame([], ITEMS)).count() == 0


def test_removal_does_not_depend_on_the_number_of_automata(spark, make_docs, monkeypatch):
    items = [(k, " ".join(f"i{k}w{j}" for j in range(12))) for k in range(12)]
    own = lambda k, n: " ".join(f"own{k}x{j}" for j in range(n))
    rows, want = [], {}
    for a in range(12):
        for b in range(12):
            # cutting item b joins the two halves of item a
            half = items[a][1].split()
            text = " ".join([*half[:6], items[b][1], *half[6:]])
            rows.append((len(rows), f"{own(a, 30)} {text} {own(b, 30)}"))
            want[len(rows) - 1] = f"{own(a, 30)} {own(b, 30)}"
            # more than half of what the cut leaves is an item: the text goes
            rows.append((len(rows), f"{own(a, 10)} {text} {own(b, 1)}"))
    rows += [(len(rows), own(0, 20)), (len(rows) + 1, None)]
    want |= {rows[-2][0]: own(0, 20), rows[-1][0]: None}
    bench = spark.createDataFrame(items, ITEMS)
    results = []
    for size in (dc.PASS_BYTES, 250):
        monkeypatch.setattr(dc, "PASS_BYTES", size)
        results.append({r["doc_id"]: r["text"] for r in dc.decontaminate(make_docs(rows), bench).collect()})
    assert len(list(dc.matchers(bench, 10, "item_id", "text"))) > 2
    assert results[0] == want and results[1] == want
