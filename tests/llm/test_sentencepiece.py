import random
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from slaflow.llm import sentencepiece_scan as ss
from slaflow.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
ALPHABETS = ("etaoinshrdlu", "ab", "etaoin shr", "aé€😀\n z▁ xx\x00", "  \n a", "0123456789.,", "TheINGerßäöü ")


@pytest.fixture(scope="module")
def encoder():
    return ss.Encoder(PATH)


def by_chunks(encoder, text, size):
    s = ss.SPACE + text.replace(" ", ss.SPACE)
    n = encoder.longest
    chunks = [(min(c, n), s[max(0, c - n) : c + size + n]) for c in range(0, len(s), size)]
    matrices = [encoder.matrix(x, b, min(b + size, len(x))) for b, x in chunks]
    states = ss.scan(matrices)
    ids = []
    for (b, x), entry, exit_ in zip(chunks, states, states[1:]):
        end = min(b + size, len(x))
        ids += encoder.encode_part(x[b - entry[0] + len(entry[1]) : end - exit_[0] + len(exit_[1])])
    return ids, matrices


@pytest.mark.parametrize("alphabet", ALPHABETS)
def test_chunks_give_the_librarys_ids(encoder, alphabet):
    rng = random.Random(alphabet)
    for _ in range(120):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 300)))
        assert by_chunks(encoder, text, rng.choice([16, 17, 31, 64]))[0] == encoder.model.encode(text), repr(text)


def test_products_are_associative(encoder):
    rng = random.Random(3)
    text = "".join(rng.choice("etaoinshrdlu") for _ in range(200))
    _, m = by_chunks(encoder, text, 17)
    left, right = m[0], m[-1]
    for x in m[1:]:
        left = ss.compose(left, x)
    for x in reversed(m[:-1]):
        right = ss.compose(x, right)
    assert left == right == ss.product(m) == {(ss.FREE, ss.FREE)}
    assert ss.compose(ss.compose(m[2], m[3]), m[4]) == ss.compose(m[2], ss.compose(m[3], m[4]))


def test_tables_against_the_library(spark, odd_docs, odd_rows, make_docs):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    out = ss.decode(ss.encode(odd_docs, PATH, chunk_chars=500), PATH)
    assert sorted(out.columns) == sorted([*odd_docs.columns, "decoded"])
    got = [(r["doc_id"], r["text"], r["ids"], r["decoded"]) for r in out.collect()]
    want = [(i, t, model.encode(t or ""), (t or "").replace("▁", " ")) for i, t in odd_rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("run", [1, 3, 64])
def test_runs_of_chunks(encoder, make_docs, monkeypatch, run):
    """Products of runs, then the states inside them, give the states of one
    scan over all."""
    monkeypatch.setattr(ss, "RUN", run)
    rng = random.Random(run)
    texts = ["".join(rng.choice(a) for _ in range(rng.randint(50, 400))) for a in ALPHABETS for _ in range(3)]
    rows = ss.encode(make_docs(list(enumerate(texts))).repartition(3), PATH, chunk_chars=20).collect()
    assert {r["doc_id"]: r["ids"] for r in rows} == {k: encoder.model.encode(t) for k, t in enumerate(texts)}


def test_states_between_given_ends(encoder):
    rng = random.Random(5)
    text = "".join(rng.choice("etaoinshrdlu") for _ in range(300))
    _, m = by_chunks(encoder, text, 17)
    whole = ss.scan(m)
    for a, b in ((0, 5), (4, 9), (7, len(m))):
        assert ss.scan(m[a:b], whole[a], whole[b]) == whole[a : b + 1]


def test_other_models_are_refused(monkeypatch):
    class Other:
        def __init__(self, model, **changed):
            self.model, self.changed = model, changed

        def __getattr__(self, name):
            return self.changed.get(name) or getattr(self.model, name)

    model = ss.load(PATH)
    for changed in ({"normalize": lambda t: model.normalize(t).lower()}, {"get_score": lambda i: -i / 7}):
        monkeypatch.setattr(ss, "load", lambda _, c=changed: Other(model, **c))
        with pytest.raises(ValueError, match="no BPE model"):
            ss.Encoder(PATH)


def test_a_giant_word_in_chunks(make_docs):
    rng = random.Random(8)
    text = "".join(rng.choice("etaoinshrdlu") for _ in range(20_000))
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    (r,) = ss.encode(make_docs([(1, text)]), PATH, chunk_chars=1000).collect()
    assert r["ids"] == model.encode(text)


def test_query(spark):
    from conftest import SF001
    from llm.conftest import load

    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    want = {r["doc_id"]: model.encode(r["text"]) for r in load(f"{SF001}/documents.parquet")}
    assert any(len(r["text"] or "") > ss.CHUNK_CHARS for r in load(f"{SF001}/documents.parquet"))  # the scan is used
    rows = QUERIES["op8_sentencepiece"](spark, SF001).collect()
    assert {r["doc_id"]: r["ids"] for r in rows} == want
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in rows)


def test_empty_table(no_docs):
    assert ss.decode(ss.encode(no_docs, PATH), PATH).count() == 0


def test_null_and_empty_ids(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [300, 301]), (4, None)], "doc_id long, ids array<int>").coalesce(1)
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    got = {r["doc_id"]: r["decoded"] for r in ss.decode(df, PATH).collect()}
    assert got == {1: None, 2: "", 3: model.decode([300, 301]), 4: None}


def test_text_is_exchanged_once_for_both_passes(make_docs):
    df = ss.encode(make_docs([(1, "a b c " * 2000)]), PATH, chunk_chars=1000)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") >= 2


def test_ids_are_decoded_in_bounded_parts(monkeypatch):
    given = []

    class Model:
        def decode(self, ids, **_):
            given.append([len(x) for x in ids])
            return [str(sum(x)) for x in ids]

    frame = SimpleNamespace(columns=["doc_id", "ids"], schema=SimpleNamespace(fields=[]), mapInArrow=lambda run, _: run)
    monkeypatch.setattr(ss, "without", lambda df, *_: df)
    monkeypatch.setattr(ss, "load", lambda _: Model())
    lengths = [40_000, 40_000, 0, 25_536, 100_000, *[1] * 1100]
    ids = [None, *[np.arange(n, dtype=np.int32) for n in lengths]]
    batch = pa.record_batch([pa.array(range(len(ids))), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])
    out = pa.Table.from_batches(ss.decode(frame, PATH)(iter([batch.slice(0, 0), batch, batch.slice(3)])))
    want = [None, *[str(sum(range(n))) for n in lengths]]
    assert out.column("decoded").to_pylist() == want + want[3:]
    assert all(len(x) <= 512 and (sum(x) <= 1 << 16 or len(x) == 1) for x in given)
