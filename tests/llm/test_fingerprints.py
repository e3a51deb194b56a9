import base64
import functools
import hashlib
import random
import re

import numpy as np
import pyarrow as pa

from slaflow.llm import fingerprints as fp
from slaflow.llm.ngram_join import shingle_sets
from slaflow.llm.queries import QUERIES


MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15


def sketch(text):
    return fp.sketches(pa.array([text]))[0]


def mixed(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


@functools.lru_cache(None)
def word_hash(word):
    h, power = 0, 1
    for byte in word:
        power = power * BASE & MASK
        h += (byte + 1) * power
    return mixed((h + len(word)) & MASK)


def plain_sketch(text):
    """The sketch by plain integers: every shingle hash below a quarter of the
    range, or the 32 smallest."""
    raw = text.encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))
    w = [word_hash(x) for x in re.findall(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", raw)]
    found = set()
    for run in [w[i : i + 5] for i in range(len(w) - 4)] or ([[len(w), *w]] if w else []):
        h = 0
        for x in run:
            h = (h * BASE + x) & MASK
        found.add(mixed(h) >> 16)
    low = sorted(h for h in found if h < 2**48 // 4)
    return low if len(low) >= 32 else sorted(found)[:32]


def plain_limit(s):
    return 2**48 if len(s) < 32 else max(2**48 // 4, s[-1] + 1)


def plain_counts(a, b):
    t = min(plain_limit(a), plain_limit(b))
    a, b = {x for x in a if x < t}, {x for x in b if x < t}
    return len(a & b), len(a), len(a | b)


def plain_likeness(a, b):
    if not a or not b:
        return float(len(a) == len(b))
    both, _, either = plain_counts(a, b)
    return both / either if either else 0.0


def plain_pack(s):
    return base64.b64encode(b"".join(x.to_bytes(6, "big") for x in s)).decode()


def expected(rows):
    """The contract's rows, by code of their own."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0]))
    out = []
    for k, (i, text) in enumerate(rows):
        text, following = text or "", rows[(k + 1) % len(rows)][1] or ""
        n = len(text) // 4
        edited = text[: len(text) - n] + following[:n]
        a, b, c = plain_sketch(text), plain_sketch(edited), plain_sketch(following)
        both, own, _ = plain_counts(a, b)
        contained = 1.0 if not a else both / own if own else 0.0
        threshold = len(a) >= 32 and a[-1] < 2**48 // 4
        digest = hashlib.sha256(edited.encode()).hexdigest()
        out.append((i, len(text), digest, plain_pack(a), plain_pack(b), plain_likeness(a, b), plain_likeness(a, c), contained, threshold))
    return out


def test_query(spark):
    from conftest import SF01
    from llm.conftest import load

    want = expected([(r["doc_id"], r["text"]) for r in load(f"{SF01}/documents.parquet")])
    assert sorted(map(tuple, QUERIES["op10_fingerprints"](spark, SF01).collect())) == want
    assert sum(r[-1] for r in want) > 0.7 * len(want)  # most sketches are made by the threshold


def test_ranges_join_up(make_docs):
    rows = [(k * 7 - 300, f"text {k} " + "word " * (k % 9)) for k in range(101)]
    random.Random(1).shuffle(rows)
    ordered = fp.with_next(make_docs(rows), rows_per_range=10)
    assert ordered.select("range").distinct().count() > 5 and ordered.where("tail").count() > 5
    got = fp.compare_with_edits(make_docs(rows)).collect()
    assert sorted(map(tuple, got)) == expected(rows)


def test_many_ranges_give_the_same(make_docs, monkeypatch):
    rows = [(k, f"text {k} " + " ".join(f"w{(k * j) % 11}" for j in range(k % 40))) for k in range(90)]
    whole = fp.with_next
    monkeypatch.setattr(fp, "with_next", lambda d, **kw: whole(d, rows_per_range=7, **kw))
    assert sorted(map(tuple, fp.compare_with_edits(make_docs(rows), block=50).collect())) == expected(rows)


def test_hot_ids_have_several_ranges(make_docs):
    """A third of all ids are null, a third are equal."""
    rows = [(None if k % 3 == 0 else 7 if k % 3 == 1 else k, f"text number {k}") for k in range(300)]
    ordered = fp.with_next(make_docs(rows), rows_per_range=10)
    sizes = {r["range"]: r["count"] for r in ordered.where("NOT tail").groupBy("range").count().collect()}
    assert max(sizes.values()) <= 40 and sum(sizes.values()) == 300
    got = fp.compare_with_edits(make_docs(rows)).collect()
    assert len(got) == 300
    # within equal ids each row has one successor of its own
    by_text = {t: t for _, t in rows}
    assert len({r["fingerprint"] for r in got}) == len(by_text)


def test_ranges_follow_the_order(make_docs):
    rows = [(None if k % 4 == 0 else 50 if k % 4 == 1 else k, f"text {k}") for k in range(200)]
    found = fp.with_next(make_docs(rows), rows_per_range=8).where("NOT tail").select("range", "doc_id", fp.F.xxhash64("text").alias("tie")).collect()
    order = sorted(found, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["tie"]))
    ranges = [r["range"] for r in order]
    assert ranges == sorted(ranges) and len(set(ranges)) > 10


def test_likeness_is_close_to_jaccard():
    rng = random.Random(3)
    errors = []
    for n in (20, 200, 2000, 20000):
        a = [f"w{rng.randint(0, 10**6)}" for _ in range(n)]
        b = a[: n * 3 // 4] + [f"v{rng.randint(0, 10**6)}" for _ in range(n // 4)]
        x, y = shingle_sets(pa.array([" ".join(a), " ".join(b)]))
        both = len(np.intersect1d(x, y))
        errors.append(abs(fp.likeness(sketch(" ".join(a)), sketch(" ".join(b))) - both / (len(x) + len(y) - both)))
    assert errors[0] == 0 and max(errors) < 0.15


def test_containment_in_a_much_longer_text():
    rng = random.Random(4)
    long_text = [f"w{rng.randint(0, 10**6)}" for _ in range(40000)]
    a, b = sketch(" ".join(long_text[5000:8000])), sketch(" ".join(long_text))
    assert fp.containment(a, b) > 0.95 and fp.likeness(a, b) < 0.2
    assert fp.containment(a, sketch(" ".join(reversed(long_text)))) == 0


def test_sketches_merge():
    rng = random.Random(6)
    words = [f"w{rng.randint(0, 10**6)}" for _ in range(3000)]
    for cut, end in ((10, 30), (40, 100), (30, 3000), (1500, 3000)):
        left, right = " ".join(words[:cut]), " ".join(words[cut - 4 : end])  # every shingle is in one
        assert np.array_equal(fp.merge(sketch(left), sketch(right)), sketch(" ".join(words[:end])))


def test_pack_round_trip():
    for text in ("", "a", "a b c d e f g", " ".join(map(str, range(5000)))):
        assert np.array_equal(fp.unpack(fp.pack(sketch(text))), sketch(text))


def test_odd_rows(odd_docs, odd_rows):
    got = fp.compare_with_edits(odd_docs).collect()
    assert len(got) == len(odd_rows)
    assert sorted((repr(r["doc_id"]), r["n_chars"]) for r in got) == sorted((repr(i), len(t or "")) for i, t in odd_rows)
    prints = {(r["doc_id"], r["fingerprint"]) for r in fp.fingerprint(odd_docs).collect()}
    assert prints == {(r["doc_id"], r["fingerprint"]) for r in got}


def test_empty_table(no_docs):
    assert fp.compare_with_edits(no_docs).count() == 0 and fp.fingerprint(no_docs).count() == 0
