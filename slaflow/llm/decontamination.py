"""Benchmark decontamination with a generalised suffix automaton.

The words of all benchmark items form one automaton that knows every run of
consecutive item words.  Words of the training texts are streamed through
it; its state tells the longest run that ends at each word.  Runs of at
least ``window`` words (or a whole item that has fewer) are spans; a span
list can be removed from a text, and a text dropped whose share of such
words is too high.

Only words that stand in the benchmark, next to a word that also follows
there, carry a match of two or more words.  So a worker cuts its texts where
no item has that pair of words, with array operations, and walks the
automaton over the pieces that are long enough to hold a match.

An automaton holds at most about ``PASS_BYTES`` of item text; a larger
benchmark is dealt out by hash over several automata, through which the
texts pass one after the other.  What one has found is written before the
next is made, so that one lives at a time.  Removal goes in rounds: all
automata look at a text before it is judged and cut, and again at what a cut
has joined, so the result doesn't depend on how the items were dealt.

Defined results: a null text or item has no words; an item of no words
never occurs; rows with the same item id are one item with several texts; a
null item id reads ``null``; identical documents are judged alike; an empty
benchmark finds nothing.  Columns of ``docs`` with the names of added ones
are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slaflow.llm.common import materialize, shared_path, split_batch, string_buffers, text_or_empty, without
from slaflow.llm.words import words

WINDOW = 10
#: Item text of one automaton; what is broadcast is a small multiple of it.
PASS_BYTES = 2 << 20


class SuffixAutomaton:
    """All runs of consecutive words of the items."""

    def __init__(self, items: list[tuple[str, list[int]]], window: int = WINDOW):
        self.window = window
        self.step: list[dict[int, int]] = [{}]
        self.length, self.link = [0], [-1]
        ends = [(name, self._add(seq), seq) for name, seq in items if seq]
        self.names = sorted({name for name, _, _ in ends})
        number = {name: k for k, name in enumerate(self.names)}
        #: Items in which a state's runs occur, for states with runs of a window's length.
        self.items: dict[int, set[int]] = {}
        #: Whole items shorter than a window that end a state's runs.
        self.short: dict[int, set[tuple[int, int]]] = {}
        for name, end, seq in ends:
            if len(seq) < window:
                self.short.setdefault(self._state_of(end, len(seq)), set()).add((len(seq), number[name]))
            state = 0
            for w in seq:
                state = self.step[state][w]
                at = state
                while self.length[at] >= window and number[name] not in self.items.setdefault(at, set()):
                    self.items[at].add(number[name])
                    at = self.link[at]
        self.least = min([len(seq) for _, _, seq in ends if len(seq) < window], default=window)

    def _state_of(self, state: int, length: int) -> int:
        """The state of the state's suffix of that length."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def _copy(self, state: int, length: int) -> int:
        self.step.append(dict(self.step[state]))
        self.length.append(length)
        self.link.append(self.link[state])
        return len(self.length) - 1

    def _redirect(self, at: int, word: int, old: int, new: int) -> None:
        while at >= 0 and self.step[at].get(word) == old:
            self.step[at][word] = new
            at = self.link[at]

    def _extend(self, last: int, word: int) -> int:
        known = self.step[last].get(word)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            made = self._copy(known, self.length[last] + 1)
            self.link[known] = made
            self._redirect(last, word, known, made)
            return made
        self.step.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        state, at = len(self.length) - 1, last
        while at >= 0 and word not in self.step[at]:
            self.step[at][word] = state
            at = self.link[at]
        if at >= 0:
            target = self.step[at][word]
            if self.length[target] != self.length[at] + 1:
                made = self._copy(target, self.length[at] + 1)
                self.link[target] = made
                self._redirect(at, word, target, made)
                target = made
            self.link[state] = target
        return state

    def _add(self, seq: list[int]) -> int:
        last = 0
        for w in seq:
            last = self._extend(last, w)
        return last

    def walk(self, seq: list[int]) -> Iterator[tuple[int, int, set[int]]]:
        """(last word, number of words, items) of the longest match that ends
        at each word of ``seq``, if it holds a window or a whole short item."""
        state, n = 0, 0
        for i, w in enumerate(seq):
            while state and w not in self.step[state]:
                state = self.link[state]
                n = self.length[state]
            if w not in self.step[state]:
                state, n = 0, 0
                continue
            state, n = self.step[state][w], n + 1
            found, most = set(), 0
            if n >= self.window:
                found |= self.items[self._state_of(state, self.window)]
                most = n
            at = state
            while self.short and at > 0:
                for size, item in self.short.get(at, ()):
                    if size <= n:
                        found.add(item)
                        most = max(most, size)
                at = self.link[at]
            if found:
                yield i, most, found


class Matcher:
    """The automaton of some items, with the arrays that cut texts for it."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        h, _, _, bounds = words(*string_buffers(pa.array([t for _, t in items], pa.string())))
        self.vocabulary, ids = np.unique(h, return_inverse=True)
        seqs = [ids[bounds[k] : bounds[k + 1]].tolist() for k in range(len(items))]
        self.automaton = SuffixAutomaton([(name, seq) for (name, _), seq in zip(items, seqs)], window)
        pairs = {(a, b) for seq in seqs for a, b in zip(seq, seq[1:])}
        self.pairs = np.array(sorted(a * len(self.vocabulary) + b for a, b in pairs), np.int64)

    def matches(self, h: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, set[int]]]:
        """(first word, last word, its length, items) of the longest matches
        in texts with word hashes ``h``, in order."""
        n_vocabulary = len(self.vocabulary)
        if not len(h) or not n_vocabulary:
            return
        ids = np.minimum(np.searchsorted(self.vocabulary, h), n_vocabulary - 1)
        known = self.vocabulary[ids] == h
        joined = np.zeros(len(h) + 1, bool)  # word i follows word i - 1 somewhere in the items
        inner = np.flatnonzero(known[1:] & known[:-1]) + 1
        if len(self.pairs):
            pair = ids[inner - 1] * n_vocabulary + ids[inner]
            at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            joined[inner[self.pairs[at] == pair]] = True
        joined[bounds] = False
        starts = np.flatnonzero(known & ~joined[:-1])
        run_ends = np.flatnonzero(known & ~joined[1:]) + 1
        for s, e in zip(starts, run_ends):
            if e - s >= self.automaton.least:
                for i, n, items in self.automaton.walk(ids[s:e].tolist()):
                    yield int(s) + i - n + 1, int(s) + i, n, items


def merged(hits: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(first, last, longest) of overlapping hits as one span each."""
    out: list[tuple[int, int, int]] = []
    for first, last, n in sorted(hits):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], last), max(out[-1][2], n))
        else:
            out.append((first, last, n))
    return out


def _dealt(benchmark: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """The items (item, text), and over how many automata they are dealt."""
    items = benchmark.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"), text_or_empty(text_col).alias("text")
    )
    n_bytes = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    return items, math.ceil(n_bytes / PASS_BYTES)


def _matcher(items: DataFrame, k: int, n_passes: int, window: int) -> Matcher:
    part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_passes)) == k)
    return Matcher(sorted((r["item"], r["text"]) for r in part.collect()), window)


def matchers(benchmark: DataFrame, window: int, id_col: str, text_col: str) -> Iterator[Matcher]:
    """Matchers of all items, each of a bounded amount of text."""
    items, n_passes = _dealt(benchmark, id_col, text_col)
    for k in range(n_passes):
        yield _matcher(items, k, n_passes, window)


_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("longest", pa.int64())]))
_MATCH_SCHEMA = (
    "n_words long, spans array<struct<first:long,last:long,longest:long>>, items array<string>, n_hit long"
)
ADDED = ("n_words", "spans", "items", "n_hit")


def find_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``docs`` with ``n_words``, ``spans`` (first and last word, longest
    match), ``items`` (sorted ids) and ``n_hit`` (words in spans)."""
    return _matched(docs, *_dealt(benchmark, item_col, item_text_col), window, text_col)[0]


def _matched(
    docs: DataFrame, items: DataFrame, n_passes: int, window: int, text_col: str, max_coverage: float | None = None
) -> tuple[DataFrame, str | None]:
    """``find_matches`` over dealt items, and the folder that it is read from
    if there are several automata.  With ``max_coverage``, rows with a larger
    share of words in spans are left out and the spans (of the text before)
    are cut from the others; a sole automaton goes on until it finds nothing."""
    out = without(docs, *ADDED)
    own = out.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields) + ", " + _MATCH_SCHEMA
    for f, t in zip(ADDED, ("long", "array<struct<first:long,last:long,longest:long>>", "array<string>", "long")):
        out = out.withColumn(f, F.lit(0).cast(t) if t == "long" else F.array().cast(t))
    if n_passes < 2:
        matcher = _matcher(items, 0, 1, window) if n_passes else Matcher([], window)
        return out.mapInArrow(_pass(matcher, text_col, len(own), max_coverage, True), schema), None
    path = None
    for k in range(n_passes):
        last = max_coverage if k == n_passes - 1 else None
        found = out.mapInArrow(_pass(_matcher(items, k, n_passes, window), text_col, len(own), last, False), schema)
        before, path = path, shared_path(docs.sparkSession, "matches")
        found.write.parquet(path)
        out = docs.sparkSession.read.schema(found.schema).parquet(path)
        if before:
            _delete(docs.sparkSession, before)
    return out, path


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _pass(matcher: Matcher, text_col: str, n_own: int, max_coverage: float | None, alone: bool):
    def clean(text: str, spans: list[dict]) -> str | None:
        """The text without its spans; if no other automaton has a say, also
        without what their removal joins, none if that is too much of it."""
        while spans:
            text = cut_spans(text, [(s["first"], s["last"]) for s in spans])
            if not alone:
                break
            h, _, _, bounds = words(*string_buffers(pa.array([text])))
            again = merged([(first, last, n) for first, last, n, _ in matcher.matches(h, bounds)])
            if sum(last - first + 1 for first, last, _ in again) > max_coverage * len(h):
                return None
            spans = [{"first": first, "last": last} for first, last, _ in again]
        return text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = matcher.automaton.names
        for whole in batches:
            for batch in split_batch(whole, text_col):
                text = batch.column(batch.schema.get_field_index(text_col))
                h, _, _, bounds = words(*string_buffers(text))
                spans, items = batch.column(n_own + 1).to_pylist(), batch.column(n_own + 2).to_pylist()
                found: dict[int, tuple[list, set]] = {}
                for first, last, n, which in matcher.matches(h, bounds):
                    d = int(np.searchsorted(bounds, first, side="right")) - 1
                    hits, ids = found.setdefault(d, ([], set()))
                    hits.append((first - int(bounds[d]), last - int(bounds[d]), n))
                    ids |= which
                for d, (hits, ids) in found.items():
                    before = [(s["first"], s["last"], s["longest"]) for s in spans[d]]
                    spans[d] = [dict(zip(("first", "last", "longest"), s)) for s in merged(before + hits)]
                    items[d] = sorted({*items[d], *(names[k] for k in ids)})
                n_words = np.diff(bounds)
                n_hit = np.array([sum(s["last"] - s["first"] + 1 for s in x) for x in spans], np.int64)
                own = list(batch.columns[:n_own])
                if max_coverage is not None and n_hit.any():
                    k = batch.schema.get_field_index(text_col)
                    kept = n_hit <= max_coverage * n_words
                    texts = own[k].to_pylist()
                    for d in np.flatnonzero((n_hit > 0) & kept):
                        texts[d] = clean(texts[d], spans[d])
                        kept[d] = texts[d] is not None
                    own[k] = pa.array(texts, own[k].type)
                else:
                    kept = None
                out = pa.RecordBatch.from_arrays(
                    [*own, pa.array(n_words), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string())), pa.array(n_hit)],
                    names=batch.schema.names,
                )
                yield out if kept is None else out.filter(pa.array(kept))

    return run


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans (and what stands between
    them); a space is left in their place."""
    if not spans:
        return text
    raw = text.encode()
    _, starts, ends, _ = words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    out, at = [], 0
    for first, last in spans:
        out.append(raw[at : starts[first]])
        at = int(ends[last])
    out.append(raw[at:])
    return b" ".join(x.strip(b" ") for x in out).decode().strip(" ")


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = 0.5, text_col: str = "text"
) -> DataFrame:
    """``docs`` without benchmark text: texts of which more than
    ``max_coverage`` of the words stand in spans are dropped, from all others
    the spans are removed.  Removal joins what stood around a span; the text
    is judged and cut again until no automaton finds anything."""
    others = [c for c in docs.columns if c != text_col]
    row = F.struct(*[F.col(f"`{c}`") for c in others] or [F.lit(0)]).alias("row")
    work = docs.select(row, F.col(f"`{text_col}`").alias("text"))
    items, n_passes = _dealt(benchmark, "item_id", "text")
    if n_passes < 2:
        out = _matched(work, items, n_passes, window, "text", max_coverage)[0]
    else:
        out = None
        while out is None or not work.isEmpty():
            judged, path = _matched(work, items, n_passes, window, "text", max_coverage)
            rows = materialize(judged.select("row", "text", (F.col("n_hit") > 0).alias("cut")), "cut")
            _delete(docs.sparkSession, path)
            clean = rows.where(~F.col("cut")).select("row", "text")
            out = clean if out is None else out.unionByName(clean)
            work = rows.where("cut").select("row", "text")
    return out.select(*[F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])
