"""SentencePiece encoding and decoding with a max-plus scan over the chunks
of giant documents.

The ids are those of the library for the given model.  Texts of at most
``chunk_chars`` code points are encoded by the library whole.  Longer ones
are cut anywhere into chunks, which are encoded by different tasks:

1. At each cut there is a small set of boundary states, the pieces that may
   hold the last character before the cut, with their place.  A chunk yields
   the transfer matrix from the states at its begin to those at its end: 0
   where a sequence of pieces leads from one to the other, minus infinity
   elsewhere (so kept as the set of its zeros).
2. The products of runs of ``RUN`` chunks are made in groups of their own.
   They are associative, so the few products of a document tell the states
   that can be reached at the ends of each run, forwards and backwards, which
   leaves one state there; between these, each run finds the state at every
   cut inside it, again in groups of their own.
3. Between the states at its ends, every chunk is traced back on its own.

For this, BPE is a path problem: pieces are a text's encoding just if every
two neighbours are the encoding of what they spell together.  So a sequence
of pieces has the weight 0 if all neighbours fit and minus infinity if not,
and one path has the weight 0.  (Summed piece scores are the objective of
unigram models, not of this one; the path with the largest sum isn't what
the library gives.)  Where two characters stand next to each other in no
piece, such as a letter and a space, no piece crosses, and all states meet;
most matrices so need a walk over a few characters only.

Defined results: a null text is empty and has no ids; U+2581, which the
model uses for the space, decodes as a space, as in the library; identical
rows are encoded one by one; an empty table gives no rows.  Columns of the
names that are added are replaced, all others are kept.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slaflow.llm.common import materialize, text_or_empty, without
from slaflow.llm.ngram_join import grouped

CHUNK_CHARS = 16_384
#: Chunks whose matrices are multiplied in one group.
RUN = 64
SPACE = "▁"
#: What a model that normalises texts would change.
PROBE = "ﬁ  Ａ\t e\u0301 \u00a0x²\r\n İ "
#: A state: (characters of the piece before the cut, the piece).  Where no
#: piece can cross, at the begin and at the end, there is only this one:
FREE = (0, "")
State = tuple[int, str]
Matrix = set[tuple[State, State]]


def load(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


class Encoder:
    """A SentencePiece model with what the scan needs to know of its pieces."""

    def __init__(self, path: str):
        m = self.model = load(path)
        normal = [
            i for i in range(m.get_piece_size())
            if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))
        ]
        self.pieces = {m.id_to_piece(i) for i in normal}
        if any(not m.get_score(i).is_integer() for i in normal) or m.normalize(PROBE) != SPACE + PROBE.replace(" ", SPACE):
            raise ValueError(f"{path} is no BPE model that leaves texts as they are")
        self.longest = max(map(len, self.pieces))
        self.touching = {p[i : i + 2] for p in self.pieces for i in range(len(p) - 1)}
        characters = set().union(*self.pieces)
        # What stands before a text so that the model doesn't put a space there.
        self.fence = next(c for c in "\n\r\x00\x01\x02" if c not in characters)
        self.n_fence = len(m.encode(self.fence))
        self.known_fits: dict[tuple[str, str], bool] = {}

    def encode_part(self, part: str) -> list[int]:
        """Ids of a run of whole pieces, spaces written as U+2581."""
        return self.model.encode(self.fence + part.replace(SPACE, " "))[self.n_fence :]

    def fits(self, left: str, right: str) -> bool:
        """Whether the two pieces are the encoding of what they spell (of an
        empty one and a piece: whether the piece is)."""
        key = (left, right)
        if key not in self.known_fits:
            if len(self.known_fits) > 1_000_000:
                self.known_fits.clear()
            spelt = self.model.encode_as_pieces(self.fence + (left + right).replace(SPACE, " "))[self.n_fence :]
            self.known_fits[key] = spelt == [p for p in key if p]
        return self.known_fits[key]

    def free(self, s: str, at: int) -> bool:
        """Whether no piece can hold the characters on both sides."""
        return at <= 0 or at >= len(s) or s[at - 1 : at + 1] not in self.touching

    def pieces_at(self, s: str, at: int) -> Iterable[str]:
        for n in range(1, self.longest + 1):
            if at + n <= len(s) and s[at : at + n] in self.pieces:
                yield s[at : at + n]

    def states(self, s: str, cut: int) -> list[State]:
        if self.free(s, cut):
            return [FREE]
        return [
            (cut - begin, p) for begin in range(max(0, cut - self.longest), cut) for p in self.pieces_at(s, begin)
            if begin + len(p) >= cut and self.fits("", p)
        ]

    def _walk(self, s: str, entries: dict[tuple[int, str], int], stop: int) -> dict[tuple[int, str], int]:
        """From pieces by (end, piece), with the bits of the states that led
        there, to the pieces by (begin, piece) that begin before ``stop`` and
        reach it."""
        ends: dict[int, dict[str, int]] = {}
        for (end, piece), bits in entries.items():
            known = ends.setdefault(end, {})
            known[piece] = known.get(piece, 0) | bits
        out: dict[tuple[int, str], int] = {}
        for at in range(min(ends, default=stop), stop):
            for right in self.pieces_at(s, at) if at in ends else ():
                bits = 0
                for left, b in ends[at].items():
                    if b & ~bits and self.fits(left, right):
                        bits |= b
                if bits and at + len(right) >= stop:
                    out[(at, right)] = out.get((at, right), 0) | bits
                elif bits:
                    known = ends.setdefault(at + len(right), {})
                    known[right] = known.get(right, 0) | bits
            ends.pop(at, None)
        return out

    def matrix(self, s: str, begin: int, end: int) -> Matrix:
        """The transfer matrix of ``s[begin:end]``; ``s`` holds the longest
        piece's length of context on both sides, unless the text ends."""
        entries = self.states(s, begin)
        start = {(begin - n + len(p), p): 1 << k for k, (n, p) in enumerate(entries)}
        first = next((i for i in range(begin, end + 1) if self.free(s, i)), None)
        if first is None:
            out = self._walk(s, start, end)
            return {
                (e, (end - at, p)) for (at, p), bits in out.items() for k, e in enumerate(entries) if bits >> k & 1
            }
        alive = 0
        if entries == [FREE]:
            alive = 1
        else:
            for (to, _), bits in start.items():
                alive |= bits if to == first else 0
            for (at, p), bits in self._walk(s, start, first).items():
                alive |= bits if at + len(p) == first else 0
        last = next(i for i in range(end, begin - 1, -1) if self.free(s, i))
        exits = {FREE} if last == end else {(end - at, p) for at, p in self._walk(s, {(last, ""): 1}, end)}
        return {(e, x) for k, e in enumerate(entries) if alive >> k & 1 for x in exits}


def compose(a: Matrix, b: Matrix) -> Matrix:
    """The max-plus product of two matrices of zeros and minus infinities."""
    onward: dict[State, set[State]] = {}
    for middle, exit_ in b:
        onward.setdefault(middle, set()).add(exit_)
    return {(entry, exit_) for entry, middle in a for exit_ in onward.get(middle, ())}


def product(matrices: list[Matrix]) -> Matrix:
    out = matrices[0]
    for m in matrices[1:]:
        out = compose(out, m)
    return out


def scan(matrices: list[Matrix], entry: State = FREE, exit_: State = FREE) -> list[State]:
    """The state at every cut and at both ends.  What leads to a cut from the
    entry and from there to the exit leaves one state that is on a path of
    weight 0."""
    before: list[set[State]] = [{entry}]
    for m in matrices:
        before.append({x for e, x in m if e in before[-1]})
    after: list[set[State]] = [{exit_}]
    for m in reversed(matrices):
        after.append({e for e, x in m if x in after[-1]})
    out = []
    for a, b in zip(before, reversed(after)):
        (state,) = a & b
        out.append(state)
    return out


# --- over tables ---------------------------------------------------------

_STATE = "struct<n:int,piece:string>"
_MATRIX = f"array<struct<entry:{_STATE},exit:{_STATE}>>"
_ARROW_STATE = pa.struct([("n", pa.int32()), ("piece", pa.string())])
_ARROW_MATRIX = pa.list_(pa.struct([("entry", _ARROW_STATE), ("exit", _ARROW_STATE)]))


def _state(x: State) -> dict:
    return {"n": x[0], "piece": x[1]}


def _chunks(chunk_chars: int, context: int):
    """(row, chunk, begin, s): the text of each chunk with its context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                s = SPACE + text.as_py().replace(" ", SPACE)
                cuts = range(0, len(s), chunk_chars)
                for k in range(0, len(cuts), 64):
                    rows = [
                        (row, c // chunk_chars, min(c, context), s[max(0, c - context) : c + chunk_chars + context])
                        for c in cuts[k : k + 64]
                    ]
                    columns = [pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int32(), pa.string()))]
                    yield pa.RecordBatch.from_arrays(columns, ["row", "chunk", "begin", "s"])

    return run


def _matrices(path: str, chunk_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            made = []
            for begin, s in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                m = encoder.matrix(s, begin, min(begin + chunk_chars, len(s)))
                made.append([{"entry": _state(e), "exit": _state(x)} for e, x in sorted(m)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(made, _ARROW_MATRIX)], ["row", "chunk", "matrix"]
            )

    return run


def _of_row(x: dict) -> State:
    return (x["n"], x["piece"])


def _read(column: pa.ChunkedArray) -> list[Matrix]:
    return [{(_of_row(x["entry"]), _of_row(x["exit"])) for x in m} for m in column.to_pylist()]


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (row, run, chunk, matrix) sorted by all: (row, run, matrix), the
    product of each run."""
    for table, at in grouped(batches, 2, least=64):
        matrices = _read(table.column(3))
        made = [product(matrices[s:e]) for s, e in zip(at[:-1], at[1:])]
        first = pa.array(at[:-1])
        yield pa.RecordBatch.from_arrays(
            [
                table.column(0).take(first).combine_chunks(), table.column(1).take(first).combine_chunks(),
                pa.array([[{"entry": _state(e), "exit": _state(x)} for e, x in sorted(m)] for m in made], _ARROW_MATRIX),
            ],
            ["row", "run", "matrix"],
        )


def _scans(keys: int):
    """Of (*keys, part, matrix[, from, to]) sorted by keys and part: the keys
    and part with the states at the ends of each part (entry, exit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in grouped(batches, keys, least=64):
            matrices = _read(table.column(keys + 1))
            ends = [table.column(k).to_pylist() for k in range(keys + 2, table.num_columns)]
            entries, exits = [], []
            for s, e in zip(at[:-1], at[1:]):
                states = [_state(x) for x in scan(matrices[s:e], *[_of_row(end[s]) for end in ends])]
                entries += states[:-1]
                exits += states[1:]
            yield pa.RecordBatch.from_arrays(
                [*[table.column(k).combine_chunks() for k in range(keys + 1)], pa.array(entries, _ARROW_STATE), pa.array(exits, _ARROW_STATE)],
                [*table.schema.names[: keys + 1], "entry", "exit"],
            )

    return run


def _trace(path: str, chunk_chars: int):
    """Ids of the pieces that begin in each chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            ids = []
            for begin, s, entry, exit_ in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4, 5))):
                end = min(begin + chunk_chars, len(s))
                first = begin - entry["n"] + len(entry["piece"])
                ids.append(encoder.encode_part(s[first : end - exit_["n"] + len(exit_["piece"])]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(ids, pa.list_(pa.int32()))], ["row", "chunk", "ids"]
            )

    return run


#: Rows and ids that the library decodes at a time (one row at least): as
#: Python numbers, ids need ten times the memory of their Arrow batch.
DECODE_ROWS, DECODE_IDS = 512, 1 << 16


def _by_ids(batch: pa.RecordBatch, ids_at: int) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with at most so many rows and ids."""
    ends, i = batch.column(ids_at).offsets.to_numpy(), 0
    while i < batch.num_rows:
        j = int(np.searchsorted(ends, ends[i] + DECODE_IDS, side="right")) - 1
        j = min(max(j, i + 1), i + DECODE_ROWS, batch.num_rows)
        yield batch.slice(i, j - i)
        i = j


def _id_lists(column: pa.ListArray) -> tuple[list[list[int]], list[bool]]:
    """The lists that aren't null, and which those are."""
    values, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    there = column.is_valid().to_pylist()
    return [values[s:e].tolist() for s, e, x in zip(ends[:-1], ends[1:], there) if x], there


def _encode_short(path: str, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for whole in batches:
            for k in range(0, whole.num_rows, 512):
                batch = whole.slice(k, 512)
                ids = [np.array(model.encode(t.as_py() or ""), np.int32) for t in batch.column(text_at)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(ids, pa.list_(pa.int32()))], names=[*batch.schema.names, "ids"]
                )

    return run


def encode(docs: DataFrame, model_path: str, chunk_chars: int = CHUNK_CHARS, text_col: str = "text") -> DataFrame:
    """``docs`` with the column ``ids``."""
    own = without(docs, "ids")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields)
    giant = F.char_length(text_or_empty(text_col)) > chunk_chars
    at = own.columns.index(text_col)
    short = own.where(~giant).mapInArrow(_encode_short(model_path, at), f"{schema}, ids array<int>")

    long_ = own.where(giant).select(F.struct(*[F.col(f"`{c}`") for c in own.columns]).alias("doc"))
    long_ = materialize(long_.withColumn("row", F.monotonically_increasing_id()), "giants")
    context = Encoder(model_path).longest
    cut = long_.select("row", F.col("doc")[text_col].alias("text")).mapInArrow(
        _chunks(chunk_chars, context), "row long, chunk int, begin int, s string"
    )
    # The filters are those that the joins below would put under one reader of
    # an exchange alone; with them both readers share it.
    chunks = cut.where("row IS NOT NULL AND chunk IS NOT NULL").repartition("row", "chunk")
    matrices = chunks.mapInArrow(_matrices(model_path, chunk_chars), f"row long, chunk int, matrix {_MATRIX}")
    # one exchange of the matrices, read by the products and by the scans inside the runs
    near = matrices.withColumn("run", F.floor(F.col("chunk") / RUN).cast("int"))
    near = near.where("row IS NOT NULL AND run IS NOT NULL").repartition("row", "run")
    products = near.select("row", "run", "chunk", "matrix").sortWithinPartitions("row", "run", "chunk").mapInArrow(
        _products, f"row long, run int, matrix {_MATRIX}"
    )
    ends = products.repartition("row").sortWithinPartitions("row", "run").mapInArrow(
        _scans(1), f"row long, run int, entry {_STATE}, exit {_STATE}"
    )
    inside = near.join(ends, ["row", "run"]).select("row", "run", "chunk", "matrix", "entry", "exit")
    states = inside.repartition("row", "run").sortWithinPartitions("row", "run", "chunk").mapInArrow(
        _scans(2), f"row long, run int, chunk int, entry {_STATE}, exit {_STATE}"
    ).drop("run")
    traced = chunks.join(states, ["row", "chunk"]).select("row", "chunk", "begin", "s", "entry", "exit")
    parts = traced.mapInArrow(_trace(model_path, chunk_chars), "row long, chunk int, ids array<int>")
    # The ids of a document, as long as its text, are put together in its row.
    whole = parts.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("chunk", "ids"))).alias("parts"))
    joined = long_.join(whole, "row").select("doc.*", F.flatten(F.col("parts.ids")).alias("ids"))
    return short.unionByName(joined)


def decode(encoded: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """The rows with the text of their ids (null: null) in ``out_col``."""
    own = without(encoded, out_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields)
    at = own.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path)
        for whole in batches:
            for batch in _by_ids(whole, at):
                ids, there = _id_lists(batch.column(at))
                # one thread: a task has one core, and every thread keeps memory of its own
                decoded = iter(model.decode(ids, num_threads=1) if ids else [])
                texts = [next(decoded) if x else None for x in there]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out_col]
                )

    return own.mapInArrow(run, f"{schema}, `{out_col}` string")
