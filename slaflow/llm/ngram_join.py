"""N-gram Jaccard join by chosen paths.

All pairs of texts whose sets of five-word shingles have a Jaccard
similarity of at least ``THRESHOLD`` are linked:

1. Texts with the same set of shingles are one class; one of them stands for
   all.  A class gets a signature of ``TOKENS`` min-hashes; position and
   value make a token, and two sets share a token with the probability of
   their similarity.
2. Chosen paths: at a node of the recursion, randomness that all sets share
   picks each token with the probability 1 / (THRESHOLD * TOKENS), so a
   similar pair is expected to keep one of its shared tokens, and the set
   goes on into the bucket of each picked token.  Buckets of one set end
   there; those of at most ``BUCKET`` sets are compared in full (by
   signature, below the threshold by a margin).  Of a larger one, all sets
   are compared with a pivot.  If few are unlike it, the bucket is dense and
   further splits would hardly cut it: those few are compared with all, in
   blocks, and it is done.  Else it is split again, ``DEPTH`` times at most;
   what is left then is compared in blocks too.  The recursion is repeated ``runs`` times, as often as the target recall
   needs at the full depth.
3. Candidate links only say which classes may belong together.  Within such
   a group the sets are built from the texts again and compared exactly, in
   blocks of bounded size; each class gets the number of its links, and a
   spanning forest of them makes the components.

Pairs are never expanded: buckets and blocks give back spanning links and
counts, at most two rows for each of their sets.

Defined results: a null text is empty; texts of one to four words have one
shingle of all words; texts without words are only like equal texts; a row
with a null id takes no part (``class_id`` null, no links); identical rows
are copies of each other; an empty table gives no rows; other columns aren't
read.  Ids are whole numbers; a table whose ids have another type is refused
(number its texts first).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from slaflow.llm.common import join_weighted, materialize, split_batch, string_buffers, text_or_empty
from slaflow.llm.components import components
from slaflow.llm.words import mix, shingles, words

WORDS = 5
THRESHOLD = 0.8
TOKENS = 128
#: Signatures must agree in this share of their tokens: about 5 standard
#: errors (0.035 at the threshold) less than the threshold, so that what this
#: sieve loses (1.4e-6 of the pairs at the threshold) is nothing beside
#: 1 - RECALL.  The exact comparison drops what it lets through.
SIGNATURE_SHARE = 0.62
BUCKET = 256
DEPTH = 4
RECALL = 0.999
#: Sets and shingles in a block of the exact comparison.
BLOCK_SETS, BLOCK_SHINGLES = 256, 1_000_000

_SEEDS = mix(np.arange(1, 2 * TOKENS + 1, dtype=np.uint64))
_FACTORS = (_SEEDS[:TOKENS] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_SHIFTS = (_SEEDS[TOKENS:] >> np.uint64(32)).astype(np.uint32)
_PICK = np.uint64(int(2**64 / (THRESHOLD * TOKENS)))


def survival(depth: int) -> float:
    """The probability that a pair at the threshold shares a bucket after
    ``depth`` splits: the number of shared picks is about Poisson with mean
    one, so this is the survival of a critical branching process."""
    p = 1.0
    for _ in range(depth):
        p = 1 - math.exp(-p)
    return p


def n_runs(recall: float = RECALL, depth: int = DEPTH) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - survival(depth)))


# --- sets and signatures -------------------------------------------------


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    h, _, _, bounds = words(*string_buffers(column))
    sh, at = shingles(h, bounds, WORDS)
    return [np.unique(sh[at[i] : at[i + 1]]) for i in range(len(at) - 1)]


def set_digest(shingle_set: np.ndarray, text: str) -> bytes:
    if len(shingle_set):
        return hashlib.blake2b(shingle_set.tobytes(), digest_size=16).digest()
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16, person=b"no words").digest()


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The min-hashes of each set (zeros for an empty one)."""
    out = np.zeros((len(sets), TOKENS), np.uint32)
    full = [i for i, s in enumerate(sets) if len(s)]
    if full:
        values = (np.concatenate([sets[i] for i in full]) >> np.uint64(32)).astype(np.uint32)
        starts = np.concatenate([[0], np.cumsum([len(sets[i]) for i in full])[:-1]])
        for k in range(TOKENS):
            out[full, k] = np.minimum.reduceat(values * _FACTORS[k] + _SHIFTS[k], starts)
    return out


def _binary(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows)
    n, width = len(rows), rows.shape[1] * rows.itemsize
    offsets = pa.py_buffer((np.arange(n + 1) * width).astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), n, [None, offsets, pa.py_buffer(rows.tobytes())])


def _matrix(column: pa.Array, width: int = TOKENS) -> np.ndarray:
    raw, _ = string_buffers(column.cast(pa.large_binary()).view(pa.large_string()))
    return raw.reshape(len(column), width)


def _planes(signature: np.ndarray) -> np.ndarray:
    """The bytes of each signature, the last byte of every token first: those
    are enough to compare two signatures and a quarter as long."""
    return signature.view(np.uint8).reshape(-1, TOKENS, 4).transpose(0, 2, 1).reshape(-1, 4 * TOKENS)


def _signature(column: pa.Array) -> np.ndarray:
    planes = _matrix(column, 4 * TOKENS).reshape(-1, 4, TOKENS)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.uint32).reshape(-1, TOKENS)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in split_batch(whole):
            sets = shingle_sets(batch.column(1))
            digests = [set_digest(s, "" if len(s) else t.as_py()) for s, t in zip(sets, batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                 _binary(_planes(signatures(sets)))],
                ["doc_id", "digest", "n", "signature"],
            )


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    picked = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")
    )
    return materialize(
        picked.mapInArrow(_sketch, "doc_id long, digest binary, n long, signature binary"), "sketches"
    )


def classes(sketched: DataFrame) -> DataFrame:
    """One row for each set: (node, digest, first, copies, n, signature,
    short); ``short`` has the last byte of each token.  Copies are combined
    before the shuffle; the node numbers are those of the written table."""
    made = sketched.groupBy("digest").agg(
        F.min("doc_id").alias("first"), F.count("doc_id").alias("copies"), F.first("n").alias("n"),
        F.first("signature").alias("signature"),
    )
    short = made.withColumn("short", F.substring("signature", 1, TOKENS))
    return materialize(short.withColumn("node", F.monotonically_increasing_id()), "classes")


# --- chosen paths --------------------------------------------------------


def _tokens(signature: np.ndarray) -> np.ndarray:
    return mix(signature.astype(np.uint64) + (np.arange(TOKENS, dtype=np.uint64) << np.uint64(32)))


def _children(paths: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sets at nodes ``paths``: which set goes on, and into which node."""
    h = mix(tokens ^ paths[:, None])
    at, k = np.nonzero(h < _PICK)
    return at, mix(h[at, k] + np.uint64(0x5851F42D4C957F2D))


def _first_paths(runs: int) -> Callable:
    roots = mix(np.arange(1, runs + 1, dtype=np.uint64) << np.uint64(20))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 2048):
                batch = whole.slice(i, 2048)
                tokens, nodes = _tokens(_signature(batch.column(1))), batch.column(0).to_numpy()
                made = [_children(np.full(len(nodes), r, np.uint64), tokens) for r in roots]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([p for _, p in made]).view(np.int64)),
                     pa.array(np.concatenate([nodes[at] for at, _ in made]))],
                    ["path", "node"],
                )

    return run


def _next_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for i in range(0, whole.num_rows, 2048):
            batch = whole.slice(i, 2048)
            nodes = batch.column(1).to_numpy()
            at, paths = _children(batch.column(0).to_numpy().view(np.uint64), _tokens(_signature(batch.column(2))))
            yield pa.RecordBatch.from_arrays([pa.array(paths.view(np.int64)), pa.array(nodes[at])], ["path", "node"])


def grouped(batches: Iterator[pa.RecordBatch], n_keys: int, least: int = 4096) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups of rows with equal first columns, from batches sorted by
    them: tables of many groups (at least ``least`` rows but for the last)
    and the n + 1 offsets of the groups."""
    held: list[pa.RecordBatch] = []
    size = 0

    def cuts(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        new[:1] = True
        for k in range(n_keys):
            c = table.column(k).to_numpy()
            new[1:] |= c[1:] != c[:-1]
        return np.flatnonzero(new)

    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < least:
            continue
        table = pa.Table.from_batches(held)
        at = cuts(table)
        if len(at) > 1:
            yield table.slice(0, int(at[-1])).combine_chunks(), at
        held = table.slice(int(at[-1])).combine_chunks().to_batches()
        size = sum(b.num_rows for b in held)
    if size:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, np.append(cuts(table), table.num_rows)


def spanning(like: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the graph with the adjacency matrix ``like``."""
    left = np.ones(len(like), bool)
    out = []
    for root in range(len(like)):
        if not left[root]:
            continue
        left[root] = False
        front = [root]
        while front:
            a = front.pop()
            new = np.flatnonzero(like[a] & left)
            left[new] = False
            out += [(a, int(b)) for b in new]
            front += new.tolist()
    return out


_LEAST_EQUAL = math.ceil(SIGNATURE_SHARE * TOKENS)


def _agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each row of ``a`` agrees with each of ``b`` in enough tokens."""
    return np.stack([(b == x).sum(1, dtype=np.int16) >= _LEAST_EQUAL for x in a]) if len(a) else np.zeros((0, len(b)), bool)


def _edges(pairs: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    u = np.concatenate([p[0] for p in pairs]) if pairs else np.zeros(0, np.int64)
    v = np.concatenate([p[1] for p in pairs]) if pairs else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning links of groups (path, a, b, node, loose, short): of a whole
    bucket (``a`` is negative) between any two sets, of a pair of blocks
    between the loose sets and the others."""
    for table, at in grouped(batches, 3):
        nodes, loose = table.column(3).to_numpy(), table.column(4).to_numpy(zero_copy_only=False)
        signature = _matrix(table.column(5).combine_chunks())
        starts, sizes, out = at[:-1], np.diff(at), []
        whole = table.column(1).to_numpy()[starts] < 0
        pair = whole & (sizes == 2)
        two = starts[pair]
        for i in range(0, len(two), 8192):
            a = two[i : i + 8192]
            like = (signature[a] == signature[a + 1]).sum(1, dtype=np.int16) >= _LEAST_EQUAL
            out.append((nodes[a[like]], nodes[a[like] + 1]))
        for s, n, every in zip(starts[~pair], sizes[~pair], whole[~pair]):
            if every:
                ids, like = np.arange(s, s + n), _agree(signature[s : s + n], signature[s : s + n])
            else:
                a, b = s + np.flatnonzero(loose[s : s + n]), s + np.flatnonzero(~loose[s : s + n])
                ids, like = np.concatenate([a, b]), np.zeros((n, n), bool)
                like[: len(a), len(a) :] = _agree(signature[a], signature[b])
                like |= like.T
            forest = spanning(like)
            if forest:
                x, y = np.array(forest).T
                out.append((nodes[ids[x]], nodes[ids[y]]))
        yield _edges(out)


def _against_pivots(large: DataFrame) -> DataFrame:
    """(path, node, short, pivot, like) of the sets in large buckets: whether
    each agrees with the bucket's pivot, which is one of its sets."""
    # written, so that Spark knows how few they are
    pivots = materialize(large.where("node = pivot").select("path", F.col("short").alias("of_pivot")), "pivots")
    pairs = large.join(pivots, "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = _matrix(batch.column(2)) == _matrix(batch.column(4))
            like = pa.array(same.sum(1, dtype=np.int16) >= _LEAST_EQUAL)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], like], ["path", "node", "short", "pivot", "like"])

    judged = pairs.select("path", "node", "short", "pivot", "of_pivot").mapInArrow(
        run, "path long, node long, short binary, pivot long, like boolean"
    )
    return materialize(judged, "judged")


def _in_blocks(rest: DataFrame) -> DataFrame:
    """Rows for ``_compare``, of (path, node, short, like, n, n_loose): the
    sets unlike their bucket's pivot and all its sets, in pairs of blocks."""
    mine = F.xxhash64("node")
    sized = rest.withColumns(
        {"blocks": F.ceil(F.col("n") / BUCKET).cast("int"), "loose_blocks": F.ceil(F.col("n_loose") / BUCKET).cast("int")}
    )
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    every = sized.select(
        "path", upto("loose_blocks").alias("a"), F.pmod(mine, "blocks").cast("int").alias("b"), "node",
        F.lit(False).alias("loose"), "short",
    )
    loose = sized.where(~F.col("like")).select(
        "path", F.pmod(mine, "loose_blocks").cast("int").alias("a"), upto("blocks").alias("b"), "node",
        F.lit(True).alias("loose"), "short",
    )
    return every.unionByName(loose)


def candidate_links(known: DataFrame, recall: float = RECALL, depth: int = DEPTH) -> DataFrame:
    """Spanning links (u, v) between nodes that share a bucket and whose
    signatures agree, of all runs."""
    sets = known.where("n > 0")
    rows = sets.select("node", "signature").mapInArrow(_first_paths(n_runs(recall, depth)), "path long, node long")
    near, groups = [], []
    for level in range(1, depth + 1):
        rows = materialize(rows, f"paths-{level}")
        sizes = rows.groupBy("path").agg(F.count("node").alias("size"), F.min("node").alias("pivot")).where("size > 1")
        shared = materialize(
            rows.join(sizes, "path").join(sets.select("node", "short"), "node").select("path", "node", "short", "size", "pivot"),
            f"buckets-{level}",
        )
        no_block = F.lit(-1)
        groups.append(shared.where(F.col("size") <= BUCKET).select(
            "path", no_block.alias("a"), no_block.alias("b"), "node", F.lit(False).alias("loose"), "short"
        ))
        large = shared.where(F.col("size") > BUCKET).select("path", "node", "short", "pivot")
        if large.isEmpty():
            break
        judged = _against_pivots(large)
        near.append(judged.where("like").select(F.col("node").alias("u"), F.col("pivot").alias("v")))
        counts = judged.groupBy("path").agg(F.count("node").alias("n"), F.count_if(~F.col("like")).alias("n_loose"))
        counts = materialize(counts.where("n_loose > 0"), "loose")
        done = F.lit(True) if level == depth else F.col("n_loose") <= BUCKET
        groups.append(_in_blocks(judged.join(counts.where(done), "path").select("path", "node", "short", "like", "n", "n_loose")))
        sparse = counts.where(~done).select("path")
        if level == depth or sparse.isEmpty():
            break
        rows = (
            judged.select("path", "node").join(sparse, "path").join(sets.select("node", "signature"), "node")
            .select("path", "node", "signature").mapInArrow(_next_paths, "path long, node long")
        )
    # the groups of all levels in one shuffle: no two levels share a path
    spread = reduce(DataFrame.unionByName, groups).repartition("path", "a", "b").sortWithinPartitions("path", "a", "b")
    return reduce(DataFrame.unionByName, near, spread.mapInArrow(_compare, "u long, v long"))


# --- exact comparison ----------------------------------------------------


def overlaps(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """How many shingles each two sets share."""
    m = len(sets)
    if m <= 6:
        out = np.zeros((m, m))
        for i in range(m):
            for j in range(i):
                out[i, j] = out[j, i] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        return out
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    keep = shared[token]
    token, owner = number[token[keep]], owner[keep]
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    out = np.zeros((m, m), np.float64)
    n_shared = int(shared.sum())
    for first in range(0, n_shared, width):
        a, b = np.searchsorted(token, [first, first + width])
        x = np.zeros((m, min(width, n_shared - first)), np.float32)
        x[owner[a:b], token[a:b] - first] = 1
        out += x @ x.T
    return out


_EXACT = "kind int, u long, v long, links long"


def labels(n: int, forest: list[tuple[int, int]]) -> list[int]:
    """The smallest member of each node's tree."""
    out = list(range(n))

    def root(k: int) -> int:
        while out[k] != k:
            out[k] = k = out[out[k]]
        return k

    for a, b in forest:
        a, b = sorted((root(a), root(b)))
        out[b] = a
    return [root(k) for k in range(n)]


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of groups (component, a, b, chunk, node, copies, digest, chunks, text):
    the number of linked documents of each set (kind 0) and spanning links
    (kind 1).  A group with a = b compares all its sets, others those of
    different chunks.  Where the group is all there is of its component
    (chunks = 1), each linked set gets its smallest node (kind 2) instead."""
    for table, at in grouped(batches, 3, least=64):
        a, b, chunk = (table.column(k).to_numpy() for k in (1, 2, 3))
        nodes, copies, digests = table.column(4).to_numpy(), table.column(5).to_numpy(), table.column(6).to_pylist()
        chunks, texts = table.column(7).to_numpy(), table.column(8).combine_chunks()
        out: list[tuple[int, int, int, int]] = []
        for s, e in zip(at[:-1].tolist(), at[1:].tolist()):
            sets = shingle_sets(texts.slice(s, e - s))
            seen: dict[int, int] = {}
            for k, x in enumerate(sets):
                if set_digest(x, "") == digests[s + k]:
                    seen.setdefault(int(nodes[s + k]), k)
            pick = np.array(list(seen.values()), int)
            if len(pick) < 2:
                continue
            sets = [sets[k] for k in pick]
            own, weight, part = nodes[s + pick], copies[s + pick], chunk[s + pick]
            sizes = np.array([len(x) for x in sets])
            # J >= 4/5 means 9 * |both| >= 4 * (|a| + |b|)
            like = 9 * overlaps(sets) >= 4 * (sizes[:, None] + sizes[None, :])
            np.fill_diagonal(like, False)
            if a[s] != b[s]:
                like &= part[:, None] != part[None, :]
            linked = like @ weight
            out += [(0, int(own[k]), 0, int(linked[k])) for k in np.flatnonzero(linked)]
            forest = spanning(like)
            if chunks[s] > 1:
                out += [(1, int(own[i]), int(own[j]), 0) for i, j in forest]
            elif forest:
                order = np.argsort(own)  # the smallest index is the smallest node then
                place = np.argsort(order)
                label = labels(len(own), [(int(place[i]), int(place[j])) for i, j in forest])
                out += [(2, int(own[k]), int(own[order[label[place[k]]]]), 0) for k in np.flatnonzero(linked)]
        columns = zip(*out) if out else ([], [], [], [])
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
            ["kind", "u", "v", "links"],
        )


def exact_links(docs: DataFrame, known: DataFrame, groups: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Exact comparison of the classes within each group of ``groups`` (node,
    component)."""
    members = materialize(groups.join(known.select("node", "digest", "first", "copies", "n"), "node"), "members")
    chunks = members.groupBy("component").agg(
        F.ceil(F.greatest(F.count("node") / BLOCK_SETS, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("chunks"),
        F.count("node").alias("nodes"),
    )
    placed = join_weighted(members, materialize(chunks, "chunks"), "component", "nodes").withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks").cast("int"))
    texts = docs.select(F.col(id_col).cast("long").alias("first"), text_or_empty(text_col).alias("text"))
    other = placed.join(texts, "first").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    keyed = other.select(
        "component", F.least("chunk", "other").alias("a"), F.greatest("chunk", "other").alias("b"), "chunk", "node",
        "copies", "digest", "chunks", "text",
    )
    spread = keyed.repartition("component", "a", "b").sortWithinPartitions("component", "a", "b")
    return materialize(spread.mapInArrow(_exact, _EXACT), "exact-links")


def ngram_join(
    docs: DataFrame, recall: float = RECALL, depth: int = DEPTH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, class_id, n_links, n_copies) of every row: the smallest id of
    the component of links it belongs to, the number of other rows with a
    similarity of at least the threshold (copies among them), and the number
    of rows with the same set of shingles."""
    id_type = docs.select(id_col).schema[0].dataType
    if not isinstance(id_type, IntegralType):
        raise TypeError(f"{id_col} has the type {id_type.simpleString()}; ids must be whole numbers")
    sketched = sketches(docs, id_col, text_col)
    known = classes(sketched)
    groups = components(candidate_links(known, recall, depth))
    exact = exact_links(docs, known, groups, id_col, text_col)
    links = exact.where("kind = 0").groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links"))
    parts = exact.where("kind = 2").select(F.col("u").alias("node"), F.col("v").alias("component"))
    across = exact.where("kind = 1").select("u", "v")
    if not across.isEmpty():
        parts = parts.unionByName(components(across))
    parts = materialize(parts.join(known.select("node", "first"), "node"), "parts")
    firsts = materialize(parts.groupBy("component").agg(F.min("first").alias("class_id"), F.count("node").alias("nodes")), "firsts")
    parts = join_weighted(parts.select("node", "component"), firsts, "component", "nodes").select("node", "class_id")
    placed = materialize(
        known.select("node", "digest", "first", "copies").join(links, "node", "left").join(parts, "node", "left")
        .select("digest", "copies", F.coalesce("class_id", "first").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"), F.col("copies").alias("rows")),
        "placed",
    )
    joined = join_weighted(sketched.select("doc_id", "digest"), placed, "digest", "rows").select(
        "doc_id", "class_id", (F.col("copies") - 1 + F.col("links")).alias("n_links"), F.col("copies").alias("n_copies")
    )
    nameless = docs.where(F.col(id_col).isNull()).select(
        F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("class_id"),
        F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("n_copies"),
    )
    return joined.unionByName(nameless)
