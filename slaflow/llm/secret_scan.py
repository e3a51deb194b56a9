"""Secret scans with corpus-wide ownership frequency.

Each text is searched once for candidates.  The hashes of their values are
counted over the whole corpus by distinct owners and repositories (pairs of
owner and repository).  A value that several owners hold, or that stands in
many repositories of few owners, is a widely copied example; a value that
stays with one or two owners in a few places is likely a live credential.
Where no column names the repository, a repository is the text itself: all
copies of a text within an owner are one, as forks and mirrors are.

Candidates are the base patterns (password-like assignments, access keys,
long hex strings) and, outside their spans, long mixed tokens of high
entropy.  Base spans are always reported; a mixed token is reported (kind
``owned``) only if its value is owner-specific.

Defined results: a null text is empty; null owners count as one owner and
null repositories as one repository of it; a repeated row is reported again
but is no new repository (ten other texts of one owner are ten); an empty table gives no rows; of the other columns
only the named ones are read.  Offsets are code points, the end exclusive.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slaflow.llm.common import join_weighted, materialize, text_or_empty

#: Base kinds in the order in which spans that start together are listed.
KINDS = ("assign", "access", "hex", "owned")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_CHARS = 6
#: Runs shorter than these are no matches, and a run is matched whole.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
MIXED = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
MIXED_ENTROPY = 3.5

_SPAN = pa.struct([("start", pa.int32()), ("kind", pa.int8()), ("end", pa.int32()), ("hash", pa.binary())])
_SPANS = "array<struct<start:int,kind:tinyint,end:int,hash:binary>>"


def value_hash(value: str) -> bytes:
    return hashlib.sha256(value.encode("utf-8", "surrogatepass")).digest()[:16]


def entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def find(text: str) -> list[tuple[int, int, int, bytes]]:
    """(start, kind, end, hash) of the candidates in a text, in order."""
    out = [
        (m.start(), 0, m.end(), value_hash(m[2])) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS
    ]
    out += [(m.start(), 1, m.end(), value_hash(m[0])) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end(), value_hash(m[0])) for m in HEX.finditer(text)]
    base = sorted(out)
    for m in MIXED.finditer(text):
        v = m[0]
        if (
            any(c.isdigit() for c in v) and any(c.isalpha() for c in v) and entropy(v) >= MIXED_ENTROPY
            and not any(s < m.end() and m.start() < e for s, _, e, _ in base)
        ):
            out.append((m.start(), 3, m.end(), value_hash(v)))
    return sorted(out)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = [find(t.as_py() or "") for t in batch.column(3)]
        found = pa.array(
            [[{"start": s, "kind": k, "end": e, "hash": h} for s, k, e, h in x] for x in spans], pa.list_(_SPAN)
        )
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), found], ["doc_id", "owner", "repo", "found"]
        )


def candidates(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repo_col: str | None) -> DataFrame:
    """(row, doc_id, owner, repo, found) of every row, written once; row
    numbers are those of the written table."""
    picked = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(owner_col).cast("string").alias("owner"),
        (F.col(repo_col).cast("string") if repo_col else F.md5(text_or_empty(text_col).cast("binary"))).alias("repo"),
        F.col(text_col).alias("text"),
    )
    id_type = picked.schema["doc_id"].dataType.simpleString()
    found = picked.mapInArrow(_scan, f"doc_id {id_type}, owner string, repo string, found {_SPANS}")
    return materialize(found.withColumn("row", F.monotonically_increasing_id()), "secret-candidates")


def ownership(found: DataFrame) -> DataFrame:
    """(hash, n_repos, n_owners, n) of every candidate value, ``n`` the number
    of its spans.  Each step is combined before its shuffle, so a value that a
    third of all rows hold costs a row for each task and repository."""
    held = found.where(F.size("found") > 0).select("owner", "repo", F.explode("found.hash").alias("hash"))
    return (
        held.groupBy("hash", "owner", "repo").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("hash", "owner").agg(F.count("n").alias("repos"), F.sum("n").alias("n"))
        .groupBy("hash").agg(F.sum("repos").alias("n_repos"), F.count("repos").alias("n_owners"), F.sum("n").alias("n"))
    )


def span_list(spans: Column) -> Column:
    """kind:start:end of sorted spans, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"].cast("int")), s["start"], s["end"])), ","
    )


def scan_secrets(
    docs: DataFrame,
    example_owners: int = 3,
    example_repos: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repo_col: str | None = None,
) -> DataFrame:
    """(doc_id, base, spans, n_live, n_example, max_owners, max_repos) of every
    row: ``base`` and ``spans`` are arrays of (start, kind, end, hash) in
    order, the latter with the owner-specific mixed tokens; the numbers tell
    how many candidates are owner-specific and how many are copied examples
    (values of at least ``example_owners`` owners or ``example_repos``
    repositories), and how many owners and repositories the most widely held
    candidate has (none: 0)."""
    found = candidates(docs, id_col, text_col, owner_col, repo_col)
    live = (F.col("n_owners") < example_owners) & (F.col("n_repos") < example_repos)
    known = materialize(ownership(found).withColumn("live", live), "secret-owners")
    spans = found.where(F.size("found") > 0).select("row", F.explode("found").alias("span"))
    judged = join_weighted(spans.withColumn("hash", F.col("span.hash")), known, "hash")
    per_row = judged.groupBy("row").agg(
        F.collect_list(F.when(F.col("live") & (F.col("span.kind") == 3), F.col("span"))).alias("owned"),
        F.sum(F.col("live").cast("long")).alias("n_live"),
        F.sum((~F.col("live")).cast("long")).alias("n_example"),
        F.max("n_owners").alias("max_owners"),
        F.max("n_repos").alias("max_repos"),
    )
    base = F.filter("found", lambda s: s["kind"] < 3)
    return found.join(per_row, "row", "left").select(
        "doc_id",
        base.alias("base"),
        F.when(F.col("owned").isNull(), base).otherwise(F.array_sort(F.concat(base, "owned"))).alias("spans"),
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_live", "n_example", "max_owners", "max_repos")],
    )
