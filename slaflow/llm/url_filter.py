"""URL filter: host and path rules, and a character language-model ratio for
the URLs that no rule decides.

A rule names a host and a path prefix; it fits its host and all subdomains.
The longest fitting rule wins (of equally long ones that with the longer
host, then one that blocks).

The URLs that rules accept and reject are what two variable-order Markov
models are learnt from, character by character over the lower-cased URL
between a start and an end mark.  With the counts n of a class, a character
c after a context s has the probability

    P(c | s) = (n(sc) + m P(c | s')) / (n(s) + m),

where s' is s without its first character, down to one over the number of
code points; a context that was never seen leaves P(c | s') as it is, so the
order varies with what is known.  Multiplied out, the log-likelihood of a URL
is a sum over its substrings of up to ``order`` + 1 characters: each one adds
what it changes as a prediction, and, as a context, the logarithm of
m / (n(s) + m).  The difference of both classes is therefore one whole number
(of millionths) for each substring, and a URL's score is their sum over its
length.

A substring enters the models if it holds at least one in ``support`` of the
training characters; so there are ``support`` substrings of each length at
most, whatever the size of the input, and the weights can be broadcast.

Calibration: a quarter of the judged URLs (by digest) is not learnt from; the
threshold is the multiple of a hundredth of a unit at which the shares of
accepted URLs at or above it and rejected ones below it have the largest sum
(of equally good ones the nearest to zero, then the larger); zero if one
class has no such URL.

All of it is DataFrame expressions.  Every distinct judged URL counts once.
Substrings are summed within tasks before anything is shuffled, and rows are
kept apart by numbers of their own, so equal URLs don't meet in a task.

Defined results: a null or empty URL, or one without ``://``, has an empty
host and path, and is judged like any other; so are very long ones.  Without
judged URLs all scores are zero, which is accepted.  Rows that share an id
are judged each by itself.  An empty table stays empty.  Other columns are
left out.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slaflow.llm.common import ascii_lower, materialize, text_or_empty

#: Marks of the two ends of a URL.
START, END = "\x02", "\x03"
CODE_POINTS = 1_114_112 + 1
MILLION = 1_000_000
#: Width of a step of the threshold, in millionths.
STEP = 10_000


class Rule(NamedTuple):
    action: str  # allow or block
    host: str
    path: str


def host_and_path(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    found = lambda k: F.regexp_extract(text_or_empty(url), pattern, k)
    return ascii_lower(found(1)), found(2)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and action of the rule that decides, or null."""
    for r in rules:
        if r.action not in ("allow", "block"):
            raise ValueError(f"a rule allows or blocks; it can't {r.action!r}")
    ordered = sorted(rules, key=lambda r: (-len(r.host) - len(r.path), -len(r.host), r.action != "block"))
    text, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in reversed(ordered):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        text = F.when(fits, F.lit(r.host + r.path)).otherwise(text)
        action = F.when(fits, F.lit(r.action)).otherwise(action)
    return text, action


def substrings(df: DataFrame, text: str, order: int, *keep: str) -> DataFrame:
    """A row (*keep, gram) for each substring of up to ``order`` + 1
    characters of the marked text.  The characters are cut once; a substring
    joins neighbours from shifted copies of their array."""
    chars = F.concat(F.array(F.lit(START)), F.filter(F.split(text, ""), lambda c: c != ""), F.array(F.lit(END)))
    cut = df.select(*keep, chars.alias("c0"))
    cut = cut.select("*", *[F.slice("c0", k + 1, F.size("c0")).alias(f"c{k}") for k in range(1, order + 1)])
    rows = F.arrays_zip(*[F.col(f"c{k}") for k in range(order + 1)])
    grams = F.transform(rows, lambda r: F.array(*[F.concat(*[r[f"c{j}"] for j in range(k + 1)]) for k in range(order + 1)]))
    return cut.select(*keep, F.explode(F.flatten(grams)).alias("gram")).where("gram IS NOT NULL")


class Model(NamedTuple):
    """``weights`` (gram, weight) in millionths; ``base`` is added for every
    character and the end mark."""

    weights: DataFrame
    base: int
    order: int


def learn(judged: DataFrame, order: int, support: int, smoothing: float) -> Model:
    """The two models, as a written table of weights, from (text, accepted)."""
    grams = substrings(judged, "text", order, "accepted")
    counted = materialize(
        grams.groupBy("gram").agg(F.count_if("accepted").alias("a"), F.count_if(~F.col("accepted")).alias("r")), "url-grams"
    )
    total = counted.where(F.char_length("gram") == 1).agg(F.coalesce(F.sum(F.col("a") + F.col("r")), F.lit(0)).alias("n")).first()["n"]
    known = counted.where((F.col("a") + F.col("r")) * support >= total)
    predicted = known.where(F.col("gram") != START)
    context = F.expr("left(gram, char_length(gram) - 1)")
    after = predicted.groupBy(context.alias("context")).agg(F.sum("a").alias("na"), F.sum("r").alias("nr"))
    stats = materialize(predicted.withColumn("context", context).join(after, "context"), "url-contexts")

    # every substring with the counts of all its ends, shortest first
    tails = F.transform(F.sequence(F.lit(1), F.char_length("gram")), lambda k: F.substring("gram", -k, k))
    ends = predicted.select("gram", F.posexplode(tails).alias("k", "end"))
    own = stats.select(F.col("gram").alias("end"), F.struct("a", "r", "na", "nr").alias("counts"))
    chains = ends.join(own, "end").groupBy("gram").agg(F.sort_array(F.collect_list(F.struct("k", "counts"))).alias("chain"))

    def step(p: Column, c: Column, n: str, total: str) -> Column:
        return (c["counts"][n] + smoothing * p) / (c["counts"][total] + smoothing)

    def change(n: str, total: str) -> Column:
        shorter = F.slice("chain", F.lit(1), F.size("chain") - 1)
        before = F.aggregate(shorter, F.lit(1 / CODE_POINTS), lambda p, c: step(p, c, n, total))
        last = F.element_at("chain", -1)
        return F.log(step(before, last, n, total)) - F.log(before) - F.log(smoothing / (last["counts"][total] + smoothing))

    as_prediction = chains.select("gram", (change("a", "na") - change("r", "nr")).alias("w"))
    escape = F.log(smoothing / (F.col("na") + smoothing)) - F.log(smoothing / (F.col("nr") + smoothing))
    as_context = after.where("context <> ''").select(F.col("context").alias("gram"), escape.alias("w"))
    weights = as_prediction.unionByName(as_context).groupBy("gram").agg(F.sum(F.round(F.col("w") * MILLION).cast("long")).alias("weight"))
    n = predicted.where(F.char_length("gram") == 1).agg(F.sum("a").alias("a"), F.sum("r").alias("r")).first()
    base = math.log(((n["r"] or 0) + smoothing) / ((n["a"] or 0) + smoothing))
    return Model(materialize(weights, "url-weights"), round(base * MILLION), order)


def score(rows: DataFrame, model: Model) -> DataFrame:
    """(row, score) of rows (row, text): the log-likelihood difference over
    the number of characters and the end mark, in whole millionths."""
    found = substrings(rows, "text", model.order, "row").join(F.broadcast(model.weights), "gram", "left")
    n = F.count_if((F.char_length("gram") == 1)) - 1
    total = F.coalesce(F.sum("weight"), F.lit(0)) + n * model.base
    return found.groupBy("row").agg(F.floor(total / n).cast("long").alias("score"))


def threshold(scored: DataFrame) -> int:
    """The calibrated threshold of rows (accepted, score)."""
    steps = scored.groupBy(F.floor(F.col("score") / STEP).alias("step")).agg(
        F.count_if("accepted").alias("a"), F.count_if(~F.col("accepted")).alias("r")
    )
    # the steps are as many as scores have hundredths, not as many as the rows
    down = Window.orderBy(F.col("step").desc())
    whole = Window.partitionBy(F.lit(0))
    below = F.sum("r").over(whole) - F.sum("r").over(down)
    right = F.sum("a").over(down) / F.sum("a").over(whole) + below / F.sum("r").over(whole)
    both = (F.sum("a").over(whole) > 0) & (F.sum("r").over(whole) > 0)
    # all thresholds above the next lower step are as good
    lower = F.lead("step").over(down)
    nearest = F.when(F.col("step") <= 0, F.col("step")).when(F.coalesce(lower < 0, F.lit(True)), 0).otherwise(lower + 1)
    best = (
        steps.select(nearest.alias("step"), F.when(both, right).alias("right")).where("right IS NOT NULL")
        .orderBy(F.col("right").desc(), F.abs("step"), F.col("step").desc()).limit(1).collect()
    )
    return best[0]["step"] * STEP if best else 0


def filter_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    order: int = 4,
    support: int = 40_000,
    smoothing: float = 2.0,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """(page_id, host, path, rule, verdict, score, threshold) of every page;
    the last two, in millionths, where no rule decides."""
    host, path = host_and_path(F.col(url_col))
    parsed = pages.select(F.col(id_col).alias("page_id"), ascii_lower(text_or_empty(url_col)).alias("text"), host.alias("host"), path.alias("path"))
    rule, action = rule_of(F.col("host"), F.col("path"), rules)
    parsed = parsed.select("*", rule.alias("rule"), action.alias("action"))
    decided, open_ = parsed.where("action IS NOT NULL"), parsed.where("action IS NULL")

    judged = materialize(decided.select("text", (F.col("action") == "allow").alias("accepted")).distinct(), "url-judged")
    held_out = F.substring(F.md5(F.col("text").cast("binary")), 1, 1) < "4"
    model = learn(judged.where(~held_out), order, support, smoothing)
    check = judged.where(held_out).withColumn("row", F.monotonically_increasing_id())
    check = materialize(check, "url-check")
    limit = threshold(score(check, model).join(check.select("row", "accepted"), "row"))

    rest = materialize(open_.withColumn("row", F.monotonically_increasing_id()), "url-open")
    allowed = F.when(F.col("score") >= limit, "allow").otherwise("block")
    by_model = rest.join(score(rest, model), "row").select(
        "page_id", "host", "path", "rule", allowed.alias("verdict"), "score", F.lit(limit).cast("long").alias("threshold")
    )
    none = F.lit(None).cast("long")
    by_rule = decided.select("page_id", "host", "path", "rule", F.col("action").alias("verdict"), none.alias("score"), none.alias("threshold"))
    return by_rule.unionByName(by_model)
