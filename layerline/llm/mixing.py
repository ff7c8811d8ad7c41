"""Mixing sources to target weights by temperature, realised as budgeted block permutations.

Weights lie on the path ``w(x) ~ natural ** (1 - x) * target ** x``, where ``natural`` are the sources' shares
of all tokens: x = 1 is the target, x = 0 the natural mix, and for an even target w(x) is the usual
temperature form ``natural ** (1 - x)``. The exponent x is found by bisection: the greatest at which no source
repeats more often than allowed at the budget asked for (``EPOCHS`` passes over all tokens of the mix's sources, a
setting), or the one that reaches a target entropy. So where the limit allows the target shares they are met
(x = 1), and where a small source would repeat too often all shares move towards the natural ones just as far as
it takes; the actual shares are reported beside the targets. Without a budget the mix is as large as the repetition limit
allows at the exact target shares (``p7_exact_shares``).

A source's budget is so many whole passes over its documents plus one partial pass. For that pass the
source's documents, in blocks by a hash, are permuted block by block and taken until the budget is met:
whole blocks by their sums, and only in the block that the budget cuts document by document. So a
source of any size is cut without sorting it, and a document is used at most passes + 1 times, which the
limit bounds.

Defined results: null ids, texts and sources and texts without tokens are never drawn; repeated rows of a document count
once; a source without documents gets no share, and the targets of the others are scaled up to one; targets
that are null or not positive are dropped; a mix without any usable source yields its target rows only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..errors import EngineError
from ..session import checkpointed, read_table
from .tokens import VOCABULARY, token_sizes

BLOCK_DOCS = 1000
MOST_BLOCKS = 1 << 20
MOST_TARGETS = 10_000
#: Setting: the size of a mix, as a multiple of all tokens of its sources.
EPOCHS = 1.0


def normalised(weights: dict[str, float]) -> dict[str, float]:
    total = math.fsum(weights.values())
    return {k: v / total for k, v in weights.items()} if total > 0 else {}


def on_path(natural: dict[str, float], target: dict[str, float], x: float) -> dict[str, float]:
    """Weights at exponent ``x``, through logarithms so that tiny shares survive."""
    logs = {s: (1 - x) * math.log(natural[s]) + x * math.log(target[s]) for s in target}
    top = max(logs.values())
    return normalised({s: math.exp(v - top) for s, v in logs.items()})


def entropy(weights: dict[str, float]) -> float:
    return -math.fsum(w * math.log(w) for w in weights.values() if w > 0)


def _bisect(holds, lo: float, hi: float) -> float:
    """The edge in [lo, hi] up to which ``holds``, which holds at ``lo``."""
    if holds(hi):
        return hi
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if holds(mid) else (lo, mid)
    return lo


def exponent_for_entropy(natural: dict[str, float], goal: float) -> float:
    """Exponent x of ``natural ** (1 - x)`` whose weights have the entropy ``goal``; 0 at least, 1 (even) at most."""
    even = dict.fromkeys(natural, 1 / len(natural))
    return _bisect(lambda x: entropy(on_path(natural, even, x)) <= goal, 0.0, 1.0)


def exponent_for_repetition(natural: dict[str, float], target: dict[str, float], tokens: dict[str, int], repeats: dict[str, int], budget: float) -> float:
    """The greatest exponent at which no source exceeds its repetitions at ``budget`` tokens."""

    def holds(x: float) -> bool:
        return all(w * budget <= repeats[s] * tokens[s] * (1 + 1e-12) for s, w in on_path(natural, target, x).items())

    return _bisect(holds, 0.0, 1.0)


@dataclass(frozen=True)
class Share:
    mix_id: str
    source: str
    target_share: float
    max_repeats: int
    planned_share: float
    exponent: float
    budget: int
    passes: int
    rest: int


def plan_mix(mix_id: str, targets: dict[str, tuple[float, int]], tokens: dict[str, int], budget: int | None = None, target_entropy: float | None = None, epochs: float | None = None, as_even_as_targets: bool = False) -> list[Share]:
    """The plan of one mix; ``targets``: source -> (share, most repetitions), ``tokens``: source -> tokens there.

    ``budget`` is a number of tokens, ``epochs`` the same as a multiple of all tokens of the mix's sources; ``as_even_as_targets``
    takes the entropy of the target shares as the target entropy.
    """
    there = {s: t for s, (t, r) in targets.items() if t > 0 and r > 0 and tokens.get(s, 0) > 0}
    if epochs is not None:
        budget = int(epochs * sum(tokens[s] for s in there))
    weights: dict[str, float] = {}
    x, size = 1.0, 0.0
    if there:
        goal, natural = normalised(there), normalised({s: float(tokens[s]) for s in there})
        repeats = {s: targets[s][1] for s in there}
        if as_even_as_targets:
            target_entropy = entropy(goal)
        if target_entropy is not None:
            x = exponent_for_entropy(natural, target_entropy)
            goal = on_path(natural, dict.fromkeys(natural, 1 / len(natural)), x)
        elif budget is not None:
            x = exponent_for_repetition(natural, goal, tokens, repeats, budget)
            goal = on_path(natural, goal, x)
        weights = goal
        size = min(repeats[s] * tokens[s] / w for s, w in weights.items())
        size = size if budget is None else min(size, budget)
    out = []
    for s, (t, r) in sorted(targets.items()):
        b = min(int(weights.get(s, 0.0) * size + 0.5), r * tokens.get(s, 0)) if s in weights else 0
        passes, rest = divmod(b, tokens[s]) if s in weights else (0, 0)
        out.append(Share(mix_id, s, t, r, weights.get(s, 0.0), x, b, passes, rest))
    return out


def sized_documents(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, source, n_tokens of each usable document, once."""
    rows = docs.where("doc_id is not null and source is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text")
    return token_sizes(rows, ["doc_id", "source"], vocabulary).where("n_tokens > 0").groupBy("doc_id", "source").agg(F.max("n_tokens").alias("n_tokens"))


_PLAN = "mix_id string, source string, target_share double, max_repeats int, planned_share double, exponent double, budget long, passes long, rest long"


def plan_mixes(targets: DataFrame, sized: DataFrame, **how) -> DataFrame:
    """One row per mix and source; ``how`` goes to ``plan_mix``.

    Targets are settings: they are read to the driver, up to ``MOST_TARGETS`` of them (more are refused, not cut), with one
    total for each source they name.
    """
    spark = targets.sparkSession
    wanted = targets.where("mix_id is not null and source is not null and target_share > 0 and max_repeats > 0")
    wanted = wanted.groupBy("mix_id", "source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    rows = wanted.limit(MOST_TARGETS + 1).collect()
    if len(rows) > MOST_TARGETS:
        raise EngineError(f"more than {MOST_TARGETS} targets")
    named = spark.createDataFrame(sorted({(r["source"],) for r in rows}), "source string")
    totals = {r["source"]: r["tokens"] for r in sized.join(F.broadcast(named), "source").groupBy("source").agg(F.sum("n_tokens").alias("tokens")).collect()}
    mixes: dict[str, dict[str, tuple[float, int]]] = {}
    for r in rows:
        mixes.setdefault(r["mix_id"], {})[r["source"]] = (r["target_share"], r["max_repeats"])
    plans = [s.__dict__ for m, t in sorted(mixes.items()) for s in plan_mix(m, t, totals, **how)]
    return spark.createDataFrame([tuple(r.values()) for r in plans], _PLAN)


def draw(sized: DataFrame, plan: DataFrame, rows: int, seed: int = 0) -> DataFrame:
    """mix_id, source, doc_id, n_tokens, uses: the documents of each mix and how often each is used."""
    blocks = min(MOST_BLOCKS, max(1, rows // BLOCK_DOCS))
    docs = sized.withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(blocks)))
    wanted = plan.where("budget > 0").select("mix_id", "source", "passes", "rest")
    turn = lambda c: F.xxhash64(c, "mix_id", F.lit(seed + 1))
    sums = docs.groupBy("source", "block").agg(F.sum("n_tokens").alias("tokens"))
    order = Window.partitionBy("mix_id", "source").orderBy(turn("block"), "block")
    placed = sums.join(wanted, "source").withColumn("start", F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("tokens"))
    placed = placed.select("mix_id", "source", "block", "passes", "rest", "start", (F.col("start") + F.col("tokens") <= F.col("rest")).alias("whole"))
    drawn = docs.join(placed.where("passes > 0 or start < rest"), ["source", "block"])
    cut = drawn.where("not whole and start < rest")
    within = Window.partitionBy("mix_id", "source").orderBy(turn("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    # A document that crosses the end of the budget is used if more than half of it lies inside.
    until = F.col("start") + F.sum("n_tokens").over(within)
    from_cut = cut.withColumn("uses", F.col("passes") + (until - F.col("n_tokens") / 2 < F.col("rest")).cast("long"))
    from_rest = drawn.where("whole or start >= rest").withColumn("uses", F.col("passes") + F.col("whole").cast("long"))
    out = from_cut.unionByName(from_rest).where("uses > 0")
    return out.select("mix_id", "source", "doc_id", "n_tokens", "uses")


def mix_shares(drawn: DataFrame, plan: DataFrame) -> DataFrame:
    """mix_id, source, target_share, planned_share, actual_share, tokens, draws, most_uses, max_repeats, exponent.

    Every target has a row; an absent source has 0 tokens.
    """
    per = drawn.groupBy("mix_id", "source").agg(
        F.sum(F.col("n_tokens") * F.col("uses")).alias("tokens"), F.sum("uses").alias("draws"), F.max("uses").alias("most_uses")
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    rows = plan.join(per, ["mix_id", "source"], "left").select(
        "mix_id", "source", "target_share", "planned_share", "max_repeats", "exponent", zero("tokens"), zero("draws"), zero("most_uses")
    )
    total = F.sum("tokens").over(Window.partitionBy("mix_id"))
    return rows.withColumn("actual_share", F.when(total > 0, F.col("tokens") / total).otherwise(0.0))


def mix_faults(drawn: DataFrame, plan: DataFrame) -> DataFrame:
    """mix_id, sources, over_limit, off_plan: the sources asked for; documents used more often than allowed; sources whose drawn
    tokens miss their budget by more than half of their largest document. The last two must be 0."""
    per = drawn.groupBy("mix_id", "source").agg(F.sum(F.col("n_tokens") * F.col("uses")).alias("tokens"), F.max("uses").alias("most"), F.max("n_tokens").alias("largest"))
    rows = plan.join(per, ["mix_id", "source"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return rows.groupBy("mix_id").agg(
        F.count("*").alias("sources"), F.count_if(zero("most") > F.col("max_repeats")).alias("over_limit"),
        F.count_if(F.abs(zero("tokens") - F.col("budget")) * 2 > F.coalesce("largest", F.lit(2))).alias("off_plan"),
    )


def _mixed(spark, base: str, **how) -> tuple[DataFrame, DataFrame]:
    docs = read_table(spark, base, "documents")
    sized = checkpointed(sized_documents(docs))  # three numbers a document, read four times: tokenised once
    plan = plan_mixes(read_table(spark, base, "mix_targets"), sized, **how)
    return draw(sized, plan, docs.count()), plan


def p7_draws(spark, base: str) -> DataFrame:
    return _mixed(spark, base, epochs=EPOCHS)[0]


def p7_shares(spark, base: str) -> DataFrame:
    return mix_shares(*_mixed(spark, base, epochs=EPOCHS))


def p7_entropy_shares(spark, base: str) -> DataFrame:
    """Natural shares, tempered until they are as even as the targets, at the budget of ``p7_shares``."""
    return mix_shares(*_mixed(spark, base, epochs=EPOCHS, as_even_as_targets=True))


def p7_exact_shares(spark, base: str) -> DataFrame:
    """The exact target shares, as large as the repetition limit allows."""
    return mix_shares(*_mixed(spark, base))


def p7_faults(spark, base: str) -> DataFrame:
    return mix_faults(*_mixed(spark, base, epochs=EPOCHS))
