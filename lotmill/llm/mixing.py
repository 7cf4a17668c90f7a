"""Mixing to target weights with soft domain membership, with DataFrame functions only.

A classifier is fitted on the labelled table (Gaussian naive Bayes on shape and word-list features); it gives every
document posterior probabilities p over the domains. Rates r >= 0 per document are then fitted by projected
gradient steps so that the expected token totals ``sum r_i * t_i * p_i`` meet the targets:

    r_i <- max(0, r_i - p_i . h),   h = H^-1 (totals - targets),   H = sum t_i p_i p_i'

This is gradient descent with unit step on the residual's squared H^-1 norm, in the metric that weighs documents by
their tokens. All documents go through the same history of h vectors, so a rate is an expression of the posterior
and that history: each step is one aggregation to a handful of numbers, and no state per document is kept.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotmill.llm.common import written
from lotmill.llm.decontaminate import words

LEXICON_SAMPLE = 4_000  # labelled texts from which the word lists are learned
LEXICON_WORDS = 64
STEPS = 40
TOLERANCE = 1e-6

DOMAINS = {"good": "toxic = 0 AND quality = 1", "junk": "toxic = 0 AND quality = 0", "toxic": "toxic = 1"}
TARGETS = {"good": 0.80, "junk": 0.15, "toxic": 0.05}
FEATURES = ("letters", "variety", "listed", "length")


def word_list(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> list[str]:
    """Up to LEXICON_WORDS words that mark the toxic domain, by document frequency in a bounded labelled sample."""
    chosen = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    half = LEXICON_SAMPLE // 2
    ranked = [chosen.where(f"toxic = {c}").orderBy(F.xxhash64("doc_id"), "doc_id").limit(half) for c in (0, 1)]
    sample = F.broadcast(ranked[0].unionByName(ranked[1]).select(F.col("doc_id").alias("_id"), F.col("toxic").alias("_toxic")))
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))  # no clash with columns of docs
    rows = texts.join(sample, F.col("doc") == F.col("_id")).select(F.col("_toxic").alias("toxic"), F.array_distinct(words(F.col("text"))).alias("w"))
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return []
    counts = rows.select("toxic", F.explode("w").alias("word")).groupBy("word").agg(
        F.count_if(F.col("toxic") == 1).alias("a"), F.count_if(F.col("toxic") == 0).alias("b"))
    odds = F.log((F.col("a") + 0.5) / (sizes[1] + 1.0)) - F.log((F.col("b") + 0.5) / (sizes[0] + 1.0))
    least = max(3, sizes[1] // 100)
    best = counts.where(f"a >= {least}").withColumn("odds", odds).where(f"odds > {math.log(8)}").orderBy(F.desc("odds"), "word").limit(LEXICON_WORDS)
    return sorted(r["word"] for r in best.collect())


def _features(docs: DataFrame, text_col: str, listed: list[str]) -> DataFrame:
    """``docs`` as struct ``row`` with token count and features of the whole text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    held = docs.select(F.struct("*").alias("row"), F.length(text).alias("chars"), words(text).alias("w"))
    n = F.size("w")
    hits = F.size(F.array_intersect("w", F.array(*[F.lit(x) for x in listed]))) if listed else F.lit(0)
    return held.select(
        "row", n.cast("long").alias("tokens"),
        F.coalesce(F.try_divide(F.length(F.array_join("w", "")) + n, F.col("chars") + 1.0), F.lit(0.0)).alias("letters"),
        F.coalesce(F.try_divide(F.log1p(F.size(F.array_distinct("w")).cast("double")), F.log1p(n.cast("double"))), F.lit(0.0)).alias("variety"),
        F.log1p(hits.cast("double")).alias("listed"), F.log1p(n.cast("double")).alias("length"))


def _posteriors(stats: list, names: list[str]):
    """Posterior of each domain as expressions over the features; uniform where nothing was learned."""
    known = {r["domain"]: r for r in stats}
    total = sum(r["n"] for r in stats)
    logs = {}
    for d in names:
        r = known.get(d)
        if r is None:
            logs[d] = F.lit(-1e6) if known else F.lit(0.0)
            continue
        log = F.lit(math.log(r["n"] / total))
        for f in FEATURES:
            var = max(r[f"v_{f}"] or 0.0, 0.0) + 2e-3
            log = log - (F.col(f) - r[f"m_{f}"]) * (F.col(f) - r[f"m_{f}"]) / (2 * var) - 0.5 * math.log(var)
        logs[d] = log
    return logs


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, total_tokens: float | None = None, id_col: str = "doc_id",
        text_col: str = "text", keep: list[str] | None = None, seed: int = 11) -> DataFrame:
    """``docs`` (columns ``keep``, default all) with mix_tokens, mix_p_<domain>, mix_rate and mix_copies.

    ``targets`` are weights per domain (made to sum to 1) of ``total_tokens`` (default: the tokens present). A
    target that no document can serve stays unmet; the fit is then the least-squares one. Empty and null texts
    have no tokens; they get a rate by their features like any other. ``mix_copies`` rounds the rate up or down
    by a hash of the id, so that its expectation is the rate; repeated rows get equal values. Rows with a null id
    take part. Existing columns of these names are replaced. Labels: null or conflicting ones are left out.
    """
    targets = dict(TARGETS if targets is None else targets)
    names = list(DOMAINS)
    made = {"mix_tokens", "mix_rate", "mix_copies", *(f"mix_p_{d}" for d in names)}
    keep = [c for c in (keep or docs.columns) if c not in made]
    own = docs.select(*dict.fromkeys([*keep, id_col, text_col]))
    listed = word_list(own, labels, id_col, text_col)
    table = _features(own, text_col, listed).select(*[F.col("row").getField(c).alias(f"row_{c}") for c in dict.fromkeys([*keep, id_col])], "tokens", *FEATURES)
    table = written(table, "features")

    domain = F.coalesce(*[F.when(F.expr(rule), F.lit(d)) for d, rule in DOMAINS.items()])
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(
        F.min(domain).alias("domain"), F.max(domain).alias("other")).where("domain = other").drop("other")
    fit = table.join(known, F.col(f"row_{id_col}") == F.col("_id")).groupBy("domain").agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(f).alias(f"m_{f}") for f in FEATURES], *[F.var_pop(f).alias(f"v_{f}") for f in FEATURES])
    logs = _posteriors(fit.collect(), names)
    top = F.greatest(*[F.col(f"l_{d}") for d in names])
    table = table.select("*", *[logs[d].alias(f"l_{d}") for d in names])
    table = table.select("*", *[F.exp(F.col(f"l_{d}") - top).alias(f"e_{d}") for d in names])
    norm = sum((F.col(f"e_{d}") for d in names), F.lit(0.0))
    rows = [F.col(c) for c in table.columns if c.startswith("row_")]
    table = table.select(*rows, "tokens", *[(F.col(f"e_{d}") / norm).alias(f"p_{d}") for d in names])

    p = [f"p_{d}" for d in names]
    slim = written(table.groupBy("tokens", *p).agg(F.count(F.lit(1)).alias("times")), "posteriors")  # equal rows step together
    history: list[list[float]] = []
    gram = slim.agg(F.sum(F.col("tokens") * F.col("times")), *[F.sum(F.col("tokens") * F.col("times") * F.col(a) * F.col(b)) for a in p for b in p]).first()
    present = float(gram[0] or 0)
    want = total_tokens if total_tokens is not None else present
    share = sum(targets.get(d, 0.0) for d in names) or 1.0
    goal = [want * targets.get(d, 0.0) / share for d in names]
    k = len(names)
    matrix = [[float(gram[1 + i * k + j] or 0.0) for j in range(k)] for i in range(k)]
    for _ in range(STEPS if present else 0):
        totals = slim.agg(*[F.sum(_rate(history, p) * F.col("tokens") * F.col("times") * F.col(x)) for x in p]).first()
        gap = [float(t) - g for t, g in zip(totals, goal, strict=True)]
        if max(map(abs, gap)) <= TOLERANCE * max(want, 1.0):
            break
        step = _solve(matrix, gap)
        history.append(step)
        if len(history) > 1 and max(map(abs, step)) <= 1e-9:
            break
    table = table.select("*", _rate(history, p).alias("rate"))
    uniform = F.pmod(F.xxhash64(f"row_{id_col}", F.lit(seed)), F.lit(1 << 53)) / float(1 << 53)
    return table.select(*[F.col(f"row_{c}").alias(c) for c in keep], F.col("tokens").alias("mix_tokens"), *[F.col(f"p_{d}").alias(f"mix_p_{d}") for d in names],
                        F.col("rate").alias("mix_rate"), F.floor(F.col("rate") + uniform).cast("int").alias("mix_copies"))


def _rate(history: list[list[float]], p: list[str]):
    """The rate after all steps so far, starting from 1."""
    if not history:
        return F.lit(1.0)
    steps = ", ".join("array(" + ", ".join(f"{x!r}D" for x in h) + ")" for h in history)
    dot = " + ".join(f"{name} * h[{i}]" for i, name in enumerate(p))
    return F.expr(f"aggregate(array({steps}), 1.0D, (r, h) -> greatest(0.0D, r - ({dot})))")


def _solve(matrix: list[list[float]], right: list[float]) -> list[float]:
    """Solution of a system of one equation per domain, slightly damped so that an absent domain does no harm."""
    n = len(right)
    damp = 1e-12 * max(matrix[i][i] for i in range(n)) + 1e-12
    a = [[matrix[i][j] + (damp if i == j else 0.0) for j in range(n)] + [right[i]] for i in range(n)]
    for i in range(n):
        pivot = max(range(i, n), key=lambda r: abs(a[r][i]))
        a[i], a[pivot] = a[pivot], a[i]
        for r in range(n):
            if r != i:
                f = a[r][i] / a[i][i]
                a[r] = [x - f * y for x, y in zip(a[r], a[i], strict=True)]
    return [a[i][n] / a[i][i] for i in range(n)]
