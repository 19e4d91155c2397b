"""Quality classifier (operator 5): a sparse ensemble of rules over text statistics.

Shallow trees are grown on the statistics of a bounded sample of labelled documents. Every path from a root to
a node is a rule, a conjunction of comparisons. A logistic regression with a lasso penalty gives most rules
no weight, and those that keep one become a column expression: scoring is a projection over the scan.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfold.llm.common import WHITESPACE
from keyfold.operators.messages import bind

# Labelled documents the model is fitted on, at most about this many; statistics and scores cover all.
MAX_LABELLED = 20_000
THRESHOLD = 0.3
HELD_OUT_OF = 5
TREES = 40
DEPTH = 3
BINS = 32
PENALTY = 2e-3
ROUNDS = 400

Rule = tuple[tuple[str, bool, float], ...]  # statistic, whether it lies above, threshold


def statistics() -> dict[str, Column]:
    """Shares and means of the text ``_text`` with its ``_words`` and ``_lines``; none depends on a document's
    source, language or id, and all are 0 for an empty text."""
    chars = F.char_length("_text")

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))

    def kept(pattern: str) -> Column:
        """Characters that are left without those of ``pattern``."""
        return F.char_length(F.regexp_replace("_text", pattern, ""))

    def signs(some: str) -> Column:
        return chars - F.char_length(F.translate("_text", some, ""))

    words, lines = F.size("_words"), F.size("_lines")
    repeats = F.size(F.filter("_words", lambda w, i: (i > 0) & (w == F.get("_words", i - 1))))
    visible = chars - signs(WHITESPACE)
    return {
        "log_words": F.log1p(words.cast("double")),
        "word_length": share(visible, words),
        "distinct_words": share(F.size(F.array_distinct("_words")), words),
        "repeated_words": share(repeats, words),
        "letters": share(kept(r"\P{L}+"), chars),
        "capitals": share(kept(r"\P{Lu}+"), chars),
        "digits": share(signs("0123456789"), chars),
        "stops": share(signs(".,;:"), words),
        "bars": share(signs("|"), chars),
        "shouts": share(signs("!?"), chars),
        "symbols": share(signs("#$%&*+<=>@\\^_`~{}[]/"), chars),
        "distinct_lines": share(F.size(F.array_distinct("_lines")), lines),
        "line_words": share(words, lines),
    }


STATISTICS = (
    "log_words word_length distinct_words repeated_words letters capitals digits stops bars shouts symbols "
    "distinct_lines line_words"
).split()


def with_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id``, the row as ``kept`` and the statistics of its text; null counts as empty."""
    whole = docs.select("doc_id", F.struct(*docs.columns).alias("kept"), F.coalesce("text", F.lit("")).alias("_text"))
    split = whole.withColumns(
        {
            "_words": F.array_remove(F.split("_text", r"[\x20\x09-\x0D]+"), ""),
            "_lines": F.array_remove(F.split("_text", "\n"), ""),
        }
    )
    return split.select("doc_id", "kept", *(c.alias(name) for name, c in statistics().items()))


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is kept from learning; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % HELD_OUT_OF == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of about ``most`` labelled documents, chosen by a hash of the id. The one
    thing that is broadcast and brought to the driver is bounded by ``most``."""
    usable = labels.select(F.col("doc_id").alias("labelled"), F.col("quality").cast("int").alias("quality")).filter(
        F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))
    )
    count = usable.count()
    share = min(1.0, most / max(count, 1))
    # fine enough for any number of labels
    chosen = usable.filter(F.xxhash64("labelled").bitwiseAND(2**62 - 1) < int(share * 2**62))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
    found = with_statistics(rows).select(*STATISTICS, "kept.quality").toPandas()
    return found[STATISTICS].to_numpy(dtype=float), found["quality"].to_numpy(dtype=int)


@dataclass(frozen=True)
class RuleEnsemble:
    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def column(self) -> Column:
        """The score as an expression over the columns of :data:`STATISTICS`."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            conditions = [F.col(name) > at if above else F.col(name) <= at for name, above, at in rule]
            together = conditions[0]
            for condition in conditions[1:]:
                together = together & condition
            total = total + F.when(together, F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for rule, weight in self.rules:
            total += weight * _holds(rule, x)
        return 1.0 / (1.0 + np.exp(-total))


def _holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for name, above, at in rule:
        column = x[:, STATISTICS.index(name)]
        out &= column > at if above else column <= at
    return out


def fit(x: np.ndarray, y: np.ndarray, seed: int = 11) -> RuleEnsemble:
    """Fits rules and weights. Without rows of both classes, or too few to split, the score is the share
    of ones, 0.5 without any."""
    order = np.lexsort((*x.T, y))  # the same model whatever the order in which rows arrive
    x, y = x[order], y[order]
    base = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    prior = float(np.log(base / (1 - base)))
    if len(set(y.tolist())) < 2:
        return RuleEnsemble(prior, ())
    rules = _tree_rules(x, y, np.random.default_rng(seed))
    if not rules:
        return RuleEnsemble(prior, ())
    holds = np.array([_holds(r, x) for r in rules])
    _, first = np.unique(np.packbits(holds, axis=1), axis=0, return_index=True)
    used = [i for i in sorted(first) if 0 < holds[i].sum() < len(y)]
    weights, intercept = _lasso(holds[used].T.astype(float), y, prior)
    return RuleEnsemble(intercept, tuple((rules[i], float(w)) for i, w in zip(used, weights) if w))


def _tree_rules(x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> list[Rule]:
    """The paths of trees grown on half of the rows each, looking at half of the statistics a split."""
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(c, column, side="left") for c, column in zip(cuts, x.T)], axis=1)
    found: dict[Rule, None] = {}

    def grow(rows: np.ndarray, path: Rule, depth: int) -> None:
        if path:
            found[path] = None
        ones = int(y[rows].sum())
        if depth == 0 or len(rows) < 20 or ones in (0, len(rows)):
            return
        best = (0.0, 0, 0)
        for at in rng.choice(x.shape[1], max(1, x.shape[1] // 2), replace=False):
            if not len(cuts[at]):
                continue
            bins = binned[rows, at]
            n = np.cumsum(np.bincount(bins, minlength=len(cuts[at]) + 1))[:-1].astype(float)
            p = np.cumsum(np.bincount(bins, weights=y[rows], minlength=len(cuts[at]) + 1))[:-1]
            m = len(rows) - n
            with np.errstate(divide="ignore", invalid="ignore"):
                # what the split takes off the Gini impurity, times the number of rows
                gain = p * p / n + (ones - p) ** 2 / m - ones * ones / len(rows)
            gain[(n < 5) | (m < 5)] = 0.0
            if gain.max() > best[0] + 1e-9:
                best = (float(gain.max()), int(at), int(gain.argmax()))
        if not best[0]:
            return
        _, at, cut = best
        below = binned[rows, at] <= cut
        for above, some in ((False, rows[below]), (True, rows[~below])):
            grow(some, (*path, (STATISTICS[at], above, float(cuts[at][cut]))), depth - 1)

    for _ in range(TREES):
        grow(np.flatnonzero(rng.random(len(y)) < 0.5), (), DEPTH)
    return list(found)


def _lasso(x: np.ndarray, y: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Logistic regression with an L1 penalty by accelerated proximal steps; the intercept is free."""
    if not x.shape[1]:
        return np.zeros(0), prior
    mean = x.mean(axis=0)
    scale = np.sqrt(np.maximum(mean * (1 - mean), 1e-4))
    z = (x - mean) / scale
    step = 4.0 / (np.linalg.norm(z.T @ z / len(y), 2) + 1.0)
    w = v = np.zeros(x.shape[1])
    b = c = prior
    t = 1.0
    for _ in range(ROUNDS):
        error = 1.0 / (1.0 + np.exp(-(z @ v + c))) - y
        moved = v - step * (z.T @ error) / len(y)
        w_next = np.sign(moved) * np.maximum(np.abs(moved) - step * PENALTY, 0.0)
        b_next = c - step * error.mean()
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v = w_next + (t - 1) / t_next * (w_next - w)
        c = b_next + (t - 1) / t_next * (b_next - b)
        w, b, t = w_next, b_next, t_next
    return w / scale, float(b - (mean / scale) @ w)


def scored(docs: DataFrame, model: RuleEnsemble, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, the row as ``kept``, ``held_out``, ``score`` and ``predicted`` of every document.

    A null text is scored as the empty text; a null ``doc_id`` stays null and counts as held out; repeated rows
    score alike; other columns stay inside ``kept``; an empty table gives no rows.
    """
    # bound, or a filter on the score would be pushed below it with a copy of every rule and statistic
    rated = bind(with_statistics(docs), score=model.column())
    return rated.select(
        "doc_id",
        "kept",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not reject, all columns as they are."""
    model = fit(*labelled_sample(docs, labels))
    return scored(docs, model).filter("predicted = 1").select("kept.*")
