"""Quality score of texts by a sparse ensemble of rules, scored as plain column expressions.

1. Statistics of each whole text (shares of signs, repeated words, lengths and so on) are built-in
   functions of the text.
2. Small trees are boosted on a bounded sample of labelled rows; every path from a root to a node,
   a conjunction of comparisons of statistics, is a rule.
3. A logistic model with a lasso penalty gives most rules no weight; the penalty's strength is the
   one that does best on a fifth of the sample that is kept apart.
4. The rules left are compiled into one column expression, so scoring is a projection.

Only the sample, numbers for at most ``TRAIN_ROWS`` labels, goes through the driver, whatever
the size of the input; texts, ids, languages and sources are no inputs of a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAIN_ROWS = 20_000
TREES = 24
DEPTH = 3
BINS = 32
PENALTIES = (0.03, 0.01, 0.003, 0.001, 0.0003)


def statistics(text: Column) -> dict[str, Column]:
    """Numbers that describe a text; null counts as empty, shares of nothing are 0."""
    text = F.coalesce(text, F.lit(""))
    n = F.length(text).cast("double")
    words = F.filter(F.split(text, r"[ \t\n\r]+"), lambda w: w != "")
    n_words = F.size(words).cast("double")

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))

    def signs(pattern: str) -> Column:
        return n - F.length(F.regexp_replace(text, pattern, ""))

    repeats = F.size(F.filter(F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: a == b), lambda same: same))
    lines = F.split(text, "\n")
    return {
        "log_chars": F.log1p(n),
        "log_words": F.log1p(n_words),
        "word_length": share(n, n_words),
        "sign_share": share(signs(r"[^\p{L}\p{N}\s]"), n),
        "odd_sign_share": share(signs(r"[#$%&*@^~<>{}\[\]\\_=+]"), n),
        "bar_share": share(signs(r"\|"), n),
        "stop_share": share(signs(r"[.!?]"), n_words),
        "comma_share": share(signs(","), n_words),
        "digit_share": share(signs("[0-9]"), n),
        "capital_share": share(signs(r"\p{Lu}"), n),
        "distinct_share": share(F.size(F.array_distinct(words)).cast("double"), n_words),
        "repeat_share": share(repeats.cast("double"), n_words),
        "line_length": share(n, F.size(lines).cast("double")),
        "distinct_lines": share(F.size(F.array_distinct(lines)).cast("double"), F.size(lines).cast("double")),
    }


STATISTICS = (
    "log_chars", "log_words", "word_length", "sign_share", "odd_sign_share", "bar_share", "stop_share", "comma_share",
    "digit_share", "capital_share", "distinct_share", "repeat_share", "line_length", "distinct_lines",
)

# A rule: (statistic, whether above, threshold), ...
Rule = tuple[tuple[int, bool, float], ...]


def _fires(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for feature, above, threshold in rule:
        out &= (x[:, feature] > threshold) == above
    return out


def _grow(x: np.ndarray, residual: np.ndarray, rows: np.ndarray, cuts: list[np.ndarray], path: Rule, depth: int, rules: list[Rule], out: np.ndarray) -> None:
    """One regression tree on the residual; adds the path of each node to ``rules`` and leaf means to ``out``."""
    best = None
    if depth and len(rows) >= 40:
        total, n = residual[rows].sum(), len(rows)
        for feature, thresholds in enumerate(cuts):
            if not len(thresholds):
                continue
            place = np.searchsorted(thresholds, x[rows, feature], "left")
            counts = np.bincount(place, minlength=len(thresholds) + 1)[:-1].cumsum()
            sums = np.bincount(place, residual[rows], minlength=len(thresholds) + 1)[:-1].cumsum()
            ok = (counts >= 15) & (n - counts >= 15)
            if ok.any():
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(ok, sums**2 / counts + (total - sums) ** 2 / (n - counts), -np.inf)
                k = int(gain.argmax())
                if best is None or gain[k] > best[0] + 1e-12:
                    best = (gain[k], feature, float(thresholds[k]))
        if best is not None and best[0] <= total * total / n + 1e-9:
            best = None
    if best is None:
        out[rows] = residual[rows].mean()
        return
    _, feature, threshold = best
    above = x[rows, feature] > threshold
    for side in (False, True):
        step = (*path, (feature, side, threshold))
        rules.append(step)
        _grow(x, residual, rows[above == side], cuts, step, depth - 1, rules, out)


def candidate_rules(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 9) -> list[Rule]:
    """Distinct rules from trees boosted on random halves of the rows."""
    cuts = [np.unique(np.quantile(x[:, f], np.arange(1, BINS) / BINS)) for f in range(x.shape[1])]
    random, rules = np.random.default_rng(seed), []
    score = np.full(len(y), np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    for _ in range(trees):
        rows = np.flatnonzero(random.random(len(y)) < 0.5)
        if len(rows) < 40:
            rows = np.arange(len(y))
        residual, step = y - 1 / (1 + np.exp(-score)), np.zeros(len(y))
        grown: list[Rule] = []
        _grow(x, residual, rows, cuts, (), depth, grown, step)
        # The tree holds for all rows, not only those it was grown on.
        leaves = [r for r in grown if not any(r == s[: len(r)] and len(s) > len(r) for s in grown)]
        for leaf in leaves:
            fires = _fires(leaf, x)
            own = fires.nonzero()[0]
            if len(own):
                score[own] += 2.0 * residual[own].mean()
        rules += grown
    return list(dict.fromkeys(rules))


def lasso_logistic(a: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and intercept of least logistic loss plus penalty times the sum of absolute weights (accelerated proximal steps)."""
    n, m = a.shape
    weights, intercept = np.zeros(m), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    v, b, t = weights.copy(), intercept, 1.0
    size = 4.0 / (np.linalg.norm(a, 2) ** 2 / n + 1.0) if m else 1.0
    for _ in range(steps):
        error = 1 / (1 + np.exp(-np.clip(a @ v + b, -40, 40))) - y
        moved = v - size * (a.T @ error) / n
        new = np.sign(moved) * np.maximum(np.abs(moved) - size * penalty, 0)
        new_b = b - size * error.mean()
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, b = new + (t - 1) / t_next * (new - weights), new_b + (t - 1) / t_next * (new_b - intercept)
        weights, intercept, t = new, new_b, t_next
    return weights, float(intercept)


def _loss(a: np.ndarray, y: np.ndarray, weights: np.ndarray, intercept: float) -> float:
    score = np.clip(a @ weights + intercept, -40, 40)
    return float((np.log1p(np.exp(-score)) + (1 - y) * score).mean())


@dataclass(frozen=True)
class RuleModel:
    """Weighted rules over named statistics; without rules every text has the intercept's score."""

    names: tuple[str, ...]
    rules: tuple[tuple[Rule, float], ...]
    intercept: float

    def score(self, prefix: str = "") -> Column:
        """Probability of label 1 as an expression over columns named like the statistics."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            fires = None
            for feature, above, threshold in rule:
                name = F.col(prefix + self.names[feature])
                one = name > threshold if above else name <= threshold
                fires = one if fires is None else fires & one
            total = total + F.when(fires, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))

    def describe(self) -> list[str]:
        def one(feature: int, above: bool, threshold: float) -> str:
            return f"{self.names[feature]} {'>' if above else '<='} {threshold:.4g}"

        return [f"{weight:+.3f} if {' and '.join(one(*c) for c in rule)}" for rule, weight in self.rules]


def fit_rules(x: np.ndarray, y: np.ndarray, names: tuple[str, ...] = STATISTICS) -> RuleModel:
    """Model from statistics and labels 0 or 1. Fewer than 100 rows or one label alone give a constant score."""
    if len(y) < 100 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
        return RuleModel(names, (), float(np.log(share / (1 - share))))
    rules = candidate_rules(x, y)
    a = np.stack([_fires(rule, x) for rule in rules], axis=1).astype(np.float64)
    apart = np.arange(len(y)) % 5 == 0
    fits = [(_loss(a[apart], y[apart], *lasso_logistic(a[~apart], y[~apart], p)), p) for p in PENALTIES]
    weights, intercept = lasso_logistic(a, y, min(fits)[1])
    kept = [(rule, float(w)) for rule, w in zip(rules, weights, strict=True) if abs(w) > 1e-6]
    return RuleModel(names, tuple(kept), intercept)


def is_held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned from: the id's checksum leaves remainder 1 by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of documents for at most ``most`` labels outside the held-out ones, the same at every run.

    Labels other than 0 and 1 and rows with a null id are left out; of more labels those with the
    smallest hash of the id are taken. They are broadcast, being bounded, so no text is shuffled.
    """
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
    known = known.select(F.col("doc_id").alias("label_id"), F.col("quality").cast("double").alias("y"))
    known = known.orderBy(F.xxhash64("label_id"), "label_id", "y").limit(most)
    texts = docs.select("doc_id", "text")
    rows = texts.join(F.broadcast(known), texts.doc_id == F.col("label_id"))
    sample = rows.select("label_id", "y", *[c.alias(name) for name, c in statistics(F.col("text")).items()]).toPandas()
    sample = sample.sort_values(["label_id", "y", *STATISTICS])[["y", *STATISTICS]].to_numpy(np.float64)
    return sample[:, 1:], sample[:, 0]


def scored(docs: DataFrame, model: RuleModel) -> DataFrame:
    """All columns of ``docs`` but those named score and predicted, then score and predicted (1 from 0.5 on).

    Null and empty texts are scored like any other, by statistics that are all 0.
    """
    names = [c for c in docs.columns if c not in ("score", "predicted")]
    numbers = {f"__{name}": c for name, c in statistics(F.col("text")).items()}
    rows = docs.select(*[F.col(f"`{c}`") for c in names]).withColumns(numbers)
    # A filter on the result stops at the generator; else it would compute the statistics anew for every rule.
    rows = rows.select(*[F.col(f"`{c}`") for c in names], F.inline(F.array(F.struct(model.score("__").alias("score")))))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> RuleModel:
    return fit_rules(*training_sample(docs, labels, most))
