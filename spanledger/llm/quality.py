"""Quality classifier: a sparse rule ensemble compiled into one Spark expression.

Boosted shallow trees over text statistics are cut into their paths; each path
is a conjunctive rule. A logistic model with an L1 penalty keeps few of the
rules, and the model becomes a Column, so scoring is a projection without a
shuffle, a UDF or a join.

Fitting looks at a bounded sample of the labelled rows (``SAMPLE_ROWS``
expected, chosen by a hash of the id); statistics and scores cover whole
texts. Defined results: NULL text counts as empty and is scored; repeated
labels of an id count once, as their mean; without usable labels every score
is 0.5, with labels of one kind it is their smoothed share.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanledger.llm.columns import let

SAMPLE_ROWS = 20_000
THRESHOLD = 0.3
TREES, DEPTH, BINS, SHRINK = 40, 3, 48, 0.3
PENALTY, STEPS = 0.0005, 400
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÄÆÇÈÉÊËÍÎÏÑÓÔÖŒÙÚÛÜ"
NAMES = [
    "log_chars", "log_words", "word_chars", "distinct_words", "short_words", "long_words", "upper", "digits", "bars", "shouts",
    "marks", "stops", "lines", "distinct_lines", "repeats",
]


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def statistics(text: Column) -> Column:
    """The statistics of a whole text as an array, in the order of ``NAMES``."""

    def count(t: Column, chars: str) -> Column:
        return F.length(t) - F.length(F.translate(t, chars, ""))

    def over(s: Column) -> Column:
        t, words, lines = s["t"], s["words"], s["lines"]
        n, k = F.length(t), F.size(words)
        pairs = F.slice(words, 2, F.greatest(k - 1, F.lit(0)))
        again = F.size(F.filter(F.zip_with(words, pairs, lambda a, b: a == b), lambda x: F.coalesce(x, F.lit(False))))
        values = [
            F.log1p(n), F.log1p(k), _share(n, k), _share(F.size(F.array_distinct(words)), k),
            _share(F.size(F.filter(words, lambda w: F.length(w) <= 3)), k), _share(F.size(F.filter(words, lambda w: F.length(w) >= 14)), k),
            _share(count(t, UPPER), n), _share(count(t, "0123456789"), n), _share(count(t, "|"), k), _share(count(t, "!?"), k),
            _share(count(t, "#$%&*@^~=+<>{}[]\\/_"), k), _share(count(t, ".,;:"), k), _share(F.size(lines), k),
            _share(F.size(F.array_distinct(lines)), F.size(lines)), _share(again, k),
        ]
        return F.array(*[v.cast("double") for v in values])

    full = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(full, r"[ \t\r\n]+"), lambda w: w != "")
    parts = F.struct(full.alias("t"), words.alias("words"), F.split(full, "\n").alias("lines"))
    return let(parts, over)


@dataclass(frozen=True)
class Rule:
    """Conditions (statistic, bound, above) that must all hold, and their weight."""

    conditions: tuple[tuple[int, float, bool], ...]
    weight: float


@dataclass(frozen=True)
class RuleModel:
    bias: float
    rules: tuple[Rule, ...]

    def score(self, text: Column) -> Column:
        """Likelihood of label 1 as one expression over the text."""

        def total(x: Column) -> Column:
            out = F.lit(self.bias)
            for r in self.rules:
                holds = [x[i] > F.lit(b) if above else x[i] <= F.lit(b) for i, b, above in r.conditions]
                out = out + F.when(_all(holds), F.lit(r.weight)).otherwise(F.lit(0.0))
            return F.lit(1.0) / (F.lit(1.0) + F.exp(-out))

        return let(statistics(text), total)


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def _tree(bins: np.ndarray, residual: np.ndarray, depth: int) -> list[tuple[tuple[tuple[int, int, bool], ...], np.ndarray]]:
    """All nodes below the root of a regression tree: their conditions and rows."""
    nodes, frontier = [], [((), np.arange(len(residual)))]
    for _ in range(depth):
        following = []
        for path, rows in frontier:
            best = (1e-9, -1, -1)
            total, n = residual[rows].sum(), len(rows)
            for j in range(bins.shape[1]):
                b = bins[rows, j]
                s = np.bincount(b, residual[rows], BINS).cumsum()[:-1]
                c = np.bincount(b, minlength=BINS).cumsum()[:-1]
                ok = (c >= 10) & (n - c >= 10)
                if ok.any():
                    gain = np.where(ok, s**2 / np.maximum(c, 1) + (total - s) ** 2 / np.maximum(n - c, 1) - total**2 / n, 0)
                    k = int(gain.argmax())
                    best = max(best, (float(gain[k]), j, k))
            if best[1] >= 0:
                _, j, k = best
                low = bins[rows, j] <= k
                following += [((*path, (j, k, False)), rows[low]), ((*path, (j, k, True)), rows[~low])]
        nodes += following
        frontier = following
    return nodes


def _lasso(x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Accelerated proximal steps on the penalised logistic loss; the bias is free."""
    n, k = x.shape
    a = np.column_stack([np.ones(n), x])
    step = 4.0 * n / np.linalg.norm(a, 2) ** 2
    w = z = np.zeros(k + 1)
    momentum = 1.0
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(a @ z, -30, 30)))
        new = z - step * (a.T @ (p - y)) / n
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * PENALTY, 0)
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        z = new + (momentum - 1) / following * (new - w)
        w, momentum = new, following
    return float(w[0]), w[1:]


def fit_rules(x: np.ndarray, y: np.ndarray, seed: int = 7) -> RuleModel:
    """Fit on the statistics ``x`` of the sampled rows and their labels ``y``."""
    if len(y) == 0:
        return RuleModel(0.0, ())
    prior = (y.sum() + 1) / (len(y) + 2)
    if y.min() == y.max():
        return RuleModel(float(np.log(prior / (1 - prior))), ())
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    bins = np.column_stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)])
    random, logit = np.random.default_rng(seed), np.full(len(y), np.log(prior / (1 - prior)))
    paths: dict[tuple, None] = {}
    for _ in range(TREES):
        residual = y - 1 / (1 + np.exp(-logit))
        rows = np.sort(random.permutation(len(y))[: max(40, len(y) // 2)])
        nodes = _tree(bins[rows], residual[rows], DEPTH)
        for path, own in nodes:
            paths[path] = None
            if len(path) == DEPTH and len(own):
                p = y[rows][own] - residual[rows][own]
                value = residual[rows][own].sum() / max((p * (1 - p)).sum(), 1.0)
                logit = logit + SHRINK * value * _holds(bins, path)
    rules, seen, columns = [], set(), []
    for path in paths:
        holds = _holds(bins, path)
        if (key := holds.tobytes()) not in seen and 0 < holds.mean() < 1:
            seen.add(key)
            rules.append(path)
            columns.append(holds)
    if not rules:
        return RuleModel(float(np.log(prior / (1 - prior))), ())
    bias, weights = _lasso(np.column_stack(columns).astype(float), y)
    chosen = [Rule(tuple((j, float(cuts[j][k]), above) for j, k, above in p), float(w)) for p, w in zip(rules, weights, strict=True) if w]
    return RuleModel(bias, tuple(chosen))


def _holds(bins: np.ndarray, path: tuple) -> np.ndarray:
    out = np.ones(len(bins), bool)
    for j, k, above in path:
        out &= (bins[:, j] > k) == above
    return out


def fit(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> RuleModel:
    """Learn from the labelled rows that satisfy ``learn``, a condition on ``doc_id``.

    About ``sample_rows`` of them reach the driver, as statistics, not texts;
    the share of the id hashes that is read follows from a count of the labels.
    """
    marks = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & learn)
    marks = marks.groupBy("doc_id").agg(F.avg(F.col(label).cast("double")).alias("_y"))
    share = min(1.0, sample_rows / max(1, marks.count()))
    chosen = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    stats = docs.where(F.col("doc_id").isNotNull() & learn & chosen).select("doc_id", statistics(F.col("text")).alias("_x"))
    rows = stats.join(marks.where(chosen), "doc_id").toPandas()
    rows = rows.assign(_k=[tuple(v) for v in rows["_x"]]).sort_values(["doc_id", "_k"])
    x = np.array(rows["_x"].tolist(), float).reshape(len(rows), len(NAMES))
    return fit_rules(x, (rows["_y"].to_numpy(float) >= 0.5).astype(float))
