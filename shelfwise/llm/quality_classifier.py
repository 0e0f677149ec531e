"""Quality by positive-unlabelled learning with the non-negative risk.

Positives are trusted labels; the unlabelled are a sample of all documents whose
labels may be learnt from, labelled or not; negative labels are never used. A
small network is fitted to minimise

    prior * R_p(+)  +  max(0, R_u(-) - prior * R_p(-))

with the sigmoid loss; where the second term would fall below zero, the step goes
up its gradient instead, so the fit can't profit from memorising positives. The
class prior is estimated first: a logistic model of positive against unlabelled
ranks both, and the prior is the smallest ratio of the unlabelled's to the
positives' share above any rank that a tenth of the positives reaches.

Features are shares of bytes, words and lines, none of them labels, language,
source or identifier. Scores are mapped to [0, 1] so that 0.5 is the fit's border.

The fit uses at most SAMPLE_ROWS documents of each kind and SAMPLE_BYTES of
text; scoring covers whole texts of all rows.

Edge cases: null and empty texts have all features at zero and get a score;
without positives or without documents every score is 0; repeated rows get equal
scores; extra columns are kept unless a result column has the name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .samples import sampled
from .shared import Sent
from .textops import NON_SPACE, U, Powers, byte_table, slices, span_hashes, window_hashes, word_spans

SAMPLE_ROWS = 20_000
SAMPLE_BYTES = 64 << 20
THRESHOLD = 0.5
SEED = 23
HIDDEN = 16
UPPER, LOWERCASE = byte_table(range(0x41, 0x5B)), byte_table([*range(0x61, 0x7B), *range(0x80, 0x100)])
DIGIT, SYMBOL = byte_table(range(0x30, 0x3A)), byte_table(b"#*$%&|<>{}[]\\^~_=+@")
STOP, LOUD = byte_table(b".,;:'\"()-"), byte_table(b"!?")
NAMES = ["upper", "digit", "symbol", "stop", "loud", "space", "symbol_words", "upper_words", "mean_word", "long_words", "distinct_words", "repeated_fours", "repeated_lines", "mean_line", "words", "lines"]


def features(column: pa.Array) -> np.ndarray:
    """(rows, len(NAMES)) between 0 and about 1."""
    out, powers = np.zeros((len(column), len(NAMES))), Powers()
    for first, raw, offsets in slices(column):
        n = len(offsets) - 1
        size = np.maximum(np.diff(offsets), 1).astype(float)
        row_of = lambda places: np.searchsorted(offsets, places, "right") - 1
        share = lambda table: np.bincount(row_of(np.flatnonzero(table[raw])), minlength=n) / size
        starts, ends, rows = word_spans(raw, offsets, NON_SPACE)
        words = np.bincount(rows, minlength=n).astype(float)
        some = np.maximum(words, 1)
        hashes = span_hashes(raw, starts, ends, powers)
        totals = {}
        for name, table in (("upper", UPPER), ("lower", LOWERCASE), ("symbol", SYMBOL)):
            sums = np.concatenate([[0], np.cumsum(table[raw])])
            totals[name] = sums[ends] - sums[starts]
        length = ends - starts
        upper_word = (totals["upper"] > 1) & (totals["lower"] == 0)

        def repeats(keys: np.ndarray, own: np.ndarray) -> np.ndarray:
            """Of each row, the share of keys equal to an earlier one."""
            order = np.lexsort((keys, own))
            again = np.zeros(len(keys), bool)
            again[1:] = (keys[order][1:] == keys[order][:-1]) & (own[order][1:] == own[order][:-1])
            return np.bincount(own[order], again, n) / np.maximum(np.bincount(own, minlength=n), 1)

        fours = window_hashes(hashes, 4)
        inside = rows[: len(fours)] == rows[3:] if len(fours) else np.zeros(0, bool)
        line_table = byte_table(set(range(256)) - {0x0A})
        line_starts, line_ends, line_rows = word_spans(raw, offsets, line_table)
        lines = np.bincount(line_rows, minlength=n).astype(float)
        out[first : first + n] = np.column_stack([
            share(UPPER), share(DIGIT), share(SYMBOL), share(STOP), share(LOUD), 1 - np.bincount(rows, length, n) / size,
            np.bincount(rows, totals["symbol"] > 0, n) / some, np.bincount(rows, upper_word, n) / some, np.bincount(rows, length, n) / some / 20, np.bincount(rows, length > 20, n) / some,
            1 - repeats(hashes, rows), repeats(fours[inside], rows[: len(fours)][inside]), repeats(span_hashes(raw, line_starts, line_ends, powers), line_rows), np.log1p(size / np.maximum(lines, 1)) / 10, np.log1p(words) / 10, np.log1p(lines) / 10,
        ])
    return out


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 40, ridge: float = 1e-3) -> np.ndarray:
    """Scores of a class-balanced ridge logistic regression on its own rows."""
    x = np.column_stack([x, np.ones(len(x))])
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9)) / len(y)
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(len(w))
        w -= np.linalg.solve(curve, x.T @ (weight * (p - y)) + ridge * w)
    return x @ w


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Smallest share ratio above any rank that a tenth of the positives reaches."""
    cuts = np.quantile(positive, np.linspace(0.0, 0.9, 91))
    up = np.array([(positive >= c).mean() for c in cuts])
    uu = np.array([(unlabelled >= c).mean() for c in cuts])
    return float(np.clip((uu / np.maximum(up, 1e-9)).min(), 0.05, 0.99))


class Classifier:
    """One hidden layer; fitted by Adam on the non-negative risk."""

    def __init__(self, positive: np.ndarray, unlabelled: np.ndarray, epochs: int = 60, batch: int = 512, rate: float = 0.01):
        both = np.concatenate([positive, unlabelled])
        self.mean, self.scale = unlabelled.mean(0), np.maximum(unlabelled.std(0), 1e-3)
        p, u = self.scaled(positive), self.scaled(unlabelled)
        ranked = logistic(np.concatenate([p, u]), np.repeat([1.0, 0.0], [len(p), len(u)]))
        self.prior = class_prior(ranked[: len(p)], ranked[len(p) :])
        rng = np.random.default_rng(SEED)
        self.w = [rng.normal(0, 1 / np.sqrt(both.shape[1]), (both.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
        first, second, t = [np.zeros_like(x) for x in self.w], [np.zeros_like(x) for x in self.w], 0
        rounds = max(1, min(len(u), 20_000) // batch)
        for epoch in range(epochs):
            step = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs)) + 1e-4
            for _ in range(rounds):
                own_p, own_u = p[rng.integers(0, len(p), batch)], u[rng.integers(0, len(u), batch)]
                grads = self.gradient(own_p, own_u)
                t += 1
                for k, g in enumerate(grads):
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.w[k] -= step * (first[k] / (1 - 0.9**t) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8) + 1e-4 * self.w[k])

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.tanh(x @ self.w[0] + self.w[1])
        return hidden, hidden @ self.w[2] + self.w[3][0]

    def gradient(self, p: np.ndarray, u: np.ndarray) -> list[np.ndarray]:
        x = np.concatenate([p, u])
        hidden, out = self.forward(x)
        loss = 1 / (1 + np.exp(np.clip(out, -30, 30)))  # of calling a row negative when it is positive
        slope = loss * (1 - loss)
        n_p, n_u = len(p), len(u)
        negative_risk = (1 - loss[n_p:]).mean() - self.prior * (1 - loss[:n_p]).mean()
        d = np.zeros(len(x))
        if negative_risk >= 0:
            d[:n_p] = -self.prior * slope[:n_p] / n_p - self.prior * slope[:n_p] / n_p
            d[n_p:] = slope[n_p:] / n_u
        else:
            d[:n_p] = self.prior * slope[:n_p] / n_p
            d[n_p:] = -slope[n_p:] / n_u
        back = d[:, None] * self.w[2] * (1 - hidden**2)
        return [x.T @ back, back.sum(0), hidden.T @ d, np.array([d.sum()])]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.forward(self.scaled(x))[1], -30, 30)))


def fit(docs: DataFrame, positives: DataFrame, learnable: DataFrame, doc_id: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES) -> Classifier | None:
    """positives: identifiers of trusted documents; learnable: identifiers the unlabelled sample may come from."""
    found = []
    for k, ids in enumerate((positives, learnable)):
        strata = ids.select(doc_id).dropDuplicates().withColumn("stratum", F.lit(k))
        picked = sampled(docs, strata, doc_id, text, rows, size, SEED + k).select(F.col(text).alias("t"))

        def run(batches):
            for batch in batches:
                x = features(batch.column(0))
                yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64()))], names=["x"])

        x = np.array(picked.mapInArrow(run, "x array<double>").toArrow()["x"].to_pylist()).reshape(-1, len(NAMES))
        found.append(x[np.lexsort(x.T)])
    return Classifier(*found) if all(map(len, found)) else None


def score(docs: DataFrame, classifier: Classifier | None, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """Kept columns, score and predicted (1 if score >= THRESHOLD)."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("score", "predicted")]
    if classifier is None:
        return docs.select(*keep, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    shared = Sent(docs.sparkSession, classifier)

    def run(batches):
        for batch in batches:
            values = shared.value.scores(features(batch.column(text)))
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in keep} | {"score": pa.array(values), "predicted": pa.array((values >= THRESHOLD).astype(np.int32))})

    kinds = dict(docs.dtypes)
    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "score double, predicted int"]))
