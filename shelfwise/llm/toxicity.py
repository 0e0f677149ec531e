"""Toxicity from class-conditional Kneser-Ney models.

Two models, toxic and ordinary, give each word's bytes a probability from the
ORDER - 1 bytes before, padded at the word's ends. Counts of the longest n-grams
belong to a class; all shorter ones, to which both back off, are continuation
counts shared by the classes, so an expression too rare to have counts of its
own is judged alike by both and says nothing. A word's evidence is the difference
of its log-likelihoods, also divided by its length; a document's features are its
strongest words' evidence, its whole length-normalised difference, and the evidence
beyond each of LEVELS over its distinct words, as a sum (many weak signs count as one
strong sign does) and for each word, beside the number of words of a text that has any
such evidence. A logistic function turns them into a score. It is fitted on features from models that did not see the text: the sample's
distinct texts are dealt to FOLDS parts, and the models of each part count the other
parts only; the models that score count the whole sample.

The models are fitted on a sample of labelled rows: TRAIN_ROWS rows and
TRAIN_BYTES of text per class at most, picked by a hash of the identifier.
Scoring covers whole texts of all rows.

Edge cases: null and empty texts have no evidence and get the score of a text
without any; labels that are null or without a document are left out; without
labels of both classes every score is 0; repeated rows get equal scores; extra
columns are kept unless a result column has the name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .samples import sampled
from .shared import Sent
from .textops import LOWER, U, flat_bytes, ragged

ORDER = 7
DISCOUNT = 0.9
TRAIN_ROWS = 5_000
TRAIN_BYTES = 10 << 20
THRESHOLD = 0.3
SEED = 11
PAD, END = 1, 2
TOP = 3
#: A word's evidence counts in sums over a text as far as it is beyond these levels.
LEVELS = (1.0, 3.0)
FOLDS = 4


def packed_windows(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams as integers, word of each) of words padded by ORDER - 1 bytes before and one after."""
    lengths = np.diff(offsets)
    size = lengths + ORDER
    starts = np.cumsum(size) - size
    padded = np.full(int(size.sum()), PAD, np.uint8)
    padded[ragged(starts + ORDER - 1, lengths)] = LOWER[raw]
    padded[starts + size - 1] = END
    total = np.zeros(max(0, len(padded) - ORDER + 1), U)
    for j in range(ORDER):
        total = (total << U(8)) | padded[j : j + len(total)]
    word = np.repeat(np.arange(len(lengths)), lengths + 1)
    return total[ragged(starts, lengths + 1)], word


def distinct_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(row of each word, code of each word, distinct words) under ASCII white space."""
    column = column.fill_null("") if column.null_count else column
    parts = pc.ascii_split_whitespace(column)
    rows = np.repeat(np.arange(len(column)), np.diff(parts.offsets.to_numpy()))
    coded = parts.flatten().dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    words = coded.dictionary
    full = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    if not full.all():
        rows, codes = rows[full[codes]], codes[full[codes]]
    return rows, codes, words


class Models:
    """Both models as two sorted tables of log-likelihood differences: by n-gram, and by context for unseen n-grams."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, counts: np.ndarray):
        """counts: (words, 2) occurrences of each word in the ordinary and the toxic class."""
        grams, word = packed_windows(raw, offsets)
        keys, at = np.unique(grams, return_inverse=True)
        own = np.stack([np.bincount(at, counts[word, c], len(keys)) for c in (0, 1)], 1)
        del grams, word, at
        shared = self.shared(keys)
        context, group = np.unique(keys >> U(8), return_inverse=True)
        self.keys, self.contexts = keys, context
        logs, weights = [], []
        for c in (0, 1):
            total = np.bincount(group, own[:, c], len(context))
            kinds = np.bincount(group, own[:, c] > 0, len(context))
            weight = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)
            p = np.maximum(own[:, c] - DISCOUNT, 0) / np.maximum(total, 1)[group] + weight[group] * shared
            logs.append(np.log(p))
            weights.append(np.log(weight))
        self.gains = (logs[1] - logs[0]).astype(np.float32)
        self.context_gains = (weights[1] - weights[0]).astype(np.float32)

    @staticmethod
    def shared(keys: np.ndarray) -> np.ndarray:
        """Probability of each n-gram's last byte under the shared continuation counts of all shorter orders."""
        levels, grams = [], keys
        for order in range(ORDER - 1, 0, -1):
            mask = U((1 << (8 * order)) - 1)
            grams, counts = np.unique(grams & mask, return_counts=True)
            levels.append((mask, grams, counts))
        below = None
        for mask, grams, counts in levels[::-1]:
            context, group = np.unique(grams >> U(8), return_inverse=True)
            total = np.bincount(group, counts, len(context))
            kinds = np.bincount(group, minlength=len(context))
            lower = np.full(len(grams), 1 / 256) if below is None else below[1][np.searchsorted(below[0], grams & below[2])]
            p = np.maximum(counts - DISCOUNT, 0) / total[group] + (DISCOUNT * kinds / total)[group] * lower
            below = (grams, p, mask)
        return below[1][np.searchsorted(below[0], keys & below[2])]

    def word_gains(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(log-likelihood difference, bytes with the end) of each word."""
        raw, offsets = flat_bytes(words)
        gains, lengths = np.zeros(len(words)), np.diff(offsets) + 1
        if not len(self.keys):  # a model of no text says nothing
            return gains, lengths
        for lo in range(0, len(words), 200_000):
            hi = min(len(words), lo + 200_000)
            grams, word = packed_windows(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            at = np.minimum(np.searchsorted(self.keys, grams), len(self.keys) - 1)
            hit = self.keys[at] == grams
            gain = np.where(hit, self.gains[at], 0)
            miss = np.flatnonzero(~hit)
            contexts = grams[miss] >> U(8)
            at = np.minimum(np.searchsorted(self.contexts, contexts), len(self.contexts) - 1)
            gain[miss] = np.where(self.contexts[at] == contexts, self.context_gains[at], 0)
            gains[lo:hi] = np.bincount(word, gain, hi - lo)
        return gains, lengths

    def features(self, column: pa.Array) -> np.ndarray:
        """The strongest words' gains, their gains per byte, the text's gain per byte, for each level the log of the distinct words' gains beyond it and the root of their mean, the log of distinct words if there is evidence."""
        n, sums = len(column), 2 * TOP + 1
        out = np.zeros((n, sums + 2 * len(LEVELS) + 1))
        rows, codes, words = distinct_words(column)
        if not len(rows):
            return out
        gains, lengths = self.word_gains(words)
        for k, value in enumerate((gains, gains / lengths)):
            # one step per rank: the best value of each row, then the best of what is left
            values = value[codes]
            left, at_rows = np.ones(len(rows), bool), rows
            for j in range(TOP):
                best = np.full(n, -np.inf)
                np.maximum.at(best, at_rows[left], values[left])
                out[:, k * TOP + j] = np.maximum(best, 0)
                first = np.flatnonzero(left & (values == best[at_rows]))
                chosen = np.unique(at_rows[first], return_index=True)[1]
                left[first[chosen]] = False
        total, size = np.bincount(rows, gains[codes], n), np.bincount(rows, lengths[codes], n)
        out[:, 2 * TOP] = total / np.maximum(size, 1)
        pairs = np.unique(rows.astype(np.int64) * len(words) + codes)
        rows, own = pairs // len(words), gains[pairs % len(words)]
        many = np.maximum(np.bincount(rows, minlength=n), 1)
        for k, level in enumerate(LEVELS):
            beyond = np.bincount(rows, np.maximum(own - level, 0), n)
            out[:, sums + 2 * k], out[:, sums + 2 * k + 1] = np.log1p(beyond), np.sqrt(beyond / many)
        out[:, -1] = np.where(out[:, sums] > 0, np.log1p(many), 0)
        return out


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, steps: int = 60) -> np.ndarray:
    """Weights of a ridge logistic regression, the last one constant, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) / weight.sum() + ridge * w
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x / weight.sum() + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def squash(features: np.ndarray) -> np.ndarray:
    """Features in a like range: single gains level off, sums do not."""
    first = 2 * TOP + 1
    return np.column_stack([np.tanh(features[:, :first] / np.array([4.0] * TOP + [1.0] * TOP + [0.2])), features[:, first:] / 3])


def counted_models(texts: list[str], toxic: np.ndarray) -> Models:
    rows, codes, words = distinct_words(pa.array(texts, pa.string()))
    counts = np.stack([np.bincount(codes[toxic[rows] == c], minlength=len(words)) for c in (0, 1)], 1).astype(float)
    return Models(*flat_bytes(words), counts)


def folds_of(texts: list[str], toxic: np.ndarray) -> np.ndarray:
    """The part of each text: equal texts share one, and each class is dealt evenly."""
    label = {t: int(y) for t, y in sorted(zip(texts, toxic))}
    ranked = sorted(label, key=lambda t: (label[t], hash_text(t), t))
    place = {t: k % FOLDS for k, t in enumerate(ranked)}
    return np.array([place[t] for t in texts], int)


class Scorer:
    def __init__(self, texts: list[str], toxic: np.ndarray, share: np.ndarray):
        """share: the part of its class that a sampled row stands for, as weight of the fit."""
        fold, features = folds_of(texts, toxic), None
        for k in range(FOLDS):
            own = np.flatnonzero(fold == k)
            if not len(own):
                continue
            models = counted_models([t for t, f in zip(texts, fold) if f != k], toxic[fold != k])
            found = models.features(pa.array([texts[j] for j in own], pa.string()))
            features = np.zeros((len(texts), found.shape[1])) if features is None else features
            features[own] = found
        self.weights = fit_logistic(squash(features), toxic, share)
        self.models = counted_models(texts, toxic)

    def scores(self, column: pa.Array) -> np.ndarray:
        x = squash(self.models.features(column))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = TRAIN_ROWS, size: int = TRAIN_BYTES) -> Scorer | None:
    """A scorer, or None without labels of both classes. labels: only rows that may be learnt from."""
    strata = labels.where(F.col(label).isin(0, 1)).groupBy(doc_id).agg(F.max(F.col(label).cast("int")).alias("stratum"))
    found = sampled(docs, strata, doc_id, text, rows, size, SEED).select("stratum", text).toArrow().to_pydict()
    toxic = np.array(found["stratum"], int)
    if len(np.unique(toxic)) < 2:
        return None
    # each class weighs as in the labels
    all_of = {r[0]: r[1] for r in strata.groupBy("stratum").count().collect()}
    share = np.array([all_of[t] / (toxic == t).sum() for t in (0, 1)])[toxic]
    order = np.argsort(np.array([hash_text(t) for t in found[text]]), kind="stable")
    return Scorer([found[text][k] for k in order], toxic[order], share[order])


def hash_text(text: str) -> int:
    import zlib

    return zlib.crc32(text.encode())


def score(docs: DataFrame, scorer: Scorer | None, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """Kept columns, score and predicted (1 if score >= THRESHOLD)."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("score", "predicted")]
    if scorer is None:
        return docs.select(*keep, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    shared = Sent(docs.sparkSession, scorer)

    def run(batches):
        for batch in batches:
            values = shared.value.scores(batch.column(text))
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in keep} | {"score": pa.array(values), "predicted": pa.array((values >= THRESHOLD).astype(np.int32))})

    kinds = dict(docs.dtypes)
    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "score double, predicted int"]))
