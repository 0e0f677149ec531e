"""Scores of texts under a causal self-attention model over subword ids.

Words (A-Z lower-cased, cut at ASCII white space) become ids of a public subword
vocabulary. The HEAD most frequent ids are classes of their own; the others are
clustered by what stands before them, and an id's probability inside its class
comes from counts over the whole training part of the corpus. The model reads
class numbers: embeddings, a causal attention head with learnt distance
biases, a hidden layer, and a table from each class to the next. Texts are
encoded once, into a stored table that all later passes read. Classes come
from counts over all training texts. The weights start from a seeded sample of
TRAIN_ROWS texts and TRAIN_BYTES at most, and are then trained on every window of
every training text, of any length: in each of the rounds of RATES, one share of
the texts by hash, each task trains on its own texts, and the tasks' weights are
averaged by their windows. A text is scored in overlapping windows: each window scores STRIDE
tokens and sees OVERLAP more before them, so each token counts once; windows of a
batch go through masked attention together.

The base score is that of an add-one unigram model of words, counted over all
training texts. Counts up to BROADCAST_WORDS words are looked up in a broadcast
table; beyond that, documents and counts meet by shuffle, bucket by bucket.

Edge cases: null and empty texts hold only the end token; without training texts
N is 0 and the model is uniform over its classes; repeated rows get equal scores;
an empty table gives an empty result; only the named columns are read, and extra
ones are kept unless a result column has the name.
"""

from __future__ import annotations

import copy
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .samples import sampled
from .shared import Sent, shuffle_parts, stored
from .textops import LOWER, U, Powers, flat_bytes, gather_lists, mix, ragged, slices

HEAD = 253
TAIL = 32
WIDTH, KEY = 16, 8
STRIDE, OVERLAP = 32, 16
TRAIN_ROWS = 4_000
TRAIN_BYTES = 6 << 20
STEPS, BATCH = 600, 128
#: Highest learning rate of each round over the training texts, and windows that a step takes there.
RATES, ROUND_BATCH = (0.006, 0.0015), 128
#: Bytes of packed ids whose windows a task holds and mixes at once.
TRAIN_IDS_AT_ONCE = 3 << 20
#: Windows that are scored at once: their arrays stay in a core's cache.
SCORE_BATCH = 256
#: Weights of tasks are summed in so many groups before they reach the driver.
GROUPS = 16
SEED = 7
BROADCAST_WORDS = 8_000_000
TEXT_AT_ONCE = 12 << 20
#: Text in a bucket of documents that meets the counts of its words, about.
BUCKET_BYTES = 32 << 20
#: Texts meet the model in groups of about so many subwords.
TOKENS_AT_ONCE = 1_000_000
WORDS_AT_ONCE = 50_000


def lower_column(column: pa.Array) -> pa.Array:
    """The texts with A-Z in lower case; nulls are empty."""
    raw, offsets = flat_bytes(column)
    data = LOWER[raw].tobytes()
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])


def word_codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(row offsets, code of each word, distinct words) of lower-cased texts."""
    parts = pc.ascii_split_whitespace(column)
    bounds = parts.offsets.to_numpy().astype(np.int64)
    bounds -= bounds[0]
    coded = parts.flatten().dictionary_encode()
    codes, words = coded.indices.to_numpy(), coded.dictionary
    empty = np.flatnonzero(np.diff(flat_bytes(words)[1]) == 0)
    if len(empty):  # before or behind white space at an end of a text
        places = np.flatnonzero(codes == empty[0])
        codes = np.delete(codes, places)
        bounds -= np.searchsorted(places, bounds)
    return bounds, codes, words


def word_hashes(words: pa.Array, powers: Powers) -> np.ndarray:
    """64-bit hashes of whole strings."""
    out = np.zeros(len(words), U)
    for first, raw, offsets in slices(words):
        powers.grow(len(raw) + 1)
        total = np.zeros(len(raw) + 1, U)
        np.cumsum((raw.astype(U) + U(1)) * powers.up[: len(raw)], out=total[1:])
        out[first : first + len(offsets) - 1] = mix((total[offsets[1:]] - total[offsets[:-1]]) * powers.down[offsets[:-1]] + np.diff(offsets).astype(U))
    return out


class Subwords:
    """The public subword model, sent to tasks as its bytes."""

    def __init__(self, path: str):
        self.load(sentencepiece.SentencePieceProcessor(model_file=path).serialized_model_proto())

    def load(self, proto: bytes) -> None:
        self.proto, self.library = proto, sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.size = self.library.get_piece_size()

    def __getstate__(self) -> bytes:
        return self.proto

    __setstate__ = load


def pieces_of(model: Subwords, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, ids) of each distinct word."""
    counts, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
    for at in range(0, len(words), WORDS_AT_ONCE):
        part = words.slice(at, WORDS_AT_ONCE).cast(pa.string())
        # no word holds a line feed, and one long text becomes Python strings sooner than an array
        listed = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part), "\n")[0].as_py().split("\n")
        lists = model.library.encode(listed, num_threads=1)
        counts.append(np.fromiter(map(len, lists), np.int64, len(lists)))
        ids.append(np.fromiter(chain.from_iterable(lists), np.int32, int(counts[-1].sum())))
    return np.concatenate([[0], np.cumsum(np.concatenate(counts))]), np.concatenate(ids)


class Heads:
    """The ids that are classes of their own, and the others with what stands before them."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        order = np.argsort(-counts, kind="stable")
        self.of = np.full(len(counts), -1, np.int64)
        self.of[order[:HEAD]] = np.arange(HEAD)
        self.rest = order[HEAD:]
        self.row = np.full(len(counts), -1)
        self.row[self.rest] = np.arange(len(self.rest))

    def table(self, kind: type) -> np.ndarray:
        return np.zeros((len(self.rest), HEAD + 2), kind)

    def add(self, table: np.ndarray, offsets: np.ndarray, ids: np.ndarray) -> None:
        """Counts what stands before a tail id: head ids, one more for any other, one for a text's start."""
        own = np.take(self.of, ids)
        tail = np.flatnonzero(own < 0)
        before = np.full(len(ids), HEAD)
        before[1:] = np.where(own[:-1] < 0, HEAD, own[:-1])
        before[offsets[:-1][np.diff(offsets) > 0]] = HEAD + 1
        np.add.at(table.ravel(), np.take(self.row, ids[tail]) * table.shape[1] + before[tail], 1)


class Classes:
    """Class of each id, and the logarithm of its share in its class."""

    def __init__(self, offsets: np.ndarray, ids: np.ndarray, size: int):
        heads = Heads(np.bincount(ids, minlength=size))
        table = heads.table(np.float32)
        heads.add(table, offsets, ids)
        self.build(heads, table)

    @classmethod
    def counted(cls, heads: Heads, table: np.ndarray) -> Classes:
        made = cls.__new__(cls)
        made.build(heads, table)
        return made

    def build(self, heads: Heads, table: np.ndarray) -> None:
        self.end, self.bos, self.pad, self.outputs = HEAD + TAIL, HEAD + TAIL + 1, HEAD + TAIL + 2, HEAD + TAIL + 1
        self.of = heads.of.copy()
        self.of[heads.rest] = HEAD + cluster(table, heads.counts[heads.rest])
        self.of = self.of.astype(np.int16)

    def shares(self, counts: np.ndarray) -> None:
        smooth = counts + 0.5
        per_class = np.bincount(self.of, smooth, HEAD + TAIL)
        self.inside = np.log10(smooth / per_class[self.of]).astype(np.float64)


def cluster(table: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """TAIL clusters of rows by a weighted k-means on square roots of shares; unseen rows go to the last."""
    seen = np.flatnonzero(counts > 0)
    out = np.full(len(table), TAIL - 1)
    if not len(seen):
        return out
    x = np.sqrt(table[seen] / table[seen].sum(1, keepdims=True))
    weight = counts[seen].astype(float)
    k = min(TAIL - 1, len(seen))
    centres = x[np.argsort(-weight, kind="stable")[:k]].astype(float)
    for _ in range(12):
        near = (x @ centres.T - 0.5 * (centres**2).sum(1)).argmax(1)
        for c in range(k):
            own = near == c
            if own.any():
                centres[c] = np.average(x[own], axis=0, weights=weight[own])
    out[seen] = near
    return out


def sums_by(rows: np.ndarray, values: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Sums of values' rows by row number. places: the numbers of a result's cells, in its shape."""
    out = np.zeros(places.shape, values.dtype)
    np.add.at(out.ravel(), np.take(places, rows, 0).ravel(), values.ravel())
    return out


def exponentials(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(exponentials in place, their sums by row, what was taken out of each row first).

    The largest logit is taken out only of rows whose exponentials leave the range of their type.
    """
    ones, out = np.ones(logits.shape[1], logits.dtype), np.zeros(len(logits), logits.dtype)
    with np.errstate(over="ignore", invalid="ignore"):
        e = np.exp(logits)
        total = e @ ones
    odd = np.flatnonzero(~(np.isfinite(total) & (total > 1e-30)))
    if len(odd):
        out[odd] = logits[odd].max(1)
        e[odd] = np.exp(logits[odd] - out[odd, None])
        total[odd] = e[odd] @ ones
    return e, total, out


class Adam:
    """Steps on weights, in place: they become views of one array."""

    def __init__(self, w: dict[str, np.ndarray]):
        self.names, self.t = list(w), 0
        self.flat = np.concatenate([w[k].ravel() for k in self.names])
        cuts = np.cumsum([w[k].size for k in self.names])[:-1]
        w.update({k: own.reshape(w[k].shape) for k, own in zip(self.names, np.split(self.flat, cuts))})
        self.first, self.second, self.spare = np.zeros_like(self.flat), np.zeros_like(self.flat), np.empty_like(self.flat)

    def step(self, g: dict[str, np.ndarray], rate: float) -> None:
        self.t += 1
        flat = np.concatenate([g[k].ravel() for k in self.names])
        rate, share = rate / (1 - 0.9**self.t), 1 / (1 - 0.99**self.t)
        by = np.subtract(flat, self.first, out=self.spare)
        by *= 0.1
        self.first += by
        flat *= flat
        flat -= self.second
        flat *= 0.01
        self.second += flat
        # rate * first / (sqrt(share * second) + 1e-8)
        np.multiply(self.second, share / rate**2, out=flat)
        np.sqrt(flat, out=flat)
        flat += 1e-8 / rate
        np.divide(self.first, flat, out=flat)
        self.flat -= flat


class Attention:
    """The model's weights, its gradient and its scores.

    The next class is predicted in two steps, its group and its member in the
    group, so a token costs two short sums over exponentials instead of a long one.
    """

    def __init__(self, classes: Classes):
        self.c = classes
        rng = np.random.default_rng(SEED)
        n_in, self.members = classes.pad + 1, int(np.ceil(np.sqrt(classes.outputs)))
        self.groups = -(-classes.outputs // self.members)
        draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        self.w = {
            "emb": rng.normal(0, 0.5, (n_in, WIDTH)).astype(np.float32), "q": draw(WIDTH, KEY), "k": draw(WIDTH, KEY), "v": draw(WIDTH, KEY),
            "distance": np.zeros(OVERLAP + STRIDE, np.float32), "self": draw(WIDTH, WIDTH), "out": draw(KEY, WIDTH), "bias": np.zeros(WIDTH, np.float32),
            "group_up": 0.3 * draw(WIDTH, self.groups), "group_next": np.zeros((n_in, self.groups), np.float32), "group_const": np.zeros(self.groups, np.float32),
            "up": 0.05 * rng.normal(0, 1, (self.groups, WIDTH, self.members)).astype(np.float32), "next": np.zeros((self.groups, n_in, self.members), np.float32), "const": np.zeros((self.groups, self.members), np.float32),
        }
        self.w = {k: x.astype(np.float32) for k, x in self.w.items()}
        self.w["const"].ravel()[classes.outputs :] = -30  # places without a class
        self.w["distance"][:] = -0.5 * np.arange(OVERLAP + STRIDE)
        length = OVERLAP + STRIDE
        delta = (np.arange(STRIDE) + OVERLAP)[:, None] - np.arange(length)[None, :]
        self.delta, self.later = np.maximum(delta, 0), delta < 0
        number = lambda *shape: np.arange(np.prod(shape)).reshape(shape)
        self.places = {"emb": number(n_in, WIDTH), "group_next": number(n_in, self.groups), "next": number(self.groups * n_in, self.members)}

    def ready(self) -> dict[str, np.ndarray]:
        """The weights joined as the arrays below use them."""
        w = self.w
        return {
            "own": np.concatenate([w["q"] * KEY**-0.5, w["self"]], 1), "kv": np.concatenate([w["k"], w["v"]], 1),
            "distance": np.where(self.later, np.float32(-1e9), w["distance"][self.delta]),
            "group": w["group_next"] + w["group_const"], "next": (w["next"] + w["const"][:, None, :]).reshape(-1, self.members),
        }

    def hidden(self, inputs: np.ndarray, r: dict[str, np.ndarray] | None = None):
        """Hidden layer at the last STRIDE of (windows, OVERLAP + STRIDE) classes, with all that a gradient needs.

        Attention's weights are left undivided, as a row of eight values is divided
        sooner than one of forty-eight; a column of ones beside the values gives the divisor.
        """
        w, n, r = self.w, len(inputs), r or self.ready()
        x = np.take(w["emb"], inputs, 0)
        own = x[:, OVERLAP:].reshape(-1, WIDTH)
        qs = own @ r["own"]
        kv = (x.reshape(-1, WIDTH) @ r["kv"]).reshape(n, -1, 2 * KEY)
        q, k, v = qs[:, :KEY].reshape(n, STRIDE, KEY), kv[:, :, :KEY], np.ones((n, kv.shape[1], KEY + 1), kv.dtype)
        v[:, :, :KEY] = kv[:, :, KEY:]
        padded = np.flatnonzero((inputs == self.c.pad).any(1))
        hide = np.where(inputs[padded] == self.c.pad, np.float32(-1e9), np.float32(0))[:, None, :]

        def logits():
            out = q @ k.transpose(0, 2, 1)
            out += r["distance"]
            out[padded] += hide
            return out

        att = logits()
        with np.errstate(over="ignore", invalid="ignore"):
            np.exp(att, out=att)
            seen = (att @ v).reshape(-1, KEY + 1)
        total = seen[:, KEY]
        if not (np.isfinite(total) & (total > 1e-30)).all():  # an exponential left the range of its type: take the largest out first
            att = logits()
            att -= att.max(2, keepdims=True)
            np.exp(att, out=att)
            seen = (att @ v).reshape(-1, KEY + 1)
            total = seen[:, KEY]
        part = 1 / total[:, None]
        seen = seen[:, :KEY] * part
        # the hyperbolic tangent by an exponential
        h = seen @ w["out"]
        h += qs[:, KEY:]
        h += w["bias"]
        h *= 2
        with np.errstate(over="ignore"):
            np.exp(h, out=h)
        h += 1
        np.divide(-2, h, out=h)
        h += 1
        return h.reshape(n, STRIDE, WIDTH), (x, own, q, k, v, att, part, seen)

    def fast_hidden(self, inputs: np.ndarray, r: dict[str, np.ndarray]) -> np.ndarray:
        """The hidden layer, flat."""
        return self.hidden(inputs, r)[0].reshape(-1, WIDTH)

    def logits(self, h: np.ndarray, last: np.ndarray, group: np.ndarray, r: dict[str, np.ndarray]):
        """Logits of the groups, those of the members of each row's own group, and (group, first row, end) of slices: rows come sorted by group."""
        w = self.w
        bounds = np.searchsorted(group, np.arange(self.groups + 1)).tolist()
        spans = [(i, a, b) for i, (a, b) in enumerate(zip(bounds, bounds[1:])) if b > a]
        d = h @ w["group_up"]
        d += np.take(r["group"], last, 0)
        e = np.empty((len(h), self.members), h.dtype)
        for i, a, b in spans:
            np.matmul(h[a:b], w["up"][i], out=e[a:b])
        e += np.take(r["next"], group * len(w["emb"]) + last, 0)
        return d, e, spans

    def log_probs(self, hidden: np.ndarray, last: np.ndarray, targets: np.ndarray, r: dict[str, np.ndarray] | None = None) -> np.ndarray:
        """Natural logarithm of each target's probability."""
        order = np.argsort((targets // self.members).astype(np.int16), kind="stable")
        want, out = targets[order].astype(np.int64), np.empty(len(targets), hidden.dtype)
        group = want // self.members
        d, e, _ = self.logits(np.take(hidden, order, 0), last[order], group, r or self.ready())
        value, at = 0, np.arange(len(want))
        for logits, chosen in ((d, group), (e, want - group * self.members)):
            _, total, taken = exponentials(logits)
            value = value + np.take(logits.ravel(), at * logits.shape[1] + chosen) - taken - np.log(total)
        out[order] = value
        return out

    def gradient(self, inputs: np.ndarray, targets: np.ndarray, with_loss: bool = True):
        """Mean loss in nats per counted token (or 0 if it isn't asked for), and the gradient; targets of -1 don't count.

        Rows are sorted by the group of their target, so that each group is a slice.
        """
        w, n, n_in, r = self.w, len(inputs), len(self.w["emb"]), self.ready()
        hidden, (x, own, q, k, v, att, part, seen) = self.hidden(inputs, r)
        want, before, flat = targets.ravel(), inputs[:, OVERLAP:].ravel(), hidden.reshape(-1, WIDTH)
        use = np.flatnonzero(want >= 0)
        # by the class before them as well: neighbours are added to one place
        use = use[np.argsort((want[use] // self.members * n_in + before[use]).astype(np.int16), kind="stable")]
        want, last = want[use].astype(np.int64), before[use].astype(np.int64)
        h, group = np.take(flat, use, 0), want // self.members
        many, at = max(1, len(use)), np.arange(len(use))
        d, e, spans = self.logits(h, last, group, r)
        loss, shares = 0.0, []
        for logits, chosen in ((d, group), (e, want - group * self.members)):
            p, total, taken = exponentials(logits)
            if with_loss:
                cells = np.take(logits.ravel(), at * p.shape[1] + chosen)
                loss -= float((cells - taken - np.log(total)).sum() / many)
            p *= (1 / (total * many))[:, None]
            p.ravel()[at * p.shape[1] + chosen] -= 1 / many
            shares.append(p)
        d, e = shares
        g = {"group_up": h.T @ d, "group_next": sums_by(last, d, self.places["group_next"]), "up": np.zeros_like(w["up"])}
        g["next"] = sums_by(group * n_in + last, e, self.places["next"]).reshape(w["next"].shape)
        g["group_const"], g["const"] = g["group_next"].sum(0), np.ones(n_in, e.dtype) @ g["next"]
        back, of_members = np.zeros((len(use) + 1, WIDTH), flat.dtype), np.empty((len(use), WIDTH), flat.dtype)
        np.matmul(d, w["group_up"].T, out=back[:-1])
        for i, a, b in spans:
            np.matmul(h[a:b].T, e[a:b], out=g["up"][i])
            np.matmul(e[a:b], w["up"][i].T, out=of_members[a:b])
        back[:-1] += of_members
        place = np.full(len(flat), len(use))
        place[use] = at
        dh = flat * flat
        np.subtract(1, dh, out=dh)
        dh *= np.take(back, place, 0)
        of_row = np.ones(len(dh), dh.dtype)
        g["bias"], g["out"] = of_row @ dh, seen.T @ dh
        dseen = dh @ w["out"].T
        # through the division, then with the sums' column: the gradient of undivided weights
        wide = np.empty((len(dh), KEY + 1), dh.dtype)
        np.multiply(dseen, part, out=wide[:, :KEY])
        wide[:, KEY] = -np.einsum("ij,ij->i", wide[:, :KEY], seen)
        wide = wide.reshape(n, STRIDE, KEY + 1)
        ds = wide @ v.transpose(0, 2, 1)
        ds *= att
        g["distance"] = np.bincount(self.delta.ravel(), np.ones(n, ds.dtype) @ ds.reshape(n, -1), OVERLAP + STRIDE).astype(ds.dtype)
        left, right = np.empty((len(dh), KEY + WIDTH), dh.dtype), np.empty((n, x.shape[1], 2 * KEY), dh.dtype)
        left[:, :KEY], left[:, KEY:] = (ds @ k).reshape(-1, KEY), dh
        right[:, :, :KEY], right[:, :, KEY:] = ds.transpose(0, 2, 1) @ q, att.transpose(0, 2, 1) @ wide[:, :, :KEY]
        right = right.reshape(-1, 2 * KEY)
        of_own, of_every = own.T @ left, x.reshape(-1, WIDTH).T @ right
        g["q"], g["self"], g["k"], g["v"] = of_own[:, :KEY] * KEY**-0.5, of_own[:, KEY:], of_every[:, :KEY], of_every[:, KEY:]
        dx = (right @ r["kv"].T).reshape(x.shape)
        dx[:, OVERLAP:] += (left @ r["own"].T).reshape(n, STRIDE, WIDTH)
        g["emb"] = sums_by(inputs.ravel(), dx, self.places["emb"])
        return loss, g

    def prior(self, shown: np.ndarray) -> None:
        """Constants from the counts of all classes."""
        full = np.full(self.groups * self.members, 1e-9)
        full[: self.c.outputs] = shown + 0.5
        full = full.reshape(self.groups, self.members)
        self.w["group_const"] = np.log(full.sum(1) / full.sum()).astype(np.float32)
        self.w["const"] = np.log(full / full.sum(1, keepdims=True)).astype(np.float32)

    def train(self, offsets: np.ndarray, tokens: np.ndarray, steps: int = STEPS, batch: int = BATCH) -> float:
        """Adam over random windows; returns the mean loss of the last tenth of the steps."""
        inputs, targets, _ = windows_of(self.c, offsets, tokens)
        if not len(inputs):
            return 0.0
        rng = np.random.default_rng(SEED + 1)
        adam, losses = Adam(self.w), []
        for t in range(1, steps + 1):
            pick = rng.integers(0, len(inputs), batch)
            loss, g = self.gradient(inputs[pick], targets[pick])
            losses.append(loss)
            rate = 0.012 * min(1, t / 30) * (0.5 * (1 + np.cos(np.pi * t / steps)) + 0.02)
            adam.step(g, rate)
        return float(np.mean(losses[-max(1, steps // 10) :]))

    def rounds(self, offsets: np.ndarray, tokens: np.ndarray, rng: np.random.Generator, batch: int):
        """(inputs, targets) of all windows, each once, in random order."""
        inputs, targets, _ = windows_of(self.c, offsets, tokens)
        order = rng.permutation(len(inputs))
        for at in range(0, len(order), batch):
            pick = order[at : at + batch]
            yield np.take(inputs, pick, 0), np.take(targets, pick, 0)

    def log10(self, offsets: np.ndarray, tokens: np.ndarray, at_once: int = SCORE_BATCH) -> np.ndarray:
        """log10 probability of each row's class sequence with its end."""
        cuts = np.searchsorted(offsets, np.arange(TOKENS_AT_ONCE, offsets[-1], TOKENS_AT_ONCE))
        edges = np.unique(np.concatenate([[0], cuts, [len(offsets) - 1]])).tolist()
        parts = [self.log10_group(offsets[a : b + 1] - offsets[a], tokens[offsets[a] : offsets[b]], at_once) for a, b in zip(edges, edges[1:])]
        return np.concatenate([np.zeros(0), *parts])

    def log10_group(self, offsets: np.ndarray, tokens: np.ndarray, at_once: int) -> np.ndarray:
        inputs, targets, row = windows_of(self.c, offsets, tokens)
        r, sums = self.ready(), np.zeros(len(inputs))
        for lo in range(0, len(inputs), at_once):
            own, want = inputs[lo : lo + at_once], targets[lo : lo + at_once].ravel()
            use = np.flatnonzero(want >= 0)
            value = np.zeros(len(want))
            value[use] = self.log_probs(np.take(self.fast_hidden(own, r), use, 0), own[:, OVERLAP:].ravel()[use], want[use], r)
            sums[lo : lo + at_once] = value.reshape(-1, STRIDE).sum(1)
        return np.bincount(row, sums, len(offsets) - 1) / np.log(10)


def windows_of(c: Classes, offsets: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(inputs, targets, row) of the overlapping windows of class sequences; each gets a start and an end."""
    lengths = np.diff(offsets)
    counts = -(-(lengths + 1) // STRIDE)
    row, first = np.repeat(np.arange(len(lengths)), counts), np.cumsum(counts) - counts
    # each text fills windows of its own: after its start in one array, up to its end in the other
    inputs = np.full((len(row), OVERLAP + STRIDE), c.pad, np.int16)
    own, targets = np.full(len(row) * STRIDE, c.pad, np.int16), np.full(len(row) * STRIDE, -1, np.int16)
    at = ragged(first * STRIDE, lengths)
    own[first * STRIDE] = c.bos
    own[at + 1], targets[at] = tokens, tokens
    targets[first * STRIDE + lengths] = c.end
    own = own.reshape(-1, STRIDE)
    inputs[:, OVERLAP:] = own
    inputs[1:, :OVERLAP] = own[:-1, STRIDE - OVERLAP :]
    inputs[first, :OVERLAP] = c.pad
    return inputs, targets.reshape(-1, STRIDE), row


def ids_of(model: Subwords, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, subword ids) of texts."""
    offsets, codes, words = word_codes(lower_column(column))
    return gather_lists(offsets, codes, *pieces_of(model, words))


def id_kind(size: int) -> type:
    """The type that ids of a vocabulary are stored in."""
    return np.uint16 if size <= 1 << 16 else np.uint32


def packed(offsets: np.ndarray, ids: np.ndarray, kind: type) -> pa.Array:
    """Each text's ids as bytes."""
    where = (offsets * np.dtype(kind).itemsize).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(where.tobytes()), pa.py_buffer(ids.astype(kind).tobytes())]).cast(pa.binary())


def unpacked(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, ids) of packed texts."""
    raw, offsets = flat_bytes(column)
    return offsets // np.dtype(kind).itemsize, raw.view(kind).astype(np.int64)


class Scorer:
    """Classes and attention weights: what a task needs."""

    def __init__(self, model: Subwords, classes: Classes, counts: np.ndarray, ends: int, texts: list[str]):
        self.classes, self.attention, self.kind = classes, Attention(classes), id_kind(model.size)
        classes.shares(counts)
        self.attention.prior(np.append(np.bincount(classes.of, counts, HEAD + TAIL), ends))
        offsets, ids = ids_of(model, pa.array(texts, pa.large_string()))
        self.loss = self.attention.train(offsets, classes.of[ids])

    def log10(self, bounds: np.ndarray, ids: np.ndarray) -> np.ndarray:
        inside = np.concatenate([[0], np.cumsum(np.take(self.classes.inside, ids))])
        return self.attention.log10(bounds, self.classes.of[ids]) + inside[bounds[1:]] - inside[bounds[:-1]]


def encode_task(shared, names: list[str], text: str):
    """The columns of a batch and each text's subword ids."""

    def run(batches):
        model = shared.value
        for batch in batches:
            column = batch.column(text)
            parts = [packed(*ids_of(model, column.slice(first, len(own) - 1)), id_kind(model.size)) for first, _, own in slices(column, TEXT_AT_ONCE)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.concat_arrays(parts) if parts else pa.array([], pa.binary())], names=[*names, "_ids"])

    return run


def count_task(size: int):
    """(word hash, count) of a batch's distinct words in training texts; at the end (null, id, count) of the task's subword ids."""
    kind = id_kind(size)

    def run(batches):
        powers = Powers()
        total, texts = np.zeros(size, np.int64), 0
        for batch in batches:
            for first, _, own in slices(batch.column(0), TEXT_AT_ONCE):
                part = lower_column(batch.column(0).slice(first, len(own) - 1))
                _, codes, words = word_codes(part)
                texts += len(part)
                if not len(codes):
                    continue
                counts = np.bincount(codes, minlength=len(words))
                there = np.flatnonzero(counts)  # the empty string between white space is no word
                n = len(there)
                yield pa.RecordBatch.from_arrays([pa.array(word_hashes(words, powers)[there].view(np.int64)), pa.nulls(n, pa.int32()), pa.array(counts[there], pa.int64())], names=["word", "piece", "n"])
            total += np.bincount(unpacked(batch.column(1), kind)[1], minlength=size)
        seen = np.flatnonzero(total)
        n = len(seen) + 1
        yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.array(np.append(seen, -1).astype(np.int32)), pa.array(np.append(total[seen], texts), pa.int64())], names=["word", "piece", "n"])

    return run


def before_task(shared, kind: type):
    """(tail row, what stands before, count) of a task's training texts."""

    def run(batches):
        heads = shared.value
        table = heads.table(np.int32)
        for batch in batches:
            heads.add(table, *unpacked(batch.column(0), kind))
        row, before = np.nonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(row.astype(np.int32)), pa.array(before.astype(np.int16)), pa.array(table[row, before].astype(np.int64))], names=["row", "before", "n"])

    return run


def train_task(shared, rate: float, at_once: int):
    """(group, windows, weights times windows) after a task's steps over all windows of its texts."""

    def run(batches):
        scorer, task = shared.value, TaskContext.get().partitionId()
        net = copy.copy(scorer.attention)
        net.w = {k: x.copy() for k, x in net.w.items()}
        adam, rng, many = Adam(net.w), np.random.default_rng((SEED, task)), 0
        for batch in batches:
            for first, _, own in slices(batch.column(0), TRAIN_IDS_AT_ONCE):
                offsets, ids = unpacked(batch.column(0).slice(first, len(own) - 1), scorer.kind)
                for inputs, targets in net.rounds(offsets, scorer.classes.of[ids], rng, at_once):
                    adam.step(net.gradient(inputs, targets, False)[1], rate * min(1, (adam.t + 1) / 10))
                    many += len(inputs)
        if many:
            flat = np.concatenate([x.ravel() for x in net.w.values()]).astype(np.float64) * many
            yield pa.RecordBatch.from_arrays([pa.array([task % GROUPS], pa.int32()), pa.array([task], pa.int32()), pa.array([many], pa.int64()), pa.array([flat.tobytes()], pa.binary())], names=["part", "task", "many", "weights"])

    return run


def summed_weights(rows: pa.Table) -> pa.Table:
    """One row of several, added in the order of tasks."""
    rows = rows.sort_by("task")
    total = sum(np.frombuffer(x.as_py(), np.float64) for x in rows.column("weights"))
    return pa.table({"part": rows.column("part").slice(0, 1), "many": pa.array([pc.sum(rows.column("many")).as_py()], pa.int64()), "weights": pa.array([total.tobytes()], pa.binary())})


class Table:
    """Word counts as sorted arrays."""

    def __init__(self, words: np.ndarray, counts: np.ndarray):
        self.words, self.counts = words, counts

    @staticmethod
    def sorted(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(words)
        return words[order], counts[order].astype(np.int32)

    def get(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(hashes), np.int64)
        order = np.argsort(hashes)  # neighbours are looked up near each other
        asked, out = hashes[order], np.empty(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.words, asked), len(self.words) - 1)
        out[order] = np.where(self.words[at] == asked, self.counts[at], 0)
        return out


RESULT = "n_tokens long, n_known long, base_sum double, score double"


def score_rows(scorer: Scorer, column: pa.Array, packed_ids: pa.Array, counts_of, ends: int, powers: Powers) -> list[pa.Array]:
    """n_tokens, n_known, sum of log10(count + 1), score of each text."""
    out = []
    for first, _, own in slices(column, TEXT_AT_ONCE):
        offsets, codes, words = word_codes(lower_column(column.slice(first, len(own) - 1)))
        counts = counts_of(word_hashes(words, powers)) if len(words) else np.zeros(0, np.int64)
        known = np.concatenate([[0], np.cumsum((counts > 0)[codes])])
        logs = np.concatenate([[0.0], np.cumsum(np.log10(counts + 1.0)[codes])])
        n = np.diff(offsets)
        out.append((n + 1, known[offsets[1:]] - known[offsets[:-1]] + (ends > 0), logs[offsets[1:]] - logs[offsets[:-1]] + np.log10(ends + 1.0), scorer.log10(*unpacked(packed_ids.slice(first, len(own) - 1), scorer.kind))))
    if not out:
        return [pa.array([], kind) for kind in (pa.int64(), pa.int64(), pa.float64(), pa.float64())]
    return [pa.array(np.concatenate(x)) for x in zip(*out)]


def fit(docs: DataFrame, train: str, model: Subwords, counts: np.ndarray, ends: int, doc_id: str = "doc_id", text: str = "text") -> Scorer:
    """docs: with packed ids, the round that each text is in, and a boolean column that tells what may be learnt from; counts: of ids in all of that, with ends texts."""
    part = docs.where(train)
    send = partial(Sent, docs.sparkSession)
    heads = Heads(counts)
    before = part.select("_ids").mapInArrow(before_task(send(heads), id_kind(model.size)), "row int, before short, n long").groupBy("row", "before").agg(F.sum("n").alias("n")).toArrow()
    table = heads.table(np.float32)
    table[before["row"].to_numpy(), before["before"].to_numpy()] = before["n"].to_numpy()
    classes = Classes.counted(heads, table)
    strata = part.where(F.col(doc_id).isNotNull()).select(doc_id).dropDuplicates().withColumn("stratum", F.lit(0))
    texts = sampled(part, strata, doc_id, text, TRAIN_ROWS, TRAIN_BYTES, SEED).select(text).toArrow()[text].to_pylist()
    scorer = Scorer(model, classes, counts, ends, sorted(texts))
    for k, rate in enumerate(RATES):
        share = part.where(F.col("_round") == k).select("_ids")
        tasks = share.mapInArrow(train_task(send(scorer), rate, ROUND_BATCH), "part int, task int, many long, weights binary")
        rows = sorted(tasks.groupBy("part").applyInArrow(summed_weights, "part int, many long, weights binary").collect())
        if rows:
            flat = sum(np.frombuffer(r.weights, np.float64) for r in rows) / sum(r.many for r in rows)
            w = scorer.attention.w
            cuts = np.cumsum([x.size for x in w.values()])[:-1]
            scorer.attention.w = {key: own.reshape(x.shape).astype(np.float32) for (key, x), own in zip(w.items(), np.split(flat, cuts))}
    return scorer


def score(docs: DataFrame, train: str, model_path: str, keep: list[str] | None = None, doc_id: str = "doc_id", text: str = "text", broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """Kept columns, n_tokens, n_known, train_tokens, base_score, score. train: name of a boolean column of docs."""
    spark = docs.sparkSession
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("n_tokens", "n_known", "train_tokens", "base_score", "score")]
    model = Subwords(model_path)
    kinds = dict(docs.dtypes)
    names = [*dict.fromkeys([*keep, doc_id, text, train]), "_round"]
    # the round stands in the table, so that training reads no text
    dealt = docs.withColumn("_round", F.pmod(F.xxhash64(F.lit(SEED), text), F.lit(len(RATES))).cast("int")).select(*names)
    encoded = stored(dealt.mapInArrow(encode_task(Sent(spark, model), names, text), ", ".join(f"`{c}` {kind}" for c, kind in dealt.dtypes) + ", _ids binary"), "subwords")
    counted = stored(encoded.where(train).select(text, "_ids").mapInArrow(count_task(model.size), "word long, piece int, n long").groupBy("word", "piece").agg(F.sum("n").alias("n")), "counts")
    pieces = counted.where("word IS NULL").select("piece", "n").toArrow().to_pydict()
    totals = counted.where("word IS NOT NULL").agg(F.count(F.lit(1)), F.sum("n")).first()
    by_piece = dict(zip(pieces["piece"], pieces["n"]))
    ends = int(by_piece.pop(-1, 0))
    n_words, n_all, n_kinds = int(totals[0]), int(totals[1] or 0) + ends, int(totals[0]) + (ends > 0)
    counts = np.zeros(model.size)
    counts[list(by_piece)] = list(by_piece.values())
    scorer = fit(encoded, train, model, counts, ends, doc_id, text)
    final = Sent(spark, scorer)
    kept = ", ".join(f"`{c}` {kinds[c]}" for c in keep)
    schema = f"{kept}, {RESULT}" if kept else RESULT
    words = counted.where("word IS NOT NULL").select("word", "n")
    frame = encoded.select(*dict.fromkeys([*keep, text, "_ids"]))
    if n_words <= broadcast_words:
        found = words.toArrow()
        table = spark.sparkContext.broadcast(Table.sorted(found["word"].to_numpy().view(U), found["n"].to_numpy()))

        def run(batches):
            powers, counts = Powers(), Table(*table.value)
            for batch in batches:
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *score_rows(final.value, batch.column(text), batch.column("_ids"), counts.get, ends, powers)], names=[*keep, "n_tokens", "n_known", "base_sum", "score"])

        out = frame.mapInArrow(run, schema)
    else:
        out = by_bucket(frame, words, final, keep, text, ends, schema)
    base = F.col("base_sum") - F.col("n_tokens") * F.lit(float(np.log10(n_all + n_kinds + 1)))
    return out.select(*keep, "n_tokens", "n_known", F.lit(n_all).cast("long").alias("train_tokens"), base.alias("base_score"), "score")


def by_bucket(frame: DataFrame, words: DataFrame, shared, keep: list[str], text: str, ends: int, schema: str) -> DataFrame:
    """Documents meet the counts of their words bucket by bucket: for vocabularies too large to broadcast."""
    size = frame.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = max(4 * shuffle_parts(frame.sparkSession), size // BUCKET_BYTES)
    dealt = frame.withColumn("_bucket", F.pmod(F.xxhash64(text, *keep), F.lit(buckets)).cast("int"))

    def ask(batches):
        powers = Powers()
        for batch in batches:
            column, bucket = lower_column(batch.column("_text")), batch.column("_bucket").to_numpy()
            offsets, codes, names = word_codes(column)
            pairs = np.unique(np.repeat(bucket, np.diff(offsets)).astype(np.int64) * (len(names) + 1) + codes)
            hashes = word_hashes(names, powers).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((pairs // (len(names) + 1)).astype(np.int32)), pa.array(hashes[pairs % (len(names) + 1)])], names=["bucket", "asked"])

    asked = dealt.select(F.col(text).alias("_text"), "_bucket").repartition(buckets, "_bucket").mapInArrow(ask, "bucket int, asked long").distinct()
    told = asked.join(words, F.col("asked") == F.col("word")).select(F.col("bucket").alias("_bucket"), "word", "n")

    def meet(left, right):
        powers = Powers()
        table = Table(*Table.sorted(right.column("word").to_numpy().view(U), right.column("n").to_numpy()))
        for batch in left.to_batches():
            arrays = [*(batch.column(c) for c in keep), *score_rows(shared.value, batch.column(text), batch.column("_ids"), table.get, ends, powers)]
            yield pa.RecordBatch.from_arrays(arrays, names=[x.split("`")[1] if "`" in x else x.split()[0] for x in schema.split(", ")])

    def whole(left: pa.Table, right: pa.Table) -> pa.Table:
        batches = list(meet(left, right))
        return pa.Table.from_batches(batches) if batches else left.select(keep)

    return dealt.groupBy("_bucket").cogroup(told.groupBy("_bucket")).applyInArrow(whole, schema)
