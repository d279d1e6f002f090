"""Toxicity by a convolutional text classifier: hashed word embeddings, filters of several widths, max pooling.

A word's embedding is the sum of table rows for hashes of the word and of its first bytes, so inflected forms of a word
share rows. Filters of widths 1 to 3 run over the words, each filter's largest value over the whole text is kept, and a
dense layer gives a logit. All of it is trained here in numpy: table rows start from the signed significance of their
presence in toxic and clean texts, then Adam trains table, filters and dense layer together; max pooling lets the
gradient reach the words that decided.

The fit learns from every labelled row. Rows lie in shards of about ``most_bytes`` of text by a hash of their id. In each
round every shard trains on its rows in small batches from the same model; Spark averages what the shards changed, a table
row over the shards that changed it, in whole numbers, so that no order of sums matters. Presence is counted by Spark too.
What reaches the driver is as large as the model, whatever the number of rows. A fifth of the rows by another hash is kept
back to calibrate: for each language, which is told from the text's function words, the threshold that separates best
becomes the score 0.7, from counts of all these rows by thousandths of a logit. Language columns, ids, sources and labels
are no inputs of a score.

Defined results: null and empty texts score 0. Labels that are null or whose id is null are ignored; of contradicting
labels the higher counts; of an id's several texts one is taken. Where one part would have no row of a kind, all rows are
in both. Without labels of both kinds every score is 0. A score depends on its text alone, so repeated rows score alike.
Extra columns are ignored.
"""

from __future__ import annotations

import copy
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text
from ._common import broadcast_if_small, drop_stored, free_shuffles, give_back_memory, map_text, ship, stored

#: Bytes of text of a shard.
SHARD_BYTES = 32 << 20
#: Bytes of text that one step of scoring covers, and rows and bytes of a batch of training.
STEP_BYTES, BATCH, BATCH_BYTES = 256 << 10, 64, 512 << 10
#: Words of one text that are embedded at once; longer texts go in pieces.
PIECE = 1 << 16
#: Rows from which on significance, which grows with their root, is scaled back.
USUAL_ROWS = 4_500
#: Units of a change and of a logit in whole numbers.
CHANGE, CENTS = 1 << 24, 1_000
THRESHOLD = 0.7
#: Rows of the table whose changes are put into whole numbers at once.
PART = 1 << 13
ROWS_BITS = 18
SIZE = 16
FILTERS = 16
WIDTHS = (1, 2, 3)
PREFIXES = (3, 4, 5, 6, 7, 8)
#: Rounds over one shard. More shards make more steps a round: then as many steps, but two rounds at least.
EPOCHS = 5
#: Frequent function words by language (fixed values).
FUNCTION_WORDS = {
    "en": "the and of to in is that it was for on with as are be this by from at",
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein als",
    "fr": "le la les de et des en un du une que est pour qui dans par avec il sur",
    "es": "el la los de y en que del las se por un para con una su es al lo",
}


def _feature_rows(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Table rows of each word: the word itself and its longer prefixes; 0 where a prefix would be the word."""
    out = np.zeros((len(starts), 1 + len(PREFIXES)), dtype=np.int32)
    if not len(starts):
        return out
    for k, size in enumerate((0, *PREFIXES)):
        own = np.flatnonzero(ends - starts > size) if size else np.arange(len(starts))
        stop = starts[own] + size if size else ends
        h = _text.mix(_text.span_hashes(flat, starts[own], stop) + np.uint64(k * 0x9E37))
        out[own, k] = (h >> np.uint64(64 - ROWS_BITS)).astype(np.int32) + 1
    return out


@dataclass
class Words:
    """Words of a step of documents: distinct ones with their table rows, and their order in each document."""

    rows: np.ndarray
    which: np.ndarray
    bound: np.ndarray
    language: np.ndarray

    @staticmethod
    def of(flat: np.ndarray, offsets: np.ndarray) -> Words:
        flat = _text.LOWER[flat]
        starts, ends, bound = _text.spans(flat, offsets, _text.ALNUM_OR_HIGH)
        hashes, first, which = np.unique(_text.span_hashes(flat, starts, ends), return_index=True, return_inverse=True)
        counts = []
        for words in FUNCTION_WORDS.values():
            known = np.isin(hashes, _hashes(words))[which] if len(hashes) else np.zeros(0, bool)
            total = np.concatenate([[0], np.cumsum(known)])
            counts.append(total[bound[1:]] - total[bound[:-1]])
        return Words(_feature_rows(flat, starts[first], ends[first]), which, bound, np.argmax(np.array(counts), axis=0))


_known: dict[str, np.ndarray] = {}


def _hashes(words: str) -> np.ndarray:
    if words not in _known:
        flat = np.frombuffer(words.encode(), dtype=np.uint8)
        starts, ends, _ = _text.spans(flat, np.array([0, len(flat)]), _text.NOT_BLANK)
        _known[words] = _text.span_hashes(flat, starts, ends)
    return _known[words]


@dataclass
class Model:
    table: np.ndarray
    filters: dict[int, np.ndarray]  # width -> (width, SIZE, FILTERS)
    bias: dict[int, np.ndarray]
    dense: np.ndarray
    offset: float
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(len(FUNCTION_WORDS)))
    scale: float = 1.0
    trained: bool = True

    def _embedded(self, w: Words) -> np.ndarray:
        """Embedding of each distinct word."""
        out = self.table[w.rows[:, 0]]
        for k in range(1, w.rows.shape[1]):
            out += self.table[w.rows[:, k]]
        return out

    def _pooled(self, x: np.ndarray, lead: np.ndarray, n: np.ndarray, keep: bool) -> tuple[np.ndarray, np.ndarray | None]:
        """Largest value of each filter over the ``n`` windows that begin at each ``lead`` in ``x``, and where, from lead on."""
        segments = np.stack([lead, lead + n], axis=1).ravel()
        pooled, where = [], []
        for width in WIDTHS:
            rows = len(x) - width + 1
            y = x[:rows] @ self.filters[width][0]
            for j in range(1, width):
                y += x[j : rows + j] @ self.filters[width][j]
            y += self.bias[width]
            pooled.append(np.maximum.reduceat(y, segments, axis=0)[::2])
            if keep:
                where.append(np.stack([np.argmax(y[a : a + max(m, 1)], axis=0) for a, m in zip(lead, n)]))
        return np.concatenate(pooled, axis=1), np.concatenate(where, axis=1) if keep else None

    def forward(self, w: Words, keep: bool = False):
        """Logit of each document; with ``keep`` also what the backward pass needs."""
        docs, pad = len(w.bound) - 1, max(WIDTHS) - 1
        n, embedded = np.diff(w.bound), self._embedded(w)
        h = np.zeros((docs, FILTERS * len(WIDTHS)), dtype=np.float32)
        where = np.zeros(h.shape, dtype=np.int64) if keep else None
        at = 0
        while at < docs:
            if n[at] > PIECE:  # windows of a piece reach into the next one
                best = None
                for low in range(int(w.bound[at]), int(w.bound[at + 1]), PIECE):
                    own = w.which[low : min(low + PIECE + pad, w.bound[at + 1])]
                    x = np.zeros((len(own) + pad + 1, SIZE), dtype=np.float32)
                    x[: len(own)] = embedded[own]
                    top, place = self._pooled(x, np.array([0]), np.array([min(PIECE, len(own))]), keep)
                    better = top > best if best is not None else np.ones(top.shape, bool)
                    best = np.where(better, top, best if best is not None else top)
                    if keep:
                        where[at] = np.where(better, place + low, where[at])[0]
                h[at] = np.maximum(best[0], 0)
                at += 1
                continue
            to = at + 1
            while to < docs and n[to] <= PIECE and w.bound[to + 1] - w.bound[at] <= PIECE:
                to += 1
            own, size = w.which[w.bound[at] : w.bound[to]], n[at:to]
            x = np.zeros((len(own) + (to - at) * pad + pad, SIZE), dtype=np.float32)
            x[np.arange(len(own)) + np.repeat(np.arange(to - at) * pad, size)] = embedded[own]  # documents parted by zero rows
            top, place = self._pooled(x, w.bound[at:to] - w.bound[at] + np.arange(to - at) * pad, size, keep)
            h[at:to] = np.maximum(top, 0)
            if keep:
                where[at:to] = place + w.bound[at:to][:, None]
            at = to
        h[n == 0] = 0
        logit = h @ self.dense + self.offset
        return (logit, h, embedded, where) if keep else logit

    def scores(self, w: Words) -> np.ndarray:
        if not self.trained:
            return np.zeros(len(w.bound) - 1)
        logit = self.forward(w).astype(np.float64) - self.thresholds[w.language]
        z = logit * self.scale + np.log(THRESHOLD / (1 - THRESHOLD))
        out = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
        out[np.diff(w.bound) == 0] = 0.0
        return np.round(out, 5)  # beyond that, float32 sums may depend on the batch


def _empty(rng) -> Model:
    return Model(
        (rng.standard_normal(((1 << ROWS_BITS) + 1, SIZE)) * 0.02).astype(np.float32),
        {w: (rng.standard_normal((w, SIZE, FILTERS)) * 0.1).astype(np.float32) for w in WIDTHS},
        {w: np.full(FILTERS, -0.1, np.float32) for w in WIDTHS},
        (rng.standard_normal(FILTERS * len(WIDTHS)) * 0.1).astype(np.float32),
        -1.0,
    )


def significance(clean: np.ndarray, bad: np.ndarray, n: int, p: int) -> np.ndarray:
    """Signed root of the G statistic of each table row's presence in ``n`` clean and ``p`` toxic documents, shrunk."""
    both = clean + bad
    with np.errstate(divide="ignore", invalid="ignore"):
        g = 2 * (np.where(bad > 0, bad * np.log(bad / (both * p / (n + p))), 0) + np.where(clean > 0, clean * np.log(clean / (both * n / (n + p))), 0))
    z = np.sqrt(np.maximum(g, 0)) * np.where(bad / p > clean / n, 1, -1)
    z = np.sign(z) * np.maximum(np.abs(z) - 3.5, 0)
    z[0] = 0
    return z * min(1.0, np.sqrt(USUAL_ROWS / (n + p)))


def _begin(model: Model, start: np.ndarray) -> None:
    """The table's first column begins with significance, and half of the filters with it at one of their places."""
    model.table[0] = 0
    model.table[:, 0] = start / 2
    for w in WIDTHS:
        for f in range(FILTERS // 2):
            model.filters[w][f % w, 0, f] = 0.5
        model.dense[(w - 1) * FILTERS : (w - 1) * FILTERS + FILTERS // 2] = 0.15


class Learner:
    """Adam's steps for filters and dense layer, a root of summed squares (``square``) for each table row."""

    def __init__(self, model: Model, square: np.ndarray, n: int, p: int):
        self.model, self.square = model, square
        self.weight = np.array([(n + p) / (2 * max(n, 1)), (n + p) / (2 * max(p, 1))])  # of clean and toxic rows
        self.small = {"dense": model.dense, **{f"f{w}": model.filters[w] for w in WIDTHS}, **{f"b{w}": model.bias[w] for w in WIDTHS}}
        self.first, self.second = ({k: np.zeros_like(v) for k, v in self.small.items()} for _ in range(2))
        self.changed = np.zeros(len(model.table), dtype=bool)
        self.steps = self.rows = 0

    def step(self, w: Words, toxic: np.ndarray) -> None:
        model, docs = self.model, len(toxic)
        logit, h, embedded, where = model.forward(w, keep=True)
        error = ((1 / (1 + np.exp(-np.clip(logit, -60, 60))) - toxic) * self.weight[toxic.astype(int)] / docs).astype(np.float32)
        grad = {"dense": h.T @ error + 1e-4 * model.dense}
        model.offset -= 0.05 * float(error.sum())
        words, changes = [], []
        for k, width in enumerate(WIDTHS):
            part = slice(k * FILTERS, (k + 1) * FILTERS)
            up = error[:, None] * model.dense[part] * (h[:, part] > 0)  # documents x filters
            gf = np.zeros_like(model.filters[width])
            for j in range(width):
                d, f = np.nonzero((up != 0) & (where[:, part] + j < w.bound[1:, None]))
                word = w.which[where[d, part.start + f] + j]
                np.add.at(gf[j].T, f, embedded[word] * up[d, f][:, None])
                words.append(where[d, part.start + f] + j)
                changes.append(up[d, f][:, None] * model.filters[width][j].T[f])
            grad[f"f{width}"], grad[f"b{width}"] = gf + 1e-4 * model.filters[width], up.sum(axis=0)
        self.steps += 1
        self.rows += docs
        for name, g in grad.items():
            first, second = self.first, self.second
            first[name] = 0.9 * first[name] + 0.1 * g
            second[name] = 0.999 * second[name] + 0.001 * g * g
            self.small[name] -= 0.01 * (first[name] / (1 - 0.9**self.steps)) / (np.sqrt(second[name] / (1 - 0.999**self.steps)) + 1e-8)
        at, own = np.unique(np.concatenate(words), return_inverse=True)
        if not len(at):
            return
        to_x = np.zeros((len(at), SIZE), dtype=np.float32)
        np.add.at(to_x, own, np.concatenate(changes))
        rows = w.rows[w.which[at]]
        g = np.repeat(to_x[:, None, :], rows.shape[1], axis=1).reshape(-1, SIZE)
        rows = rows.ravel()
        g, rows = g[rows > 0], rows[rows > 0]
        np.add.at(self.square, rows, (g * g).mean(axis=1))
        np.add.at(model.table, rows, -0.02 * g / np.sqrt(self.square[rows])[:, None])
        self.changed[rows] = True


def _first_square() -> np.ndarray:
    return np.full((1 << ROWS_BITS) + 1, 1e-3, dtype=np.float32)


def _flat(model: Model) -> np.ndarray:
    """What is no table in one vector."""
    return np.concatenate([model.dense, *[model.filters[w].ravel() for w in WIDTHS], *[model.bias[w] for w in WIDTHS], [model.offset]])


def _unflat(model: Model, flat: np.ndarray) -> None:
    flat, at = flat.astype(np.float32), 0
    for own in [model.dense, *[model.filters[w] for w in WIDTHS], *[model.bias[w] for w in WIDTHS]]:
        own[...] = flat[at : at + own.size].reshape(own.shape)
        at += own.size
    model.offset = float(flat[at])


def fit(texts: list[bytes], toxic: list[bool], seed: int = 7, epochs: int = EPOCHS) -> Model:
    """Train and calibrate on whole texts here: what ``train`` does with one shard."""
    rng = np.random.default_rng(seed)
    toxic = np.array(toxic, dtype=bool)
    model = _empty(rng)
    if not len(toxic) or toxic.all() or not toxic.any():
        model.trained = False
        return model
    order = rng.permutation(len(texts))
    held = np.zeros(len(texts), dtype=bool)
    for kind in (True, False):  # a fifth of either kind
        held[order[toxic[order] == kind][::5]] = True
    if not all((toxic[~held] == kind).any() for kind in (True, False)):
        held[:] = False

    def batches(own):
        for low in range(0, len(own), BATCH):
            parts = [texts[i] for i in own[low : low + BATCH]]
            yield Words.of(np.frombuffer(b"".join(parts), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in parts])])), toxic[own[low : low + BATCH]]

    train = order[~held[order]]
    seen = np.zeros((2, (1 << ROWS_BITS) + 1))
    for w, bad in batches(train):
        _present(seen, w, bad)
    n, p = int((~toxic[train]).sum()), int(toxic[train].sum())
    _begin(model, significance(*seen, n, p))
    learner = Learner(model, _first_square(), n, p)
    for _ in range(epochs):
        for w, bad in batches(rng.permutation(train)):
            learner.step(w, bad)
    counts: dict = {}
    for w, bad in batches(np.flatnonzero(held) if held.any() else order):
        for key in zip(w.language.tolist(), _cents(model.forward(w)).tolist(), bad.tolist()):
            counts[key] = counts.get(key, 0) + 1
    _calibrate(model, *(np.array([k[i] for k in counts]) for i in range(3)), np.array(list(counts.values())))
    return model


def _present(seen: np.ndarray, w: Words, bad: np.ndarray) -> None:
    """Adds to seen[toxic] how many documents have each table row."""
    docs = np.repeat(np.arange(len(bad)), np.diff(w.bound))
    words = np.unique(docs * len(w.rows) + w.which) if len(w.rows) else np.zeros(0, np.int64)
    doc = np.repeat(words // max(len(w.rows), 1), w.rows.shape[1])
    rows = np.unique(doc << 32 | w.rows[words % max(len(w.rows), 1)].ravel())
    for kind in (0, 1):
        seen[kind] += np.bincount(rows[bad[rows >> 32] == bool(kind)] & 0xFFFFFFFF, minlength=seen.shape[1])


def _cents(logits: np.ndarray) -> np.ndarray:
    return np.floor(np.clip(logits, -100, 100) * CENTS).astype(np.int64)


def _calibrate(model: Model, language: np.ndarray, cents: np.ndarray, toxic: np.ndarray, n: np.ndarray) -> None:
    """The best threshold of each language; with few toxic examples it leans on the one of all languages."""
    toxic = toxic.astype(bool)
    pooled = _best(cents, toxic, n)
    for k in range(len(FUNCTION_WORDS)):
        own = language == k
        few = int(n[own & toxic].sum())
        model.thresholds[k] = (few * _best(cents[own], toxic[own], n[own]) + 5 * pooled) / (few + 5) if few and (own & ~toxic).any() else pooled
    spread = abs(_median(cents[toxic], n[toxic]) - _median(cents[~toxic], n[~toxic]))
    model.scale = float(4 / max(spread, 1e-3))


def _median(cents: np.ndarray, n: np.ndarray) -> float:
    order = np.argsort(cents)
    return float(cents[order][np.searchsorted(np.cumsum(n[order]), n.sum() / 2)]) / CENTS


def _best(cents: np.ndarray, toxic: np.ndarray, n: np.ndarray) -> float:
    """The cut with the fewest errors, a clean text lost counting double; in the middle of its gap."""
    values, at = np.unique(cents, return_inverse=True)
    bad, clean = (np.bincount(at[t], weights=n[t], minlength=len(values)) for t in (toxic, ~toxic))
    errors = np.concatenate([[2 * clean.sum()], np.cumsum(bad) + 2 * (clean.sum() - np.cumsum(clean))])  # the lowest i values are called clean
    best = np.flatnonzero(errors == errors.min())
    i = int(best[len(best) // 2])
    low = values[i - 1] if i else values[0] - CENTS
    high = values[i] if i < len(values) else values[-1] + CENTS
    return float(low + high + 1) / (2 * CENTS)


def _batches(batches):
    """(shard, words, toxic) of the small batches of rows (shard, text, bad)."""
    for batch in batches:
        for part, flat, offsets in _text.steps(batch, "text", BATCH_BYTES):
            shards, bad = (part.column(part.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("shard", "bad"))
            at = 0
            while at < len(shards):
                to = at + int(np.argmin(np.append(shards[at : at + BATCH] == shards[at], False)))
                yield int(shards[at]), Words.of(flat[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]), bad[at:to]
                at = to


def _arrow(names: list[str], columns: list[np.ndarray], rows: int = 1 << 15):
    import pyarrow as pa

    for low in range(0, len(columns[0]), rows):
        yield pa.RecordBatch.from_arrays([pa.array(c[low : low + rows]) for c in columns], names=names)


def _over(rows: DataFrame, work, schema: str) -> DataFrame:
    """``work`` over the small batches of a table of rows to learn from."""

    def run(batches):
        yield from work(_batches(batches))
        give_back_memory()  # the worker waits for other tasks

    ship(rows.sparkSession)
    return rows.select("shard", "text", "bad").mapInArrow(run, schema)


def _start(rows: DataFrame, n: int, p: int) -> np.ndarray:
    """Significance of each table row over all documents."""

    def count(batches):
        seen = np.zeros((2, (1 << ROWS_BITS) + 1))
        for _, w, bad in batches:
            _present(seen, w, bad)
        kind, at = np.nonzero(seen)
        yield from _arrow(["bad", "at", "n"], [kind.astype(np.int32), at.astype(np.int32), seen[kind, at].astype(np.int64)])

    got = _over(rows, count, "bad int, at int, n long").groupBy("bad", "at").agg(F.sum("n").alias("n")).toArrow()
    seen = np.zeros((2, (1 << ROWS_BITS) + 1))
    seen[got["bad"].to_numpy(), got["at"].to_numpy()] = got["n"].to_numpy()
    return significance(*seen, n, p)


def _round(rows: DataFrame, model: Model, square: np.ndarray, n: int, p: int) -> None:
    """Every shard trains from ``model``; the average of what they change goes into it."""
    sent = rows.sparkSession.sparkContext.broadcast((model, square))
    names = [f"c{i}" for i in range(SIZE + 1)]

    def changes(old: Model, old_square: np.ndarray, learner: Learner):
        new = learner.model

        def whole(at: np.ndarray, change: np.ndarray):
            units = np.rint(change.astype(np.float64) * CHANGE).astype(np.int64) * learner.rows
            yield from _arrow(["at", "n", *names], [at.astype(np.int32), np.full(len(at), learner.rows, np.int64), *units.T])

        changed = np.flatnonzero(learner.changed)
        for low in range(0, len(changed), PART):
            at = changed[low : low + PART]
            yield from whole(at, np.column_stack([new.table[at] - old.table[at], learner.square[at] - old_square[at]]))
        flat = _flat(new) - _flat(old)
        flat = np.pad(flat, (0, -len(flat) % SIZE)).reshape(-1, SIZE)
        yield from whole(len(old.table) + np.arange(len(flat)), np.column_stack([flat, np.zeros(len(flat))]))

    def learn(batches):
        old, old_square = sent.value
        shard = learner = None
        for own, w, bad in batches:
            if own != shard:
                if learner:
                    yield from changes(old, old_square, learner)
                learner = None  # before the next one's model is copied
                shard, learner = own, Learner(copy.deepcopy(old), old_square.copy(), n, p)
            learner.step(w, bad)
        if learner:
            yield from changes(old, old_square, learner)
        del old, old_square, learner

    made = _over(rows, learn, ", ".join(["at int", "n long", *[f"{c} long" for c in names]]))
    got = made.groupBy("at").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in names]).toArrow()  # as many rows as the model
    sent.destroy()
    at, total = got["at"].to_numpy(), got["n"].to_numpy()
    whole = np.column_stack([got[c].to_numpy() / total for c in names]) / CHANGE
    del got
    inside = at < len(model.table)
    model.table[at[inside]] += whole[inside, :SIZE].astype(np.float32)
    square[at[inside]] += whole[inside, SIZE].astype(np.float32)
    flat = _flat(model)
    own = np.zeros((-(-len(flat) // SIZE), SIZE))
    own[at[~inside] - len(model.table)] = whole[~inside, :SIZE]
    _unflat(model, flat + own.ravel()[: len(flat)])


def _thresholds(rows: DataFrame, model: Model) -> None:
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def logits(batches):
        for _, w, bad in batches:
            yield from _arrow(["language", "cents", "bad"], [w.language.astype(np.int32), _cents(sent.value.forward(w)), bad])

    got = _over(rows, logits, "language int, cents long, bad boolean").groupBy("language", "cents", "bad").agg(F.count(F.lit(1)).alias("n")).toArrow()
    sent.destroy()
    _calibrate(model, *(got[c].to_numpy() for c in ("language", "cents", "bad", "n")))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic", most_bytes: int = SHARD_BYTES, seed: int = 7) -> Model:
    """Fit on all rows of ``labels``, in shards of about ``most_bytes``; pass only rows that may be learned from."""
    spark, model = docs.sparkSession, _empty(np.random.default_rng(seed))
    known = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(id_col).alias("id")).agg((F.max(label) > 0).alias("bad"))
    own = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).where("text is not null").join(broadcast_if_small(known, 24), "id")
    one = own.groupBy("id").agg(F.first("bad").alias("bad"), F.max(F.struct(F.xxhash64("text").alias("key"), "text"))["text"].alias("text"))
    rank = F.xxhash64(F.col("id").cast("string"))
    rows = stored(one.select(rank.alias("rank"), (F.pmod(F.xxhash64(rank, F.lit(1)), F.lit(5)) == 0).alias("held"), "bad", "text"), "labelled")
    free_shuffles(spark)
    counts = {(r["held"], r["bad"]): r for r in rows.groupBy("held", "bad").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("size")).collect()}
    if {bad for _, bad in counts} != {True, False}:
        model.trained = False
        drop_stored(rows)
        return model
    apart = len(counts) == 4
    learned, held = (rows.where("not held"), rows.where("held")) if apart else (rows, rows)
    total = lambda what, *bad: sum(r[what] for (h, b), r in counts.items() if b in bad and not (apart and h))
    n, p = total("n", False), total("n", True)
    shards = max(1, -(-total("size", True, False) // most_bytes))
    shard = F.pmod(F.xxhash64("rank", F.lit(2)), F.lit(shards)).cast("int")
    sharded = stored(learned.withColumn("shard", shard).repartitionById(shards, "shard").sortWithinPartitions("shard", "rank").select("shard", "text", "bad"), "shards")
    _begin(model, _start(sharded, n, p))
    square = _first_square()
    for _ in range(max(min(EPOCHS, 2), -(-EPOCHS // shards))):
        _round(sharded, model, square, n, p)
    _thresholds(held.withColumn("shard", F.lit(0)), model)
    drop_stored(rows, sharded)
    free_shuffles(spark)
    give_back_memory()
    return model


def score(docs: DataFrame, model: Model, text: str = "text", carry: list[str] = ("doc_id",), into: str = "score") -> DataFrame:
    """``carry`` columns and the score of every text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        own = sent.value
        return lambda flat, offsets, part: [own.scores(Words.of(flat, offsets))]

    return map_text(docs, text, list(carry), f"{into} double", start, STEP_BYTES)


def third(id_col: str = "doc_id"):
    """Remainder of crc32(id as text) by 3."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3
