"""Toxicity of whole texts from class-conditional Kneser-Ney models over the letters of expressions.

An expression is a lower-case word without outer punctuation, read letter by letter from a start to an end mark. For each class
P(x|h) = (max(c(hx) - D, 0) + (D * kinds(h) + STRENGTH) * S(x|h)) / (c(h) + STRENGTH), where h are the up to ``ORDER - 1`` letters before x, c counts the training texts of
the class that hold the n-gram's expression, and S is the Kneser-Ney estimate of both classes together: discounted counts, and below them continuation counts (in how many
contexts an n-gram occurs), context by shorter context. An expression that is rare in a class thus backs off to the counts that both share and favours neither.
Where only h is known, S cancels out of the ratio of the classes, and where not even h is, the ratio is 1.

The log-likelihood ratio of an expression is the sum over its letters. A text is judged by ratios normalised by its length: the mean; the mean under a mixture in which
one expression in ``1 / MIXTURE`` comes from the toxic model; the excess of its strongest distinct expressions over the mean; the share of strong ones. A logistic fit over the training texts, each scored
with counts that leave out its fold, turns these into a probability. The mean alone can't: ordinary words of a text's language and subject outweigh the few toxic ones
(figures in the README).

Learning uses labelled rows whose crc32 of the id modulo 3 is not 1, at most ``MAX_TRAIN`` of each class (the least by hash of the id); nothing else of them is cut. Labels,
language, source and id are never inputs of a score.

Results: null text is empty, and has a score like any other. Several labels of one id count as the highest. Without training rows of both classes the score
is the share of toxic rows (0 without any). Repeated rows yield repeated results; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import mix
from .common import let_go, map_rows, small, tidy

MAX_TRAIN = 4000
THRESHOLD = 0.7
DISCOUNT = 0.75
STRENGTH = 20.0
#: Symbols of an n-gram: a letter and those before it.
ORDER = 8
FOLDS = 4
#: Share of expressions that the mixture takes from the toxic model.
MIXTURE = 0.003
#: Excess over a text's mean from which an expression is strong.
STRONG = 3.0
CACHE_ENTRIES = 150_000
#: N-grams that the driver spells or weighs at once.
PIECE = 50_000
_OUTER = ".,;:!?|\"'()[]{}<>%&$#*-_/\\`~=+@^"
_FEATURES = 7
#: White space can't be inside a word, so it marks the ends.
_START, _END = "\t", "\n"
_STEP = np.uint64(0x9E3779B97F4A7C15)


def expression(word: str) -> str:
    return word.lower().strip(_OUTER)


def held_out(doc_id: F.Column) -> F.Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _codes(text: str) -> np.ndarray:
    return mix(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1))


def _found(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of keys in a sorted table, and which of them are there."""
    at = np.searchsorted(table, keys)
    at[at == len(table)] = 0
    return at, (table[at] == keys) if len(table) else np.zeros(len(keys), bool)


class Ratios:
    """Log-likelihood ratios of words as written: n-grams by hash with their steps, and contexts with the step of an n-gram that isn't there."""

    def __init__(self, grams: np.ndarray, steps: np.ndarray, contexts: np.ndarray, falls: np.ndarray) -> None:
        self.grams, self.steps, self.contexts, self.falls = grams, steps, contexts, falls
        self.cache: dict[str, float] = {}

    def of_forms(self, forms: list[str]) -> np.ndarray:
        """Sum of the steps of each expression; 0 for an empty one."""
        code = _codes("".join([f"{_START}{f}{_END}" for f in forms]))
        sizes = np.fromiter(map(len, forms), np.int64, len(forms)) + 2
        starts = np.cumsum(sizes) - sizes
        place = np.arange(len(code)) - np.repeat(starts, sizes)
        context = np.zeros(len(code), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(ORDER - 1, 0, -1):
                inside = np.flatnonzero(place >= k)
                context[inside] = context[inside] * _STEP + code[inside - k]
            gram = context * _STEP + code
        at, known = _found(self.contexts, context)
        step = np.where(known, self.falls[at], 0) if len(self.contexts) else np.zeros(len(code))
        at, known = _found(self.grams, gram)
        if len(self.grams):
            step = np.where(known, self.steps[at], step)
        step[starts] = 0
        return np.where(sizes > 2, np.add.reduceat(step, starts), 0)

    def learn(self, words: list[list[str]]) -> None:
        """Ratios of all words of some texts go to the cache."""
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.clear()
        new = list(set().union(*words) - self.cache.keys())
        for i in range(0, len(new), 50_000):
            part = new[i : i + 50_000]
            self.cache.update(zip(part, self.of_forms(list(map(expression, part))).tolist(), strict=True))

    def features(self, texts: list[str | None]) -> np.ndarray:
        """One row of features for each text."""
        words = [(t or "").split() for t in texts]
        self.learn(words)
        out, get = np.zeros((len(texts), _FEATURES)), self.cache.__getitem__
        for row, ws in zip(out, words, strict=True):
            if ws:
                x = np.fromiter(map(get, ws), np.float64, len(ws))
                mean, n = float(x.mean()), len(x)
                top = np.zeros(3)
                best = np.unique(x)[:-4:-1] - mean
                top[: len(best)] = best
                strong = int((x - mean > STRONG).sum())
                mixed = float(np.log1p(MIXTURE * np.expm1(np.minimum(x, 30))).mean())
                row[:] = mean, math.asinh(mixed / MIXTURE), top[0], top.sum() / 3, math.log1p(strong), 50 * strong / n, math.log(n)
        return out


def _gram_counts(sample: DataFrame) -> DataFrame:
    """gram and, by fold and class (ordinary first), the number of texts with its expressions, summed over these; out of (fold, toxic, text)."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        seen: Counter = Counter()
        for batch in small(batches):
            for fold, toxic, text in zip(*[batch.column(c).to_pylist() for c in ("fold", "toxic", "text")], strict=True):
                seen.update([(fold * 2 + toxic, form) for form in set(map(expression, (text or "").split())) if form])
        counts: Counter = Counter()
        for (cell, form), n in seen.items():
            spelled = f"{_START}{form}{_END}"
            for i in range(2, len(spelled) + 1):
                counts[spelled[max(0, i - ORDER) : i], cell] += n
        every = list(counts.items())
        for i in range(0, len(every), 50_000):
            part = every[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k, _ in part], pa.string()), pa.array([k[1] for k, _ in part], pa.int32()), pa.array([n for _, n in part], pa.int64())], names=["gram", "cell", "n"])

    cells = sample.mapInArrow(grams, "gram string, cell int, n long").groupBy("gram")
    return cells.agg(*[F.sum(F.when(F.col("cell") == i, F.col("n")).otherwise(0)).cast("int").alias(f"c{i}") for i in range(2 * FOLDS)])


def _points(grams: pa.ChunkedArray | list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of the n-grams, one row each with the last ones at its end, and their sizes. The driver never holds all of them as Python objects."""
    points, size = np.zeros((len(grams), ORDER), np.uint32), np.zeros(len(grams), np.uint8)
    for i in range(0, len(grams), PIECE):
        part = grams[i : i + PIECE] if isinstance(grams, list) else grams.slice(i, PIECE).to_pylist()
        size[i : i + len(part)] = list(map(len, part))
        spelled = "".join([g.rjust(ORDER, "\0") for g in part])
        points[i : i + len(part)] = np.frombuffer(spelled.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, ORDER)
    return points, size


def _hashes(points: np.ndarray, rows: np.ndarray, m: int, last: bool = True) -> np.ndarray:
    """Hashes of the last m symbols of some rows, or of these without the last one."""
    out = np.zeros(len(rows), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(rows), PIECE):
            part, h = points[rows[i : i + PIECE]], out[i : i + PIECE]
            for j in range(ORDER - m, ORDER if last else ORDER - 1):
                h *= _STEP
                h += mix(part[:, j].astype(np.uint64) + np.uint64(1))
    return out


class _Shared:
    """What both classes share, by n-gram in the order of its hash: hashes, contexts (by number, in the order of theirs), and the continuation
    estimate of each n-gram's last symbol after its context without the first. ``order`` leads there from the n-grams as given.
    """

    def __init__(self, points: np.ndarray, size: np.ndarray) -> None:
        below: tuple[np.ndarray, np.ndarray] | None = None
        up = np.zeros(len(points))
        for m in range(1, ORDER):
            # Different n-grams of m + 1 symbols, by their last m: an n-gram of m symbols continues so many contexts.
            longer = np.flatnonzero(size > m)
            rows = longer[np.unique(_hashes(points, longer, m + 1), return_index=True)[1]]
            known, where, n = np.unique(_hashes(points, rows, m), return_index=True, return_counts=True)
            rows = rows[where]
            group = np.unique(_hashes(points, rows, m, last=False), return_inverse=True)[1]
            total, kinds = np.bincount(group, weights=n), np.bincount(group)
            backed = np.full(len(known), 1 / max(len(known), 1)) if below is None else below[1][np.searchsorted(below[0], _hashes(points, rows, m - 1))]
            p = (n - DISCOUNT + DISCOUNT * kinds[group] * backed) / total[group]
            below = (known, p)
            own = np.flatnonzero(size == m + 1)
            up[own] = p[np.searchsorted(known, _hashes(points, own, m))]
        whole, context = np.zeros(len(points), np.uint64), np.zeros(len(points), np.uint64)
        for m in range(2, ORDER + 1):
            own = np.flatnonzero(size == m)
            whole[own], context[own] = _hashes(points, own, m), _hashes(points, own, m, last=False)
        self.order = np.argsort(whole)
        self.whole, self.up = whole[self.order], up[self.order]
        self.contexts, group = np.unique(context[self.order], return_inverse=True)
        self.group = group.astype(np.int32)


def _shared(grams: pa.ChunkedArray | list[str]) -> _Shared:
    return _Shared(*_points(grams))


def _ratios(shared: _Shared, counts: np.ndarray) -> Ratios:
    """The ratios for counts (ordinary, toxic) of the n-grams as given; hashes and contexts are one array for all ratios."""
    counts = counts[shared.order]
    sums = lambda x: np.bincount(shared.group, weights=x, minlength=len(shared.contexts))
    total, kinds = (np.stack([sums(f(counts[:, i])) for i in (0, 1)], axis=1) for f in (lambda x: x, lambda x: x > 0))
    all_, of_both = total.sum(axis=1), sums(counts.any(axis=1))
    fall = np.log((DISCOUNT * kinds + STRENGTH) / (total + STRENGTH))
    fall = (fall[:, 1] - fall[:, 0]).astype(np.float32)
    step = np.zeros(len(counts), np.float32)
    for i in range(0, len(counts), PIECE):
        n, group, up = counts[i : i + PIECE], shared.group[i : i + PIECE], shared.up[i : i + PIECE]
        both = n.sum(axis=1)
        s = (np.maximum(both - DISCOUNT, 0) + DISCOUNT * of_both[group] * up) / np.maximum(all_, 1)[group]
        p = (np.maximum(n - DISCOUNT, 0) + (DISCOUNT * kinds[group] + STRENGTH) * s[:, None]) / (total[group] + STRENGTH)
        step[i : i + PIECE] = np.where(both > 0, np.log(np.maximum(p[:, 1], 1e-300) / np.maximum(p[:, 0], 1e-300)), fall[group])
    return Ratios(shared.whole, step, shared.contexts, fall)


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic weights by Newton steps on standardised features, with a small ridge; given for the features as they are, the constant last."""
    mean, spread = x.mean(axis=0), x.std(axis=0)
    spread[spread < 1e-9] = 1
    z = np.c_[(x - mean) / spread, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w += np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.eye(len(w)) * 0.01, z.T @ (y - p) - 0.01 * w)
    return np.append(w[:-1] / spread, w[-1] - (w[:-1] * mean / spread).sum())


class Model:
    """Ratios, and the weights of the features."""

    def __init__(self, ratios: Ratios, weights: np.ndarray) -> None:
        self.ratios, self.weights = ratios, weights

    def scorer(self) -> Callable[[list[str | None]], np.ndarray]:
        def score(texts: list[str | None]) -> np.ndarray:
            z = self.ratios.features(texts) @ self.weights[:-1] + self.weights[-1]
            return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

        return score


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_train: int = MAX_TRAIN) -> Model:
    """The model of the labelled training rows; what comes to the driver is bounded by ``max_train``: the n-grams of those texts, and a row of features for each."""
    ids = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    h = F.xxhash64("doc_id")
    picked = [ids.where(F.col("toxic") == t).orderBy(h, "doc_id").limit(max_train) for t in (0, 1)]
    chosen = picked[0].unionByName(picked[1]).select(F.col("doc_id").cast("long").alias("_id"), "toxic", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLDS)).cast("int").alias("fold"))
    # At most 2 * max_train ids.
    sample = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), "_id")

    table = _gram_counts(sample).toArrow()
    cells = np.zeros((table.num_rows, 2 * FOLDS), np.int32)
    for i in range(2 * FOLDS):
        cells[:, i] = table.column(f"c{i}").to_numpy()
    cells = cells.reshape(-1, FOLDS, 2)
    if not cells.any(axis=(0, 1)).all():
        share = ids.agg(F.avg("toxic")).first()[0] or 0.0
        none = np.zeros(0, np.uint64)
        constant = math.log(max(share, 1e-9) / max(1 - share, 1e-9)) if share else -30.0
        return Model(Ratios(none, none.astype(np.float32), none, none.astype(np.float32)), np.array([0.0] * _FEATURES + [constant]))
    shared = _shared(table.column("gram"))
    del table
    sums = cells.sum(axis=1, dtype=np.int32)
    without = [_ratios(shared, sums - cells[:, f]) for f in range(FOLDS)]
    del cells
    tidy()

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in small(batches):
            folds, marks, texts = (batch.column(c).to_pylist() for c in ("fold", "toxic", "text"))
            x = np.zeros((len(texts), _FEATURES))
            for f, ratios in enumerate(without):
                rows = [i for i, g in enumerate(folds) if g == f]
                if rows:
                    x[rows] = ratios.features([texts[i] for i in rows])
            yield pa.RecordBatch.from_arrays([pa.array(x.tolist(), pa.list_(pa.float64())), pa.array(marks, pa.int32())], names=["x", "y"])

    fit = sample.mapInArrow(features, "x array<double>, y int").toArrow()
    del without
    model = Model(_ratios(shared, sums), _fit(np.array(fit.column("x").to_pylist()), fit.column("y").to_numpy().astype(float)))
    del shared, sums
    tidy()
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""

    def make():
        many = model.scorer()

        def fn(columns):
            scores = many(columns[2])
            return [columns[0], columns[1], scores.tolist(), (scores >= threshold).astype(int).tolist()]

        return fn

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return map_rows(source, "doc_id long, held_out boolean, score double, predicted int", make)


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows and columns of documents that the model doesn't reject."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        many = model.scorer()
        for batch in small(batches):
            yield batch.filter(pa.array(many(batch.column(text_col).to_pylist()) < threshold, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
