"""Quality classifier by co-training of two views.

One view reads the text (byte trigrams and shape), the other the metadata (source, language,
length). Both start from the same labelled documents. In every round each view labels unlabelled
documents, and the ones it is sure of become training rows of the other view. Afterwards both are
calibrated on labelled documents that neither has seen, and their evidence is added up over the
prior to score every document.

Fitting uses a sample bounded by ``CoTraining``: the rows with the smallest hashes of their ids,
features only. Scoring is a narrow map over all documents and whole texts.

Defined cases: null text counts as empty, null metadata as a value of its own; a document with
several labels takes the lowest; rows that share a doc_id are scored one by one; with no labels,
or labels of one class only, every document is kept and scores are null; an empty table gives an
empty result; only doc_id, text, source, lang and n_chars are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaintlens.llm.common import byte_slices

TRIGRAMS, SHAPES, REPEATS, CATEGORIES = 2048, 8, 3, 256
TEXT_WIDTH, META_WIDTH = TRIGRAMS + SHAPES + REPEATS, CATEGORIES + 2
#: Bytes and rows whose features a task holds at once.
SLICE = (2 << 20, 512)
SCORED = "doc_id long, text_score double, metadata_score double, score double, kept boolean"


@dataclass(frozen=True)
class CoTraining:
    """Bounds of the sample and settings of the rounds."""

    labelled: int = 3_000  # labelled documents that the views learn from
    held_out: int = 1_500  # labelled documents for calibration and the threshold
    pool: int = 2_000  # unlabelled documents that the views label for each other
    rounds: int = 3
    sure: float = 0.95  # confidence from which a pseudo-label is handed on
    per_round: int = 200  # pseudo-labels of each class that a view hands on in a round
    keep_good: float = 0.998  # share of good held-out documents that the threshold should keep
    outliers: int = 2  # lowest good held-out documents that do not count, at any size
    reject_bad: float = 0.98  # share of bad held-out documents down to which that may go
    threshold: float = 0.5  # score under which a document goes, if those shares allow


def _view(name: str) -> Column:
    """A column as the views read it: no nulls."""
    if name == "n_chars":
        return F.coalesce(F.col(name).cast("long"), F.lit(-1))
    return F.coalesce(F.col(name).cast("string"), F.lit("" if name == "text" else "\0"))


READ = ("text", "source", "lang", "n_chars")


def views(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), *(_view(c).alias(c) for c in READ)
    )


_SHAPE_SETS = [
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\v\f", b"\n",
    b".,;:!?'\"()-", b"#*$%&|<>{}[]@\\^_~`=+/",
]
_SHAPE_OF = np.full(256, len(_SHAPE_SETS))
for _i, _set in enumerate(_SHAPE_SETS):
    _SHAPE_OF[list(_set)] = _i


def text_features(batch: list[str]) -> np.ndarray:
    """Square roots of the shares of hashed byte trigrams and of kinds of bytes, and how much the
    text repeats itself: how far zlib shrinks it, and the evenness of its trigrams."""
    raw = [t.encode() for t in batch]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    data = np.frombuffer(b"".join(raw), np.uint8)
    of = np.repeat(np.arange(len(raw)), sizes)
    shape = np.bincount(of * SHAPES + _SHAPE_OF[data], minlength=len(raw) * SHAPES)
    code = data.astype(np.uint32)
    code = code[:-2] | code[1:-1] << np.uint32(8) | code[2:] << np.uint32(16)
    code = (code * np.uint32(2654435761)) >> np.uint32(32 - TRIGRAMS.bit_length() + 1)
    inside = of[2:] == of[:-2]
    grams = np.bincount(
        of[2:][inside] * TRIGRAMS + code[inside], minlength=len(raw) * TRIGRAMS
    )
    parts = [grams.reshape(len(raw), TRIGRAMS), shape.reshape(len(raw), SHAPES)]
    share = np.sqrt(np.concatenate(parts, axis=1) / np.maximum(sizes, 1)[:, None])
    shrunk = np.fromiter((len(zlib.compress(r, 1)) for r in raw), float, len(raw))
    ratio = np.where(sizes > 0, shrunk / np.maximum(sizes, 1), 1.0)
    squares = share[:, :TRIGRAMS] ** 2
    evenness = -(squares * np.log(np.maximum(squares, 1e-12))).sum(axis=1)
    evenness /= np.log(np.minimum(sizes, TRIGRAMS) + 2.0)
    repeats = np.stack([np.minimum(ratio, 1.5), np.log(np.minimum(ratio, 1.5)), evenness], axis=1)
    repeats[sizes == 0] = 0
    return np.concatenate([share, repeats], axis=1).astype(np.float32)


def metadata_features(sources: list[str], langs: list[str], n_chars: list[int]) -> np.ndarray:
    out = np.zeros((len(sources), META_WIDTH), np.float32)
    half = CATEGORIES // 2
    for i, (source, lang) in enumerate(zip(sources, langs)):
        out[i, xxhash.xxh32_intdigest(source) % half] = 1
        out[i, half + xxhash.xxh32_intdigest(lang) % half] = 1
    size = np.log1p(np.maximum(np.array(n_chars, float), 0))
    out[:, -2], out[:, -1] = size, size * size / 10
    return out


def features(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    own = {c: batch.column(c).to_pylist() for c in ("text", "source", "lang", "n_chars")}
    return text_features(own["text"]), metadata_features(own["source"], own["lang"], own["n_chars"])


def logistic(z):
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def log_odds(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def deviations(centred: np.ndarray) -> np.ndarray:
    """Standard deviations of columns with mean zero, some columns at a time."""
    blocks = np.array_split(centred, -(-centred.shape[1] // 256), axis=1)
    return np.sqrt(np.concatenate([np.square(b).sum(axis=0) for b in blocks]) / len(centred))


class View:
    """Logistic regression on standardised features."""

    def __init__(self, penalty: float):
        self.penalty = penalty

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 200) -> View:
        z = x.astype(np.float64)  # the only copy; standardised in place
        self.mean = z.mean(axis=0)
        z -= self.mean
        self.scale = deviations(z)
        # what hardly ever varies in the sample must not blow up elsewhere
        self.scale = np.where(self.scale < 1e-3, 1.0, self.scale)
        z /= self.scale
        turn = np.ones(z.shape[1])
        for _ in range(20):  # power iteration: how steep the loss can be
            turn = z.T @ (z @ (turn / max(np.linalg.norm(turn), 1e-12))) / len(z)
        rate = 4.0 / (1.2 * np.linalg.norm(turn) + 1.0 + 4 * self.penalty)
        weights, ahead = np.zeros(z.shape[1] + 1), np.zeros(z.shape[1] + 1)
        for step in range(steps):  # accelerated gradient descent
            error = logistic(z @ ahead[:-1] + ahead[-1]) - y
            slope = np.append(z.T @ error / len(z) + self.penalty * ahead[:-1], error.mean())
            before, weights = weights, ahead - rate * slope
            ahead = weights + step / (step + 3) * (weights - before)
        self.weights = weights
        return self

    def odds(self, x: np.ndarray) -> np.ndarray:
        z = x - self.mean
        z /= self.scale
        return z @ self.weights[:-1] + self.weights[-1]


@dataclass
class CoTrained:
    """Two calibrated views, the prior they share, and the score under which documents go."""

    text: View
    metadata: View
    text_curve: View
    metadata_curve: View
    prior: float
    threshold: float = 0.0

    def scores(self, text: np.ndarray, metadata: np.ndarray):
        """Calibrated probabilities of both views, and of both together."""
        a = self.text_curve.odds(self.text.odds(text)[:, None])
        b = self.metadata_curve.odds(self.metadata.odds(metadata)[:, None])
        prior = log_odds(self.prior)
        return logistic(a), logistic(b), logistic(a + b - prior)


def co_train(labelled, y: np.ndarray, held_out, y_held: np.ndarray, pool, settings: CoTraining):
    """Fit from (text features, metadata features) of labelled, held-out and unlabelled rows."""
    x = [np.asarray(v) for v in labelled]
    targets = [y.astype(float), y.astype(float)]
    free = [np.asarray(v) for v in pool]
    penalties = (1e-2, 1e-2)
    fitted = [View(p).fit(v, t) for p, v, t in zip(penalties, x, targets)]
    for _ in range(settings.rounds):
        if not len(free[0]):
            break
        used = np.zeros(len(free[0]), bool)
        for view, other in ((0, 1), (1, 0)):
            p = logistic(fitted[view].odds(free[view]))
            good, bad = np.argsort(-p)[: settings.per_round], np.argsort(p)[: settings.per_round]
            for rows, label, sure in ((good, 1.0, p[good]), (bad, 0.0, 1 - p[bad])):
                rows = rows[sure >= settings.sure]
                rows = rows[~used[rows]]
                used[rows] = True
                x[other] = np.concatenate([x[other], free[other][rows]])
                targets[other] = np.append(targets[other], np.full(len(rows), label))
        if not used.any():
            break
        free = [v[~used] for v in free]
        fitted = [View(p).fit(v, t) for p, v, t in zip(penalties, x, targets)]
    curves = [
        View(1e-3).fit(f.odds(v)[:, None], y_held) for f, v in zip(fitted, held_out)
    ]
    model = CoTrained(*fitted, *curves, prior=float(np.clip(y_held.mean(), 0.01, 0.99)))
    score = model.scores(*held_out)[2]
    model.threshold = chosen_threshold(score[y_held == 1], score[y_held == 0], settings)
    return model


def chosen_threshold(good: np.ndarray, bad: np.ndarray, settings: CoTraining) -> float:
    """The settings' threshold, or a lower one that keeps the share of good documents wanted; never
    so low that less than the share of bad ones goes."""
    lowest = settings.threshold
    if len(good):
        allowed = int((1 - settings.keep_good) * len(good)) + settings.outliers
        lowest = float(np.sort(good)[min(allowed, len(good) - 1)])
    if len(bad):
        last = np.sort(bad)[int(np.ceil(settings.reject_bad * len(bad))) - 1]
        lowest = max(lowest, float(np.nextafter(last, np.inf)))
    return min(settings.threshold, lowest)


def sampled(docs: DataFrame, ids: DataFrame, bound: int) -> list:
    """Features of the documents in ``ids`` (doc_id, quality), which has ``bound`` rows at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", *SLICE):
                text, metadata = features(part)
                rows = np.concatenate([text, metadata], axis=1).astype(np.float16)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"),
                        "quality": part.column("quality"),
                        "features": pa.array([r.tobytes() for r in rows], pa.binary()),
                    }
                )

    joined = views(docs).join(F.broadcast(ids), "doc_id")
    found = joined.mapInArrow(run, "doc_id long, quality int, features binary")
    return sorted(found.limit(2 * bound).collect())


def fit(docs: DataFrame, labels: DataFrame, settings: CoTraining = CoTraining()) -> CoTrained | None:
    """Co-train on a bounded sample; None without labels of both classes."""
    known = (
        labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").cast("int").alias("quality"))
    )
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id IS NOT NULL")
    order = F.xxhash64("doc_id")
    bound = settings.labelled + settings.held_out
    chosen = ids.join(known, "doc_id").orderBy(order, "doc_id").limit(bound)
    free = ids.join(known, "doc_id", "left_anti").orderBy(order, "doc_id").limit(settings.pool)
    wanted = chosen.unionByName(free.withColumn("quality", F.lit(None).cast("int"))).distinct()
    rows = sampled(docs, wanted, bound + settings.pool)
    if not rows:
        return None
    # kept in half precision as it came: the driver holds one wide copy, of the view being fitted
    x = np.frombuffer(b"".join(r.features for r in rows), np.float16).reshape(len(rows), -1)
    y = np.array([-1 if r.quality is None else r.quality for r in rows])
    del rows
    two = x[:, :TEXT_WIDTH], x[:, TEXT_WIDTH:]
    seen = np.flatnonzero(y >= 0)
    seen = np.random.default_rng(7).permutation(seen)
    held = np.sort(seen[: len(seen) * settings.held_out // bound])
    train = np.sort(seen[len(held) :])
    if len(set(y[train])) < 2 or len(set(y[held])) < 2:
        return None
    labelled, held_out, pool = (
        tuple(v[of] for v in two) for of in (train, held, np.flatnonzero(y < 0))
    )
    del x, two
    return co_train(labelled, y[train], held_out, y[held], pool, settings)


def quality_scores(
    docs: DataFrame, labels: DataFrame, settings: CoTraining = CoTraining()
) -> DataFrame:
    """One row per document: doc_id, text_score, metadata_score, score, kept."""
    model = fit(docs, labels, settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", *SLICE):
                yield from judged(part)

    def judged(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n = part.num_rows
        if model is None:
            scores, kept = [pa.nulls(n, pa.float64())] * 3, pa.array([True] * n)
        else:
            found = model.scores(*features(part))
            scores = [pa.array(np.asarray(s, float)) for s in found]
            kept = pa.array(found[2] >= model.threshold)
        columns = [part.column("doc_id"), *scores, kept]
        names = [x.split()[0] for x in SCORED.split(", ")]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    return views(docs).mapInArrow(run, SCORED)


def kept_documents(
    docs: DataFrame, labels: DataFrame, settings: CoTraining = CoTraining()
) -> DataFrame:
    """The input's rows, all columns as they are, without those that the classifier rejects."""
    model = fit(docs, labels, settings)
    if model is None:
        return docs

    @F.pandas_udf("boolean")
    def kept(text: pd.Series, source: pd.Series, lang: pd.Series, n_chars: pd.Series) -> pd.Series:
        rows = pa.RecordBatch.from_pydict(
            {
                "text": pa.array(text, pa.string()),
                "source": pa.array(source, pa.string()),
                "lang": pa.array(lang, pa.string()),
                "n_chars": pa.array(n_chars, pa.int64()),
            }
        )
        parts = byte_slices(rows, "text", *SLICE)
        scores = [model.scores(*features(part))[2] for part in parts]
        return pd.Series(np.concatenate([*scores, np.empty(0)]) >= model.threshold)

    return docs.filter(kept(*(_view(c) for c in READ)))
