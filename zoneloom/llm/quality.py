"""Quality classifier by co-training.

Two views of a document: its content (figures of its characters and words, of the whole text) and its
metadata (source, language, stated length). Each view has a logistic model. Both start from the labelled
sample; for some rounds each model labels the documents of an unlabelled pool of which it is most
confident, and hands them to the other; only a view that does better than guessing on labelled documents
kept apart may do so. In the end both are calibrated on these, and a third logistic model over the two
calibrated scores gives the quality of every document. Where a view alone has the lower loss in folds of the
documents kept apart, its calibrated score is the quality: a view that knows nothing costs nothing.

Parameters that bound what is fitted: ``labelled`` and ``pool`` documents at most, chosen by a hash of
the id; only their figures, some dozens a document, come to the driver. Every document is scored.

Defined cases: null and empty texts have zeros for all figures, as content to be judged like any other;
null metadata is a value of its own; unknown sources and languages count as rare; without labels of both
kinds every document scores 0.5 and is kept; null ids have no label; repeated rows score alike; an empty
table gives no rows; other columns are neither read nor returned by ``score_documents``.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneloom.llm.common import WHITE, slices, small_batches, whole_row, word_hashes, words

KINDS = 12
SLOTS = 64  # of hashed metadata values
CONFIDENT = 0.95
GAIN = 0.02  # share of the loss of guessing that a view has to save to be heard


def _kinds() -> np.ndarray:
    """The kind of each byte: which marks a text uses is counted kind by kind."""
    kind = np.zeros(256, np.int64)
    kind[np.flatnonzero(WHITE)] = 1
    kind[ord("a") : ord("z") + 1] = 2
    kind[ord("A") : ord("Z") + 1] = 3
    kind[ord("0") : ord("9") + 1] = 4
    kind[0x80:] = 5
    for k, marks in enumerate((".,;:", "!?", "*#$%&", "|", "@/\\<>[]{}()_=+^~"), start=6):
        kind[[ord(c) for c in marks]] = k
    kind[ord("\n")] = 11
    return kind


KIND = _kinds()
CONTENT = KINDS + 7


def content(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(texts, CONTENT) figures."""
    n = len(at) - 1
    out = np.zeros((n, CONTENT))
    size = np.diff(at).astype(np.float64)
    row = np.repeat(np.arange(n), np.diff(at))
    if len(data):
        out[:, :KINDS] = np.bincount(row * KINDS + KIND[data], minlength=n * KINDS).reshape(n, KINDS) / np.maximum(size, 1)[:, None]
        s, e, owner = words(data, at)
        if len(s):
            h = word_hashes(data, s, e)
            count = np.bincount(owner, minlength=n).astype(np.float64)
            most = np.maximum(count, 1)
            again = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
            out[:, KINDS] = np.bincount(owner[1:][again], minlength=n) / most
            by = np.lexsort((h, owner))
            same = (h[by][1:] == h[by][:-1]) & (owner[by][1:] == owner[by][:-1])
            out[:, KINDS + 1] = np.bincount(owner[by][1:][same], minlength=n) / most
            out[:, KINDS + 2] = np.bincount(owner, weights=(e - s).astype(np.float64), minlength=n) / most / 10
            out[:, KINDS + 3] = np.bincount(owner[(e - s) == 1], minlength=n) / most
            tail = KIND[data[e - 1]]
            out[:, KINDS + 4] = np.bincount(owner[(tail == 7) | (tail == 8)], minlength=n) / most
            out[:, KINDS + 5] = np.log1p(count) / 10
    out[:, KINDS + 6] = np.sqrt(out[:, KINDS])  # even a few repeated words tell
    return out


def metadata(source: list, lang: list, n_chars: list) -> np.ndarray:
    """(documents, 2 * SLOTS + 2): hashed source and language, and the stated length."""
    out = np.zeros((len(source), 2 * SLOTS + 2))
    for i, (s, g, n) in enumerate(zip(source, lang, n_chars, strict=True)):
        out[i, zlib.crc32(repr(s).encode()) % SLOTS] = 1
        out[i, SLOTS + zlib.crc32(repr(g).encode()) % SLOTS] = 1
        out[i, -2] = np.log1p(max(0, n or 0)) / 10
        out[i, -1] = n is None
    return out


class Logistic:
    """Ridge logistic regression by Newton steps on standardised figures."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0):
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        z = np.hstack([(x - self.mean) / self.scale, np.ones((len(x), 1))])
        w, penalty = np.zeros(z.shape[1]), np.full(z.shape[1], ridge)
        penalty[-1] = 1e-6
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(penalty), z.T @ (p - y) + penalty * w)
            w -= step
            if np.abs(step).max() < 1e-7:
                break
        self.w = w

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.clip((x - self.mean) / self.scale, -20, 20) @ self.w[:-1] + self.w[-1], -30, 30)

    def chance(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def loss(chance: np.ndarray, y: np.ndarray) -> float:
    """Mean log loss."""
    p = np.clip(np.where(y == 1, chance, 1 - chance), 1e-9, 1)
    return float(-np.log(p).mean())


def fold_loss(x: np.ndarray, y: np.ndarray, folds: int = 4) -> float:
    """Loss of a logistic model over ``x`` on documents it was not fitted on; infinite where a fold lacks a kind."""
    out = np.zeros(len(y))
    for k in range(folds):
        test = np.arange(len(y)) % folds == k
        if len(np.unique(y[~test])) < 2:
            return float("inf")
        out[test] = Logistic(x[~test], y[~test].astype(float), 0.1).chance(x[test])
    return loss(out, y)


class CoTrained:
    """Both views, their calibration and their combination."""

    def __init__(self, views: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, rounds: int = 3, seed: int = 3):
        """views: figures of the labelled and of the pool, for each view; y: labels 0 and 1."""
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(y))
        apart, own = order[: len(y) // 4], order[len(y) // 4 :]
        if len(np.unique(y[apart])) < 2 or len(np.unique(y[own])) < 2:
            apart = own = order
        x = [v[0][own] for v in views]
        t = [y[own].astype(float)] * 2
        free = [np.ones(len(v[1]), bool) for v in views]
        models = [Logistic(a, b) for a, b in zip(x, t, strict=True)]
        for _ in range(rounds):
            for giver, taker in ((0, 1), (1, 0)):
                guess = loss(np.full(len(apart), y[apart].mean()), y[apart])
                if fold_loss(models[giver].margin(views[giver][0][apart])[:, None], y[apart]) > (1 - GAIN) * guess:
                    continue
                p = models[giver].chance(views[giver][1])
                for kind, sure in ((1.0, p), (0.0, 1 - p)):
                    some = np.flatnonzero(free[taker] & (sure >= CONFIDENT))
                    some = some[np.argsort(-sure[some], kind="stable")][: max(1, len(own) // 10)]
                    free[taker][some] = False
                    x[taker] = np.vstack([x[taker], views[taker][1][some]])
                    t[taker] = np.append(t[taker], np.full(len(some), kind))
            models = [Logistic(a, b) for a, b in zip(x, t, strict=True)]
        self.models = models
        held = [m.margin(v[0][apart])[:, None] for m, v in zip(models, views, strict=True)]
        self.calibrated = [Logistic(h, y[apart].astype(float), 0.1) for h in held]
        both = np.hstack([c.margin(h)[:, None] for c, h in zip(self.calibrated, held, strict=True)])
        self.joint = Logistic(both, y[apart].astype(float), 0.1)
        # which calibrated view is the quality by itself; None when both together lose less
        alone = [fold_loss(h, y[apart]) for h in held]
        guess = loss(np.full(len(apart), y[apart].mean()), y[apart])
        self.heard = None if fold_loss(both, y[apart]) < min(alone) - GAIN * guess else int(np.argmin(alone))

    def chances(self, views: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each view, calibrated, and of both."""
        margins = [c.margin(m.margin(v)[:, None]) for m, c, v in zip(self.models, self.calibrated, views, strict=True)]
        sides = [1 / (1 + np.exp(-m)) for m in margins]
        return *sides, self.joint.chance(np.stack(margins, axis=1)) if self.heard is None else sides[self.heard]


COLUMNS = ["doc_id", "text", "source", "lang", "n_chars"]


def _rows(docs: DataFrame) -> DataFrame:
    """The columns that are read; missing metadata columns are null."""
    has = set(docs.columns)
    kinds = {"doc_id": "long", "text": "string", "source": "string", "lang": "string", "n_chars": "long"}
    return docs.select(*[(F.col(c) if c in has else F.lit(None)).cast(kinds[c]).alias(c) for c in COLUMNS])


def _figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [content(data, at) for _, _, data, at in slices(b.column("text"))]
        view = np.vstack(found) if found else np.zeros((0, CONTENT))
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("good"), pa.array(list(view), pa.list_(pa.float64())), *[b.column(c) for c in ("source", "lang", "n_chars")]],
            ["doc_id", "good", "content", "source", "lang", "n_chars"])


def fit(docs: DataFrame, labels: DataFrame, labelled: int = 6_000, pool: int = 6_000) -> CoTrained | None:
    small_batches(docs.sparkSession)
    rows = _rows(docs)
    known = (labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("good"))
             .filter("_id is not null and good in (0, 1)").groupBy("_id").agg(F.max("good").alias("good")))
    hashed = known.withColumn("h", F.xxhash64("_id"))
    each = [hashed.filter(F.col("good") == k).orderBy("h", "_id").limit(labelled // 2) for k in (0, 1)]
    chosen = each[0].unionByName(each[1]).select("_id", "good")
    rest = (rows.select(F.col("doc_id").alias("_id")).filter("_id is not null").join(known, "_id", "left_anti")
            .distinct().orderBy(F.xxhash64("_id"), "_id").limit(pool).select("_id", F.lit(None).cast("int").alias("good")))
    sample = F.broadcast(chosen.unionByName(rest))  # at most labelled + pool rows
    one = rows.join(sample, rows.doc_id == sample["_id"]).groupBy("doc_id", "good").agg(
        F.min(F.struct("text", "source", "lang", "n_chars")).alias("one")).select("doc_id", "good", "one.*")
    found = one.mapInArrow(_figures, "doc_id long, good int, content array<double>, source string, lang string, n_chars long").toPandas()
    found = found.sort_values("doc_id", kind="stable")
    views = [np.array(found["content"].tolist()).reshape(-1, CONTENT),
             metadata(*[[None if x is None or x != x else x for x in found[c].tolist()] for c in ("source", "lang", "n_chars")])]
    marked = found["good"].notna().to_numpy()
    y = found["good"][marked].to_numpy(int)
    if len(np.unique(y)) < 2:
        return None
    return CoTrained([(v[marked], v[~marked]) for v in views], y)


def _chances(model: CoTrained, b: pa.RecordBatch, names: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found = [content(data, at) for _, _, data, at in slices(b.column(names[0]))]
    view = np.vstack(found) if found else np.zeros((0, CONTENT))
    return model.chances([view, metadata(*[b.column(c).to_pylist() for c in names[1:]])])


def _scorer(model: CoTrained | None) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [np.full(b.num_rows, 0.5)] * 3 if model is None else _chances(model, b, COLUMNS[1:])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(p) for p in parts], pa.array(parts[2] >= 0.5)],
                                             ["doc_id", "content_score", "metadata_score", "quality", "kept"])

    return score


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the calibrated score of each view, the quality from both, and whether the document is kept."""
    return _rows(docs).mapInArrow(_scorer(fit(docs, labels)),
                                  "doc_id long, content_score double, metadata_score double, quality double, kept boolean")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, columns as they came: one pass, no join."""
    model = fit(docs, labels)
    if model is None:
        return docs
    kinds = {"text": "string", "source": "string", "lang": "string", "n_chars": "long"}

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = _chances(model, b, list(kinds))[2] >= 0.5
            yield pa.RecordBatch.from_struct_array(b.column("row")).filter(pa.array(good))

    has = set(docs.columns)
    # a row travels as one struct: its own columns may have any name
    read = docs.select(whole_row(docs).alias("row"), *[(F.col(c) if c in has else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()])
    return read.mapInArrow(keep, docs.schema)
