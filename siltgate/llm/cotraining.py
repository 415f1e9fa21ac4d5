"""Quality classification by co-training a text view and a metadata view."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.llm.common import maybe_in
from siltgate.sources.staging import Staging

TEXT_DENSE = 4
META_WIDTH = 96
SIGNIFICANT = 10.8  # G squared of a token that is kept; chance exceeds it once in 1000
_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+")


def text_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a whole text's distinct words and signs, in rising order, and what they
    don't show: a constant, the share in capitals, of the commonest, of distinct ones."""
    counts = Counter(_TOKEN.findall(text))
    digest = xxhash.xxh32_intdigest
    hashed = {digest(t.lower().encode("utf-8", "surrogatepass")) & 0x7FFFFFFF for t in counts}
    total = max(sum(counts.values()), 1)
    upper = sum(n for t, n in counts.items() if t.isupper() and len(t) > 1)
    most = max(counts.values(), default=0)
    shares = [1.0, 4.0 * upper / total, 4.0 * most / total, -math.log((len(counts) + 1) / (total + 1))]
    return np.sort(np.fromiter(hashed, dtype=np.int32, count=len(hashed))), np.array(shares)


def meta_features(lang: str | None, source: str | None, n_chars: int | None, text: str) -> np.ndarray:
    """What a page says about itself and how it is laid out: language and source, hashed;
    length; its lines and words; shares of letter cases, digits and signs; repetition."""
    out = np.zeros(META_WIDTH, dtype=np.float32)
    out[0] = 1.0
    out[1 + xxhash.xxh32_intdigest(str(lang).encode()) % 15] = 1.0
    out[16 + xxhash.xxh32_intdigest(str(source).encode()) % 64] = 1.0
    words = text.split()
    n, count = max(len(text), 1), max(len(words), 1)
    ascii_bytes = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    classes = np.bincount(_CLASS[ascii_bytes], minlength=5) / n
    out[80] = math.log1p(len(text) if n_chars is None else n_chars) / 10
    out[81] = math.log1p(text.count("\n")) / 5
    out[82] = min(n / count, 40) / 10
    out[83:88] = np.minimum(classes * [4, 4, 4, 4, 1], 4)
    distinct = len(set(words)) / count
    out[88] = distinct
    out[89] = math.log(max(distinct, 1e-4)) / 4
    out[90] = float(count < 5)
    return out


def _classes() -> np.ndarray:
    """Byte classes: capitals, digits, sentence marks, other signs, all else."""
    table = np.full(256, 4)
    table[ord("A") : ord("Z") + 1] = 0
    table[ord("0") : ord("9") + 1] = 1
    for c in range(33, 127):
        if not chr(c).isalnum():
            table[c] = 2 if chr(c) in ".,;:'\"!?-" else 3
    return table


_CLASS = _classes()


class Logistic:
    """Logistic regression on sparse rows by AdaGrad, in a fixed order of rows."""

    def __init__(self, width: int, ridge: float = 1e-6, rate: float = 0.3, epochs: int = 6) -> None:
        self.weights = np.zeros(width)
        self._ridge, self._rate, self._epochs = ridge, rate, epochs

    def fit(self, rows: list, labels: np.ndarray, weights: np.ndarray) -> Logistic:
        squares = np.full(len(self.weights), 1e-3)
        order = np.random.default_rng(3)
        for _ in range(self._epochs):
            for i in order.permutation(len(rows)):
                index, value = rows[i]
                miss = weights[i] * (_sigmoid(self.weights[index] @ value) - labels[i])
                step = miss * value + self._ridge * self.weights[index]
                squares[index] += step * step
                self.weights[index] -= self._rate * step / np.sqrt(squares[index])
        return self

    def logits(self, rows: list) -> np.ndarray:
        return np.array([self.weights[index] @ value for index, value in rows])


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def calibrate(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Platt scaling: slope and offset of least log loss on held-out rows, by Newton
    steps; the targets are drawn in a little, as Platt has it."""
    good, bad = labels.sum(), len(labels) - labels.sum()
    if not good or not bad:
        return 1.0, 0.0
    target = np.where(labels > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    design = np.stack([logits, np.ones(len(logits))], axis=1)
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(design @ at)
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-4 * np.eye(2)
        at = at - np.linalg.solve(hessian, design.T @ (p - target) + 1e-4 * (at - [1.0, 0.0]))
    return float(at[0]), float(at[1])


@dataclass(frozen=True)
class Model:
    """Two views, their calibration, and how their calibrated log odds are combined."""

    words: np.ndarray
    text: np.ndarray
    meta: np.ndarray
    text_scale: tuple[float, float]
    meta_scale: tuple[float, float]
    joint: tuple[float, float, float]
    threshold: float

    def text_logit(self, hashed: np.ndarray, shares: np.ndarray) -> float:
        index, value = known_words(self.words, hashed, shares)
        return float(self.text[index] @ value)

    def score(self, text_logits: np.ndarray, meta_logits: np.ndarray) -> tuple[np.ndarray, ...]:
        a = self.text_scale[0] * text_logits + self.text_scale[1]
        b = self.meta_scale[0] * meta_logits + self.meta_scale[1]
        return _sigmoid(a), _sigmoid(b), _sigmoid(self.joint[0] * a + self.joint[1] * b + self.joint[2])


def known_words(words: np.ndarray, hashed: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A text's sparse row: its shares, and 1 for each of ``words`` that it has."""
    at = np.searchsorted(words, hashed)
    at = at[at < len(words)] if len(words) else at[:0]
    at = at[np.isin(words[at], hashed, assume_unique=False)] if len(at) else at
    index = np.concatenate([np.arange(TEXT_DENSE), TEXT_DENSE + np.unique(at)])
    return index, np.concatenate([shares, np.ones(len(index) - TEXT_DENSE)])


def telling_words(rows: list[np.ndarray], labels: np.ndarray, least: int = 3) -> np.ndarray:
    """Hashes, rising, whose presence tells good from bad rows by the G test."""
    hashed, inverse = np.unique(np.concatenate(rows), return_inverse=True)
    label = np.repeat(labels, [len(r) for r in rows])
    n = np.bincount(inverse, minlength=len(hashed)).astype(float)
    good = np.bincount(inverse, weights=label, minlength=len(hashed))
    all_good, every = labels.sum(), len(labels)
    g = np.zeros(len(hashed))
    for seen, total in ((good, all_good), (n - good, every - all_good)):
        for observed, margin in ((seen, n), (total - seen, every - n)):
            with np.errstate(divide="ignore", invalid="ignore"):
                part = observed * np.log(observed * every / (margin * total))
            g += 2 * np.where(observed > 0, part, 0)
    return hashed[(n >= least) & (g >= SIGNIFICANT)]


def _features(batch: pa.RecordBatch) -> tuple[list, list]:
    """Sparse rows of both views for the columns text, lang, source and n_chars."""
    text, meta = [], []
    all_meta = np.arange(META_WIDTH)
    columns = [batch[c].to_pylist() for c in ("text", "lang", "source", "n_chars")]
    for body, lang, source, n in zip(*columns, strict=True):
        text.append(text_features(body or ""))
        meta.append((all_meta, meta_features(lang, source, n, body or "")))
    return text, meta


FEATURES = "doc_id long, label double, held boolean, words array<int>, shares array<double>, meta array<float>"
POOLED = "key long, words array<int>, shares array<double>, meta array<float>"
JUDGED = "key long, p_text double, p_meta double"


def _lists(text: list, meta: list) -> list[pa.Array]:
    return [
        pa.array([t[0] for t in text], type=pa.list_(pa.int32())),
        pa.array([t[1] for t in text], type=pa.list_(pa.float64())),
        pa.array([m[1] for m in meta], type=pa.list_(pa.float32())),
    ]


def _feature_key(words: np.ndarray, meta: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(np.asarray(words).tobytes() + np.asarray(meta).tobytes()) - (1 << 63)


def train(
    docs: DataFrame,
    labels: DataFrame,
    staging: Staging | None = None,
    labelled_rows: int = 6_000,
    taught_rows: int = 500,
    rounds: int = 2,
    confident: float = 0.97,
) -> Model:
    """Fit both views on at most ``labelled_rows`` labelled rows, those of least hash of
    doc_id, a fifth of them held out, and on what they teach each other of all others.

    A good document has quality 1 and isn't toxic; of clashing labels of one doc_id the
    worst counts. The features of all documents without a label are stored once. In each
    round both views judge all of them; each view hands the ``taught_rows`` good and as
    many bad ones of which it is surest, and ``confident``, and which the other doesn't
    hold to be the opposite, to the other, which learns from them with half a true
    label's weight. Documents of the same features count
    once there; of equally sure ones the least hash goes first. The views are
    calibrated and combined on the held-out rows.
    """
    staging = staging or Staging.until_exit(docs.sparkSession)
    is_good = ((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)).cast("double")
    known = staging.table(
        labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("_labelled"))
        .agg(F.min(is_good).alias("label")),
        "known-labels",
    )
    all_docs = _slim(docs)
    trainer = CoTrainer(_frame(_labelled_sample(all_docs, known, labelled_rows)))
    model = trainer.model()
    if not trainer.ready:
        return model
    pool = staging.table(_unlabelled(all_docs, known, staging).mapInArrow(_pooled, POOLED), "unlabelled")
    for _ in range(rounds):
        judged = staging.table(_judge_pool(pool, model), "judged")
        views = ("p_text", "p_meta")
        lessons = [_surest(judged, v, o, taught_rows, confident) for v, o in (views, views[::-1])]
        keys = sorted({key for lesson in lessons for key in lesson})
        if not keys:
            break
        wanted = docs.sparkSession.createDataFrame([(k,) for k in keys], "key long")
        rows = pool.join(F.broadcast(wanted), "key").dropDuplicates(["key"]).toArrow()
        trainer.teach(rows, lessons)
        model = trainer.model()
    return model


def _labelled_sample(all_docs: DataFrame, known: DataFrame, labelled_rows: int) -> pa.Table:
    """Features of the chosen labelled rows, one row for each doc_id."""
    # Ids first, each once, so that no text takes part in choosing the rows and no id's
    # copies fill the limit.
    every = all_docs.select("doc_id").distinct()
    ids = every.join(known, F.col("doc_id").eqNullSafe(F.col("_labelled")))
    chosen = ids.select("doc_id", "label").orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled_rows)
    # Of the rows of one id the one of least hash: here once for each task, then once.
    row = F.xxhash64("text", "lang", "source", "n_chars")
    least = (
        all_docs.withColumn("_row", row)
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min("_row").alias("_row"))
    )

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            new = [i not in seen and not seen.add(i) for i in batch["doc_id"].to_pylist()]
            batch = batch.filter(pa.array(new, type=pa.bool_()))
            held = [xxhash.xxh32_intdigest(str(i), 5) % 5 == 0 for i in batch["doc_id"]]
            columns = [batch["doc_id"], batch["label"], pa.array(held, type=pa.bool_()), *_lists(*_features(batch))]
            yield pa.RecordBatch.from_arrays(
                columns, names=["doc_id", "label", "held", "words", "shares", "meta"]
            )

    return (
        all_docs.withColumn("_row", row)
        .join(F.broadcast(least), ["doc_id", "_row"])
        .select("doc_id", "text", "lang", "source", "n_chars", "label")
        .mapInArrow(make, FEATURES)
        .dropDuplicates(["doc_id"])
        .toArrow()
    )


def _unlabelled(all_docs: DataFrame, known: DataFrame, staging: Staging) -> DataFrame:
    """Rows without a label. A Bloom filter of the labels tells most of them; the ids that it
    holds back wrongly are found by ids alone and fetched through a filter of their own, so
    that hardly a text is shuffled."""
    marked = maybe_in(all_docs, "doc_id", known, "_labelled", known.count())
    held = marked.filter("_possible").drop("_possible")
    same = F.col("doc_id").eqNullSafe(F.col("_labelled"))
    ids = held.select("doc_id").distinct().join(known, same, "left_anti")
    ids = staging.table(ids.withColumnRenamed("doc_id", "_labelled"), "unlabelled-ids")
    back = maybe_in(held, "doc_id", ids, "_labelled", ids.count()).filter("_possible").drop("_possible")
    return marked.filter("NOT _possible").drop("_possible").union(back.join(ids, same, "left_semi"))


def _pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            text, meta = _features(batch.slice(at, 500))
            keys = [_feature_key(w, m) for (w, _), (_, m) in zip(text, meta, strict=True)]
            columns = [pa.array(keys, type=pa.int64()), *_lists(text, meta)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "words", "shares", "meta"])


def _judge_pool(pool: DataFrame, model: Model) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, shares, meta = (_views_of(batch[c]) for c in ("words", "shares", "meta"))
            a = np.array([model.text_logit(w, x) for w, x in zip(words, shares, strict=True)])
            b = np.array([model.meta @ m for m in meta])
            p_text, p_meta, _ = model.score(a, b)
            columns = [batch["key"], pa.array(p_text), pa.array(p_meta)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "p_text", "p_meta"])

    return pool.mapInArrow(run, JUDGED)


def _surest(judged: DataFrame, view: str, other: str, most: int, confident: float) -> dict[int, float]:
    """Keys of the pool's surest good and bad documents by one view, with their labels. What
    the other view holds against is not taught to it: metadata doesn't show everything."""
    out = {}
    for label, sure, held in (
        (1.0, F.col(view), F.col(other)), (0.0, 1 - F.col(view), 1 - F.col(other))
    ):
        told = judged.filter((sure >= confident) & (held >= 0.5)).select("key", sure.alias("sure"))
        first = told.groupBy("key").agg(F.max("sure").alias("sure"))
        rows = first.orderBy(F.desc("sure"), F.xxhash64("key"), "key").limit(most).collect()
        out |= {r["key"]: label for r in rows}
    return out


def _views_of(lists: pa.ListArray) -> list[np.ndarray]:
    """The lists as views of Arrow's own buffer, without a copy."""
    values, offsets = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    return [values[a - offsets[0] : b - offsets[0]] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _frame(sample: pa.Table) -> pd.DataFrame:
    """Rows whose lists are views of Arrow's buffers."""
    sample = sample.combine_chunks()
    kept = [c for c in sample.column_names if c not in ("words", "shares", "meta")]
    flat = sample.select(kept).to_pandas()
    parts = {c: [v for chunk in sample[c].chunks for v in _views_of(chunk)] for c in ("words", "shares", "meta")}
    return flat.assign(**{c: pd.Series(v, dtype=object) for c, v in parts.items()})


class CoTrainer:
    """Both views on rows of ``FEATURES``, and what each was taught by the other."""

    def __init__(self, sample: pd.DataFrame, threshold: float = 0.5) -> None:
        key = [_feature_key(w, m) for w, m in zip(sample["words"], sample["meta"], strict=True)]
        sample = sample.assign(_key=key).sort_values(["_key", "label"], ignore_index=True)
        self._threshold = threshold
        self._label = sample["label"].to_numpy(dtype=float)
        held = sample["held"].to_numpy(dtype=bool)
        self._fit, test = np.flatnonzero(~held), np.flatnonzero(held)
        self.ready = len(set(self._label[self._fit])) > 1
        if not self.ready:
            return
        hashed = [np.asarray(w, dtype=np.int32) for w in sample["words"]]
        self._words = telling_words([hashed[i] for i in self._fit], self._label[self._fit])
        self._views = self._rows(sample)
        self._judges = test if len(test) else self._fit
        self._taught: list[tuple[list, list[float]]] = [([], []), ([], [])]

    def _rows(self, frame: pd.DataFrame) -> tuple[list, list]:
        text = [
            known_words(self._words, np.asarray(w, dtype=np.int32), np.asarray(x))
            for w, x in zip(frame["words"], frame["shares"], strict=True)
        ]
        return text, [(np.arange(META_WIDTH), np.asarray(m)) for m in frame["meta"]]

    def teach(self, rows: pa.Table, lessons: list[dict[int, float]]) -> None:
        """Each view's lesson, labels by key, is what the other one learns from."""
        frame = _frame(rows).sort_values("key", ignore_index=True)
        views = self._rows(frame)
        for v, lesson in enumerate(lessons):
            mine = [i for i, key in enumerate(frame["key"]) if key in lesson]
            told = [lesson[key] for key in frame["key"] if key in lesson]
            self._taught[1 - v] = [views[1 - v][i] for i in mine], told

    def model(self) -> Model:
        """Views fitted on labels and lessons, calibrated and combined on held-out rows;
        without labels of both kinds all documents score one half or better and are
        kept."""
        if not self.ready:
            nothing = np.zeros(0, dtype=np.int32), np.zeros(TEXT_DENSE), np.zeros(META_WIDTH)
            return Model(*nothing, (1.0, 0.0), (1.0, 0.0), (0.5, 0.5, 0.0), self._threshold)
        models = [self._learn(0), self._learn(1)]
        label = self._label[self._judges]
        logits = [models[v].logits([self._views[v][i] for i in self._judges]) for v in (0, 1)]
        scales = [calibrate(x, label) for x in logits]
        odds = [s[0] * x + s[1] for s, x in zip(scales, logits, strict=True)]
        joint = _combine(odds[0], odds[1], label)
        return Model(self._words, models[0].weights, models[1].weights, scales[0], scales[1], joint, self._threshold)

    def _learn(self, v: int) -> Logistic:
        rows, told = self._taught[v]
        labels = np.concatenate([self._label[self._fit], told])
        weights = np.concatenate([np.ones(len(self._fit)), np.full(len(rows), 0.5)])
        width = (TEXT_DENSE + len(self._words), META_WIDTH)[v]
        return Logistic(width).fit([*[self._views[v][i] for i in self._fit], *rows], labels, weights)


def _combine(a: np.ndarray, b: np.ndarray, labels: np.ndarray) -> tuple[float, float, float]:
    """Weights of two views' log odds by logistic regression, drawn towards their mean."""
    design = np.stack([a, b, np.ones(len(a))], axis=1)
    at = prior = np.array([0.5, 0.5, 0.0])
    for _ in range(50):
        p = _sigmoid(design @ at)
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 0.5 * np.eye(3)
        at = at - np.linalg.solve(hessian, design.T @ (p - labels) + 0.5 * (at - prior))
    return tuple(float(x) for x in at)


def _slim(docs: DataFrame) -> DataFrame:
    """The columns of both views; one that is missing is NULL."""
    kinds = {"lang": "string", "source": "string", "n_chars": "long"}
    extra = [
        (F.col(c) if c in docs.columns else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()
    ]
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *extra
    )


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, p_text, p_meta, score, keep) of every row.

    The score is the probability that a document is good by both views together; it is
    kept at the model's threshold or more. A NULL text is empty, a missing language,
    source or length counts as none. NULL doc_ids and repeated rows are kept; an empty
    table gives no rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, scores in _judged(batches, model):
            columns = [part["doc_id"], *map(pa.array, scores)]
            yield pa.RecordBatch.from_arrays(
                columns, names=["doc_id", "p_text", "p_meta", "score", "keep"]
            )

    schema = "doc_id long, p_text double, p_meta double, score double, keep boolean"
    return _slim(docs).mapInArrow(run, schema)


def _judged(
    batches: Iterator[pa.RecordBatch], model: Model
) -> Iterator[tuple[pa.RecordBatch, tuple[np.ndarray, ...]]]:
    """Stretches of rows with (p_text, p_meta, score, keep)."""
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            text, meta = _features(part)
            a = np.array([model.text_logit(h, x) for h, x in text])
            b = np.array([model.meta[i] @ w for i, w in meta])
            p_text, p_meta, p = model.score(a, b)
            yield part, (p_text, p_meta, p, p >= model.threshold)


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the model keeps. A table without language, source or length
    has none of them; all its columns pass through."""

    names = docs.columns
    kinds = {"lang": "string", "source": "string", "n_chars": "long"}
    filled = docs.select("*", *[F.lit(None).cast(k).alias(c) for c, k in kinds.items() if c not in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, scores in _judged(batches, model):
            yield part.filter(pa.array(scores[3])).select(names)

    return filled.mapInArrow(run, docs.schema)
