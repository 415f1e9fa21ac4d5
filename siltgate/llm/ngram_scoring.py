"""Language-model scores by deleted interpolation of n-gram estimates."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.sources.staging import Staging

FOLDS, HELD_OUT, TUNING = 7, 2, 3
START, END = b"\t", b" "  # no word has a space
BUCKETS = 24
RATIO_STEP, RATIO_LOW, RATIO_BINS = 0.1, -8.0, 160  # log10 of an estimate over the unigram's

ASKED = (
    "piece string, low long, high long, tuning boolean, bucket int, words int, "
    "keys binary, counts binary"
)
ANSWERED = (
    "piece string, low long, high long, tuning boolean, bucket int, "
    "learnt binary, tuned binary, totals array<long>"
)

_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def fold_of(doc_id: int | None) -> int:
    """crc32 of the doc_id as text, modulo the folds; no doc_id counts as no text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS


def _folds(rows: pd.DataFrame) -> np.ndarray:
    """Ids come as whole numbers beside a flag: pandas would make doubles of longs among
    which there is a NULL."""
    pairs = zip(rows["doc_id"].tolist(), rows["named"].tolist(), strict=True)
    return np.array([fold_of(i if named else None) for i, named in pairs], dtype=int)


class Grams:
    """Words and word pairs of some texts: what is distinct, where it is, and how often it
    occurs in the texts that ``learn`` marks."""

    def __init__(self, texts: list[str], learn: np.ndarray) -> None:
        number: defaultdict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        get = number.__getitem__
        start, end = get(START), get(END)
        coded = []
        for text in texts:
            words = text.encode("utf-8", "surrogatepass").lower().split()
            ids = np.fromiter(map(get, words), dtype=np.int64, count=len(words))
            coded.append(np.concatenate([[start], ids, [end]]))
        self.lengths = np.array([len(c) - 1 for c in coded], dtype=np.int64)
        before = np.concatenate([c[:-1] for c in coded])
        after = np.concatenate([c[1:] for c in coded])
        hashed = np.array([xxhash.xxh64_intdigest(w) for w in number], dtype=np.uint64)
        pairs, self.pair_of = np.unique((before << 32) | after, return_inverse=True)
        self.first, self.second = pairs >> 32, pairs & 0xFFFFFFFF
        mixed = (hashed[self.first] * _C1) ^ (hashed[self.second] + _C2 + (hashed[self.first] >> np.uint64(7)))
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _C1
        self.keys = np.concatenate([hashed, mixed ^ (mixed >> np.uint64(32))])
        self.words = len(hashed)
        self.start, self.end = start, end
        # A word's count as a token, or of the start as a context: texts.
        counted = np.repeat(learn, self.lengths)
        tokens = np.bincount(after[counted], minlength=self.words)
        tokens[start] = int(learn.sum())
        in_pairs = np.bincount(self.pair_of[counted], minlength=len(pairs))
        self.counts = np.concatenate([tokens, in_pairs])

    def dealt(self, buckets: int) -> list[np.ndarray]:
        """Places of the keys of each bucket, in order."""
        bucket = (self.keys % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        return np.split(order, np.searchsorted(bucket[order], np.arange(1, buckets)))

    def counted(self, answers: pd.DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Counts (learnt, of those tuning) of the keys, from their buckets' answers."""
        places = self.dealt(buckets)
        learnt, tuned = (np.zeros(len(self.keys), dtype=np.int64) for _ in range(2))
        for b, x, y in zip(answers["bucket"], answers["learnt"], answers["tuned"], strict=True):
            learnt[places[b]], tuned[places[b]] = _unpacked(x), _unpacked(y)
        return learnt, tuned


def _parts(rows: pd.DataFrame) -> Iterator[tuple[bool, np.ndarray, pd.DataFrame]]:
    """Rows of the tuning fold and all others: (is it, which rows are learnt from, rows)."""
    folds = _folds(rows)
    for tuning in (False, True):
        mine = (folds == TUNING) == tuning
        if mine.any():
            yield tuning, folds[mine] != HELD_OUT, rows[mine]


def _requests(piece: str, rows: pd.DataFrame, buckets: int) -> Iterator[pd.DataFrame]:
    """The distinct keys and counts of rows, one row for each bucket of keys."""
    low, high = int(rows["row"].iloc[0]), int(rows["row"].iloc[-1])
    for tuning, learn, part in _parts(rows):
        grams = Grams(part["text"].tolist(), learn)
        made = []
        for b, take in enumerate(grams.dealt(buckets)):
            words = int((take < grams.words).sum())  # words come before pairs
            counts = grams.counts[take].astype("<u4").tobytes()
            made.append((piece, low, high, tuning, b, words, grams.keys[take].tobytes(), counts))
        yield pd.DataFrame(made, columns=[c.split()[0] for c in ASKED.split(", ")])


def _answers(rows: pd.DataFrame) -> pd.DataFrame:
    """Counts of one bucket's keys over all pieces, sent back in each piece's order."""
    keys = [np.frombuffer(k, dtype=np.uint64) for k in rows["keys"]]
    counts = [np.frombuffer(c, dtype="<u4").astype(np.int64) for c in rows["counts"]]
    distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    tuning_key = np.repeat(rows["tuning"].to_numpy(dtype=bool), [len(k) for k in keys])
    flat = np.concatenate(counts)
    learnt = np.bincount(inverse, weights=flat, minlength=len(distinct))
    tuned = np.bincount(inverse, weights=flat * tuning_key, minlength=len(distinct))
    is_word = np.concatenate([np.arange(len(k)) < w for k, w in zip(keys, rows["words"], strict=True)])
    # The start is a context, never a token.
    word = is_word & (np.concatenate(keys) != np.uint64(xxhash.xxh64_intdigest(START)))
    words = np.zeros(len(distinct), dtype=bool)
    words[inverse[word]] = True
    known = int((words & (learnt > 0)).sum())
    tokens, tuning = int(learnt[words].sum()), int(tuned[words].sum())
    distinct_left = int((words & (learnt - tuned > 0)).sum())
    edges = np.cumsum([0, *map(len, keys)])
    out = rows[["piece", "low", "high", "tuning", "bucket"]].copy()
    out["learnt"] = [_packed(learnt[inverse[a:b]]) for a, b in zip(edges, edges[1:], strict=False)]
    out["tuned"] = [_packed(tuned[inverse[a:b]]) for a, b in zip(edges, edges[1:], strict=False)]
    totals = np.zeros((len(out), 4), dtype=np.int64)
    totals[0] = known, tokens, tuning, distinct_left
    out["totals"] = totals.tolist()
    return out


def _packed(counts: np.ndarray) -> bytes:
    return zlib.compress(counts.astype("<i8").tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), dtype="<i8")


def context_bucket(counts: np.ndarray) -> np.ndarray:
    """0 for a context never seen, then one bucket for each power of two."""
    return np.minimum(np.where(counts > 0, np.log2(np.maximum(counts, 1)).astype(int) + 1, 0), BUCKETS - 1)


def _estimates(grams: Grams, counts: np.ndarray, tokens: int, distinct: int) -> tuple[np.ndarray, ...]:
    """Of each pair: its context's bucket, and the pair, word and uniform estimates."""
    context, word = counts[: grams.words][grams.first], counts[: grams.words][grams.second]
    pair = counts[grams.words :] / np.maximum(context, 1)
    uniform = np.full(len(pair), 1.0 / (distinct + 1))
    return context_bucket(context), pair, word / max(tokens, 1), uniform


def learn_weights(cells: pd.DataFrame, rounds: int = 100) -> np.ndarray:
    """Weights (pair, word, uniform) of each context bucket by expectation-maximisation.

    ``cells`` has held-out counts ``n`` by context bucket and by the binned ratios of
    the pair and the word estimate to the uniform one. A bucket without held-out counts
    gets the weights of all counts; without any, the three weigh the same.
    """

    def ratio(bins: pd.Series) -> np.ndarray:
        value = 10 ** (RATIO_LOW + RATIO_STEP * bins.to_numpy(dtype=float))
        return np.where(bins.to_numpy() < 0, 0.0, value)

    def fit(part: pd.DataFrame) -> np.ndarray:
        each = np.stack([ratio(part["pair"]), ratio(part["word"]), np.ones(len(part))], axis=1)
        n = part["n"].to_numpy(dtype=float)
        weights = np.full(3, 1 / 3)
        for _ in range(rounds):
            share = each * weights
            share *= (n / share.sum(axis=1))[:, None]
            weights = share.sum(axis=0) / n.sum()
        return np.maximum(weights, [0, 0, 1e-9]) / np.maximum(weights, [0, 0, 1e-9]).sum()

    overall = fit(cells) if len(cells) else np.full(3, 1 / 3)
    table = np.tile(overall, (BUCKETS, 1))
    for bucket, part in cells.groupby("bucket"):
        table[int(bucket)] = fit(part)
    table[0, 1:] = table[0, 1:] / table[0, 1:].sum()
    table[0, 0] = 0.0  # a context never seen has no pair estimate
    return table


def _located(docs: DataFrame, staging: Staging, docs_each: int) -> DataFrame:
    """(piece, row, doc_id, named, text): pieces are stretches of rows of one file, so that a
    later pass finds the same pieces again. Rows that don't come from files are stored.
    A row without a doc_id isn't ``named`` and has a zero in its place."""
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit(""))
    named = doc_id.isNotNull().alias("named")
    slim = [F.coalesce(doc_id, F.lit(0)).alias("doc_id"), named, text.alias("text")]
    row = F.col("_metadata.row_index").alias("row")
    piece = F.concat_ws("#", "_metadata.file_path", F.floor(F.col("_metadata.row_index") / docs_each))
    try:
        return docs.select(piece.alias("piece"), row, *slim)
    except AnalysisException:
        stored = staging.table(docs.select(*slim), "ngram-rows")
        return stored.select(piece.alias("piece"), row, "doc_id", "named", "text")


def score_documents(
    docs: DataFrame, staging: Staging, piece_mb: int = 10, bucket_mb: int = 8
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row.

    Tokens are a text's words, A-Z lower-cased, and one end. All rows but the held-out
    fold are learnt from. The model mixes the maximum-likelihood estimates of the word
    pair and of the word with a uniform one, by weights of the context's frequency
    bucket. The weights are learned on the deleted fold ``TUNING``: its counts are
    held out of the estimates while the weights are fitted, and learnt from afterwards.

    Rows are taken in pieces of about ``piece_mb`` of text. A piece asks for the counts
    of its distinct words and pairs, by 64-bit hashes packed into one row for each
    bucket of hashes, and says how often it has them itself; a bucket, of the keys of
    about ``bucket_mb`` of text, adds up all pieces and answers each in its own order.
    So a piece asks once for a pair however often it occurs, and hot words are one key
    of each piece. Collected are sums and the held-out counts by frequency bucket and
    binned ratios, whose number is fixed.

    A NULL text is empty: its only token is the end. A NULL doc_id is hashed as no text,
    repeated rows each count, an empty table gives no rows; other columns are ignored.
    """
    length = F.coalesce(F.sum(F.octet_length("text")), F.lit(0))
    rows, mb = docs.agg(F.count(F.lit(1)), length / 1e6).first()
    docs_each = int(min(6_000, max(1, piece_mb * rows / max(mb, 1e-6))))
    buckets = max(1, int(mb / bucket_mb))
    dealt = _located(docs, staging, docs_each)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            for piece, part in batch.groupby("piece", sort=False):
                if held and held[0]["piece"].iloc[0] != piece:
                    yield from _requests(held[0]["piece"].iloc[0], pd.concat(held), buckets)
                    held = []
                held.append(part)
        if held:
            yield from _requests(held[0]["piece"].iloc[0], pd.concat(held), buckets)

    answered = staging.table(
        dealt.mapInPandas(ask, ASKED).groupBy("bucket").applyInPandas(_answers, ANSWERED),
        "ngram-counts",
    )
    known, tokens, tuning, left = (
        int(x or 0) for x in answered.agg(*[F.sum(F.col("totals")[i]) for i in range(4)]).first()
    )
    answers = answered.drop("totals")

    def looked_up(
        rows: pd.DataFrame, answers: pd.DataFrame
    ) -> Iterator[tuple[pd.DataFrame, Grams, np.ndarray, np.ndarray]]:
        """The parts that a piece had when it asked, with their counts."""
        rows = rows.sort_values("row")
        for (low, high, tuned_part), mine in answers.groupby(["low", "high", "tuning"]):
            for is_tuning, learn, part in _parts(rows[rows["row"].between(low, high)]):
                if is_tuning == tuned_part:
                    grams = Grams(part["text"].tolist(), learn)
                    yield part, grams, *grams.counted(mine, buckets)

    def held_out(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        names = ["bucket", "pair", "word", "n"]
        cells = [pd.DataFrame({c: [] for c in names}).astype(int)]
        for _, grams, learnt, tuned in looked_up(rows, answers):
            bucket, pair, word, uniform = _estimates(grams, learnt - tuned, tokens - tuning, left)
            n = grams.counts[grams.words :]
            seen = (bucket, _bins(pair / uniform), _bins(word / uniform), n)
            cells.append(
                pd.DataFrame(dict(zip(names, seen, strict=True))).groupby(names[:3], as_index=False).sum()
            )
        return pd.concat(cells)

    tuning_rows = dealt.filter(F.pmod(F.crc32(_id_text()), F.lit(FOLDS)) == TUNING)
    cells = (
        tuning_rows.groupBy("piece")
        .cogroup(answers.filter("tuning").groupBy("piece"))
        .applyInPandas(held_out, "bucket int, pair int, word int, n long")
        .groupBy("bucket", "pair", "word")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    weights = learn_weights(cells.sort_values(["bucket", "pair", "word"], ignore_index=True))

    def score(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for part, grams, learnt, _ in looked_up(rows, answers):
            bucket, pair, word, uniform = _estimates(grams, learnt, tokens, known)
            w = weights[bucket]
            model = np.log10(w[:, 0] * pair + w[:, 1] * word + w[:, 2] * uniform)
            count = learnt[: grams.words][grams.second]
            base = np.log10((count + 1) / (tokens + known + 1))
            at = np.concatenate([[0], np.cumsum(grams.lengths)[:-1]])
            sums = [np.add.reduceat(x[grams.pair_of], at) for x in ((count > 0).astype(int), base, model)]
            folds = _folds(part)
            out.append(
                pd.DataFrame(
                    {
                        "doc_id": part["doc_id"].to_numpy(),
                        "named": part["named"].to_numpy(),
                        "held_out": [f == HELD_OUT for f in folds],
                        "n_tokens": grams.lengths,
                        "n_known": sums[0],
                        "train_tokens": tokens,
                        "base_score": sums[1],
                        "score": sums[2],
                    }
                )
            )
        return pd.concat(out, ignore_index=True)

    return (
        dealt.groupBy("piece")
        .cogroup(answers.groupBy("piece"))
        .applyInPandas(
            score,
            "doc_id long, named boolean, held_out boolean, n_tokens long, n_known long, "
            "train_tokens long, base_score double, score double",
        )
        .withColumn("doc_id", F.when(F.col("named"), F.col("doc_id")))
        .drop("named")
    )


def _bins(ratio: np.ndarray) -> np.ndarray:
    """Bin of a ratio's log10; -1 for zero."""
    with np.errstate(divide="ignore"):
        at = np.rint((np.log10(ratio) - RATIO_LOW) / RATIO_STEP)
    return np.where(ratio > 0, np.clip(at, 0, RATIO_BINS - 1), -1).astype(int)


def _id_text() -> F.Column:
    return F.when(F.col("named"), F.col("doc_id").cast("string")).otherwise("").cast("binary")
