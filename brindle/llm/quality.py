"""Quality by Bradley-Terry ranking: scores are learned from preference pairs, then cut at a score quantile.

Each pair is a document that was labelled good and one that was labelled bad. The chance that the first is preferred
is the logistic function of the difference of their scores, and scores are linear in features of the whole text; the
logistic loss on feature differences is minimised by Newton steps. The pairs fix scores up to their zero. The cut is a
quantile of the learning rows' scores, and the published score puts it at a given value.

Every labelled document that is not held out is learned from. Documents are dealt into blocks by a hash of their id and
paired inside them, each with `PAIRS_PER_DOCUMENT` others at least; a class with too few documents for all blocks enters
several. Gradient and curvature are summed over the blocks on the executors, a job for each Newton step, and the quantile
is found from running totals over all learning rows' scores.

Features come from the text alone. NULL and empty texts have all features at zero and get a score like any other. With
no labels, or one class only, every score is 0.5. Repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.llm.joining import packed, split_by
from brindle.llm.training import held_out, learning_labels
from brindle.llm.words import Words, slices, split
from brindle.operators.ordering import running_total
from brindle.session import materialize, scratch_of_its_own

PAIRS_PER_DOCUMENT = 20  # preference pairs that each learning document enters at least
BLOCK = 8_192  # learning documents of the larger class that are paired inside one block, about
LEAST = 64  # documents of the smaller class in a block, about, if there are so many
NEWTON_STEPS = 30
SEED = 11
AT_A_TIME = 16_384  # pairs whose differences are held at once
RIDGE = 1e-3
STEEPNESS = 1.0  # of the published score, per unit of the Bradley-Terry score

#: Character classes whose share of the bytes is a feature.
CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "stop": b".", "comma": b",;:", "loud": b"!?",
    "bars": b"|", "signs": b"#$%&*@^~+=", "brackets": b"<>{}[]\\/_", "quotes": b"'\"()`", "lines": b"\n", "blank": b" \t",
}
_CLASS = np.full(256, len(CLASSES), dtype=np.int64)
for _k, _members in enumerate(CLASSES.values()):
    _CLASS[list(_members)] = _k
WIDTH = 3 * (len(CLASSES) + 1) + 9


def _shares(text: bytes) -> np.ndarray:
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    return np.bincount(_CLASS, weights=counts, minlength=len(CLASSES) + 1) / max(1, len(text))


def _word_features(words: Words, t: int) -> list[float]:
    own = words.of(t)
    n = len(own)
    if not n:
        return [0.0] * 9
    lengths = words.end[words.first[t] : words.first[t + 1]] - words.start[words.first[t] : words.first[t + 1]]
    _, counts = np.unique(own, return_counts=True)
    share = counts / n
    same = float(np.mean(own[1:] == own[:-1])) if n > 1 else 0.0
    pairs = np.unique(own[1:] * np.uint64(0x9E3779B97F4A7C15) + own[:-1]) if n > 1 else own
    return [
        np.log1p(n), lengths.mean() / 10, lengths.std() / 10, len(counts) / n, share.max(), same,
        np.log1p(1000 * same) / 7, -float(np.sum(share * np.log(share))) / max(1.0, np.log(n)), len(pairs) / n,
    ]


def features(texts: list[bytes | None]) -> np.ndarray:
    """One row of WIDTH numbers per whole text."""
    words = split(texts)
    out = np.zeros((len(texts), WIDTH))
    for t, text in enumerate(texts):
        if text:
            shares = _shares(text)
            out[t] = [*shares, *np.log1p(1000 * shares) / 7, *(shares > 0.02), *_word_features(words, t)]
    return out


@dataclass
class Model:
    """`score = logistic(steepness * (weights . (x - mean) / spread - cut) + logit(at))`."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    cut: float
    at: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.spread * self.weights).sum(1)  # by row, whatever the batch

    def score(self, x: np.ndarray) -> np.ndarray:
        margin = STEEPNESS * (self.raw(x) - self.cut) + np.log(self.at / (1 - self.at))
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def _pair_sums(
    better: np.ndarray, worse: np.ndarray, pairs: tuple[np.ndarray, np.ndarray], weights: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the logistic loss, summed over AT_A_TIME pairs after the other."""
    first, second = pairs
    gradient, curve = np.zeros(len(weights)), np.zeros((len(weights), len(weights)))
    for at in range(0, len(first), AT_A_TIME):
        diff = better[first[at : at + AT_A_TIME]] - worse[second[at : at + AT_A_TIME]]
        chance = 1 / (1 + np.exp(-np.clip(diff @ weights, -30, 30)))
        gradient -= (1 - chance) @ diff
        curve += (diff * (chance * (1 - chance))[:, None]).T @ diff
    return gradient, curve


def _newton(
    sums: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], pairs: int, width: int, ridge: float = RIDGE, steps: int = NEWTON_STEPS
) -> np.ndarray:
    """Weights that minimise the mean loss over `pairs` pairs, with a ridge; `sums` gives gradient and curvature."""
    weights = np.zeros(width)
    for _ in range(steps):
        gradient, curve = sums(weights)
        step = np.linalg.solve(curve / pairs + ridge * np.eye(width), gradient / pairs + ridge * weights)
        weights = weights - step * min(1.0, 4.0 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-6:
            break
    return weights


def learn_pairs(
    better: np.ndarray, worse: np.ndarray, ridge: float = RIDGE, steps: int = NEWTON_STEPS,
    pairs: tuple[np.ndarray, np.ndarray] | None = None,
) -> np.ndarray:
    """Weights that minimise the mean logistic loss on the differences `better - worse`, with a ridge.

    `pairs` are the rows of `better` and of `worse` that are compared, without it the first with the first and so on.
    """
    pairs = pairs or (np.arange(len(better)), np.arange(len(worse)))
    return _newton(lambda weights: _pair_sums(better, worse, pairs, weights), len(pairs[0]), better.shape[1], ridge, steps)


def _pairs(good: int, bad: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of the two classes; each row is in PAIRS_PER_DOCUMENT of them at least, in as many as its like."""
    n = PAIRS_PER_DOCUMENT * (good + bad) if good and bad else 0
    rng = np.random.default_rng(seed)

    def dealt(rows: int) -> np.ndarray:
        rounds = [rng.permutation(rows) for _ in range(-(-n // max(1, rows)))]
        return np.concatenate([np.empty(0, np.int64), *rounds])[:n]

    return dealt(good), dealt(bad)


def best_quantile(scores: np.ndarray, good: np.ndarray) -> float:
    """The score at the quantile that tells the classes apart best, with both classes counted alike.

    The cut lies half-way into the gap above that quantile's score.
    """
    order = np.argsort(scores, kind="stable")
    ranked, is_good = scores[order], good[order]
    below_bad = np.concatenate([[0], np.cumsum(~is_good)]) / max(1, (~is_good).sum())
    below_good = np.concatenate([[0], np.cumsum(is_good)]) / max(1, is_good.sum())
    gain = below_bad - below_good
    best = np.flatnonzero(gain >= gain.max() - 1e-9)
    quantile = int(best[len(best) // 2])
    low = ranked[max(0, quantile - 1)]
    high = ranked[min(quantile, len(ranked) - 1)]
    return float((low + high) / 2)


def fit(x: np.ndarray, good: np.ndarray, at: float, seed: int = SEED) -> Model | None:
    """A model from features in memory, as one block; None if only one class is there."""
    good = good.astype(bool)
    if not good.any() or good.all():
        return None
    mean, spread = x.mean(0), x.std(0)
    spread = np.where(spread > 1e-9, spread, 1.0)
    z = (x - mean) / spread
    weights = learn_pairs(z[good], z[~good], pairs=_pairs(int(good.sum()), int((~good).sum()), seed))
    return Model(mean, spread, weights, best_quantile(z @ weights, good), at)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, texts in slices(batches, "text"):
        x = pa.array(list(features(texts)), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("key"), x], names=["doc_id", "key", "x"])


def learning_rows(docs: DataFrame, labels: DataFrame, label: str, modulus: int, keep_out: int) -> DataFrame:
    """doc_id, label and features x of every document to learn from; features are worked out before anything moves.

    However often rows repeat an id, one text enters for it: the one with the least hash.
    """
    clean = learning_labels(labels, label, modulus, keep_out).withColumn("label", F.col("label").cast("int"))
    texts = split_by(docs.select("doc_id", "text"), clean, "doc_id")[0].select("doc_id", F.xxhash64("text").alias("key"), "text")
    schema = T.StructType([texts.schema["doc_id"], T.StructField("key", T.LongType()), T.StructField("x", T.ArrayType(T.DoubleType()))])
    one = F.min(F.struct("key", "x")).alias("_one")
    return texts.mapInArrow(_features, schema).join(clean, "doc_id").groupBy("doc_id", "label").agg(one).select("doc_id", "label", "_one.x")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)


def _summed(df: DataFrame, of_batch: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """The sum of `of_batch` over the whole table; one vector for each task reaches the driver."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum((of_batch(batch) for batch in batches if batch.num_rows), np.zeros(1))
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["total"])

    totals = df.mapInArrow(of_task, "total array<double>").toArrow().column("total")
    return sum((np.array(total) for total in totals.to_pylist()), np.zeros(1))


def _blocked(rows: DataFrame, good: int, bad: int, mean: np.ndarray, spread: np.ndarray) -> DataFrame:
    """A row for each block: the scaled features of its good and of its bad documents, as matrices in bytes."""
    blocks = -(-max(good, bad) // BLOCK)
    copies = min(blocks, -(-LEAST * blocks // min(good, bad)))
    turns = F.when(F.col("label") == int(good < bad), F.sequence(F.lit(0), F.lit(copies - 1))).otherwise(F.array(F.lit(0)))
    dealt = rows.withColumn("_turn", F.explode(turns)).select(
        F.pmod(F.pmod(F.xxhash64("doc_id"), F.lit(blocks)) + F.col("_turn"), F.lit(blocks)).alias("block"), "label", "x")

    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        z = (_matrix(table.column("x").combine_chunks()) - mean) / spread
        y = table.column("label").to_numpy()
        z, y = z[order := np.lexsort(z.T)], y[order]  # the order of arrival is not fixed
        return pa.table({"block": [key[0].as_py()], "good": [z[y == 1].tobytes()], "bad": [z[y == 0].tobytes()]})

    return dealt.groupBy("block").applyInArrow(pack, "block bigint, good binary, bad binary")


def _of_blocks(batch: pa.RecordBatch, weights: np.ndarray) -> np.ndarray:
    """Number of pairs, gradient and curvature of some blocks, one after the other in one vector."""
    out = np.zeros(1 + WIDTH + WIDTH * WIDTH)
    for row in batch.to_pylist():
        good, bad = (np.frombuffer(row[k]).reshape(-1, WIDTH) for k in ("good", "bad"))
        pairs = _pairs(len(good), len(bad), SEED + row["block"])
        gradient, curve = _pair_sums(good, bad, pairs, weights)
        out += np.concatenate([[len(pairs[0])], gradient, curve.ravel()])
    return out


def _best_cut(scored: DataFrame, good: int, bad: int) -> float:
    """What `best_quantile` gives, between different scores, from running totals over all of them."""
    is_good = F.col("label").cast("bigint")
    tallies = scored.groupBy("score").agg(F.sum((1 - is_good) * good - is_good * bad).alias("_step"))
    totals = running_total(tallies, [], [F.col("score")], F.col("_step"), "_before")
    placed = materialize(totals.select("score", (F.col("_before") + F.col("_step")).alias("gain")), "gains")
    most, least = placed.agg(F.max("gain"), F.min("score")).first()
    if most <= 0:
        return float(least)
    best = placed.where(F.col("gain") >= most - int(1e-9 * good * bad)).select("score")
    low = best.orderBy("score").offset(best.count() // 2).first()["score"]
    high = placed.where(F.col("score") > low).agg(F.min("score")).first()[0]
    return float((low + (low if high is None else high)) / 2)


def train(docs: DataFrame, labels: DataFrame, label: str, modulus: int, keep_out: int, at: float) -> Model | None:
    """A model from every document to learn from; None if only one class is there. Sums of WIDTH numbers reach the driver."""
    spark = docs.sparkSession
    with scratch_of_its_own(spark):
        rows = materialize(learning_rows(docs, labels, label, modulus, keep_out), "learning")
        sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
        good, bad = sizes.get(1, 0), sizes.get(0, 0)
        if not good or not bad:
            return None
        mean = _summed(rows, lambda batch: _matrix(batch.column("x")).sum(0)) / (good + bad)
        spread = np.sqrt(_summed(rows, lambda batch: np.square(_matrix(batch.column("x")) - mean).sum(0)) / (good + bad))
        spread = np.where(spread > 1e-9, spread, 1.0)
        blocks = materialize(_blocked(rows, good, bad, mean, spread), "blocks")
        pairs = PAIRS_PER_DOCUMENT * (good + bad)  # about; the sums tell how many there are

        def sums(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            total = _summed(blocks, lambda batch: _of_blocks(batch, weights))
            total[1:] *= pairs / total[0]
            return total[1 : 1 + WIDTH], total[1 + WIDTH :].reshape(WIDTH, WIDTH)

        model = Model(mean, spread, _newton(sums, pairs, WIDTH), 0.0, at)

        def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    score = pa.array(model.raw(_matrix(batch.column("x"))), pa.float64())
                    yield pa.RecordBatch.from_arrays([batch.column("label"), score], names=["label", "score"])

        scored = materialize(rows.select("label", "x").mapInArrow(raw, "label int, score double"), "scored")
        model.cut = _best_cut(scored, good, bad)
        return model


def _scores(batches: Iterator[pa.RecordBatch], path: str, keep: str, model: Model | None) -> Iterator[pa.RecordBatch]:
    for rows, texts in slices(batches, path):
        score = model.score(features(texts)) if model else np.full(len(texts), 0.5)
        yield pa.RecordBatch.from_arrays([rows.column(keep), pa.array(score, pa.float64())], names=[keep, "score"])


def with_score(rows: DataFrame, path: str, keep: str, model: Model | None) -> DataFrame:
    """The column `keep`, and `score` of the text at `path`."""
    schema = T.StructType([rows.schema[keep], T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(lambda batches: _scores(batches, path, keep, model), schema)


def scores(docs: DataFrame, labels: DataFrame, label: str, modulus: int, keep_out: int, at: float) -> DataFrame:
    """doc_id, held_out, score and predicted (score >= `at`) of every document."""
    model = train(docs, labels, label, modulus, keep_out, at)
    return with_score(docs.select("doc_id", "text"), "text", "doc_id", model).select(
        "doc_id", held_out("doc_id", modulus, keep_out).alias("held_out"), "score",
        (F.col("score") >= at).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, label: str, modulus: int, keep_out: int, at: float) -> DataFrame:
    """The rows whose score reaches `at`, with their columns."""
    model = train(docs, labels, label, modulus, keep_out, at)
    return with_score(packed(docs).select("row"), "row.text", "row", model).where(F.col("score") >= at).select("row.*")
