"""Toxicity by a small convolutional network over words, trained in numpy.

Words, and the beginnings of longer words, are hashed to embeddings, whose sum stands for the word; filters of several widths slide over the whole text, each filter's largest answer is
kept, and a logistic layer turns these into one number. The network learns from a bounded, balanced sample.
Its threshold is then calibrated by language: within each language, told by its function words, the score is
shifted so that the threshold which parts the classes best on rows not used for the weights lands at one fixed value.

Only the text is read. NULL and empty texts are scored as a text without words. With no labels, or one class only,
every score is 0. Repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.training import held_out, labelled_sample
from brindle.llm.words import Words, mixed, slices, split

PER_CLASS = 2_500  # labelled documents of each class to learn from
MOST_WORDS = 8_000_000  # of a class; a sampled text with which its class would have more is not learned from
BUCKETS = 1 << 23  # a word's hash modulo this is its bucket
MOST_ROWS = 60_000  # buckets with an embedding of their own: those in most learning documents
MIN_DOCUMENTS = 3  # learning documents a bucket must occur in, else it shares the row of unknown words
STEMS = (4, 6)  # bytes of a word's beginning that have a bucket of their own, so that inflected forms share one
SIZE, FILTERS, WIDTHS = 8, 8, (1, 2, 3)
PAD = max(WIDTHS) - 1
EPOCHS, BATCH = 12, 64
LEAST = 15  # documents of each class that a language needs for a threshold of its own

#: Function words by which a text's language is told. Fixed values.
FUNCTION_WORDS = {
    "en": "the of and to in is that for it as with was on are this",
    "de": "der die und das den von zu mit sich des auf ist nicht dem ein",
    "fr": "le la les et des du une est que pour dans qui au sur pas",
    "es": "el los las y del se por con una para su al lo como que",
}
LANGUAGES = [*FUNCTION_WORDS, "other"]
_MARKS = {k: np.sort(split([v]).hash) for k, v in FUNCTION_WORDS.items()}


def languages(words: Words) -> np.ndarray:
    """Index into LANGUAGES of each text: the language most of whose function words it uses."""
    bounds = words.first
    votes = np.zeros((len(bounds) - 1, len(LANGUAGES)))
    for k, marks in enumerate(_MARKS.values()):
        at = np.searchsorted(marks, words.hash)
        hit = marks[np.minimum(at, len(marks) - 1)] == words.hash
        total = np.concatenate([[0], np.cumsum(hit)])
        votes[:, k] = total[bounds[1:]] - total[bounds[:-1]]
    votes[:, -1] = 0.5
    return votes.argmax(1)


def _buckets(words: Words) -> np.ndarray:
    """A row per word: its bucket, and those of its beginnings, -1 where it is no longer than that."""
    out = np.empty((len(words.hash), 1 + len(STEMS)), dtype=np.int32)
    out[:, 0] = words.hash % np.uint64(BUCKETS)
    codes = np.frombuffer(words.text, dtype=np.uint8)
    length = words.end - words.start
    for k, size in enumerate(STEMS, 1):
        long = np.flatnonzero(length > size)
        value = np.full(len(long), size, dtype=np.uint64)
        for j in range(size):
            value = value * np.uint64(256) + codes[words.start[long] + j]
        out[:, k] = -1
        out[long, k] = mixed(value) % np.uint64(BUCKETS)
    return out


def _laid_out(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of all texts one after the other, each followed by PAD empty places, and where each text begins."""
    gap = np.zeros((PAD, 1 + len(STEMS)), dtype=np.uint16)
    starts = np.cumsum([0] + [len(r) + PAD for r in rows])[:-1]
    return np.concatenate([x for r in rows for x in (r, gap)]), starts


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    """Row 0 of `embedding` is for padding and unknown words, and stays zero."""

    buckets: np.ndarray  # bucket of rows 1, 2, ...
    embedding: np.ndarray
    filters: dict[int, np.ndarray]  # width -> (width, SIZE, FILTERS)
    bias: dict[int, np.ndarray]
    out: np.ndarray
    offset: float = 0.0
    shift: np.ndarray = field(default_factory=lambda: np.zeros(len(LANGUAGES)))
    _row: np.ndarray | None = None

    def rows(self, buckets: np.ndarray) -> np.ndarray:
        """The embedding rows of buckets; 0 where a bucket has none."""
        if self._row is None:
            self._row = np.zeros(BUCKETS + 1, dtype=np.uint16)  # the last place is that of bucket -1
            self._row[self.buckets] = np.arange(1, len(self.buckets) + 1)
        return self._row[buckets]

    def margins(self, words: Words) -> np.ndarray:
        """Log odds of each text before calibration."""
        found = self.rows(_buckets(words))
        rows, starts = _laid_out([found[words.first[t] : words.first[t + 1]] for t in range(len(words.first) - 1)])
        reach = len(rows)
        vectors = self.embedding.astype(np.float32)
        x = np.zeros((reach + PAD, SIZE), dtype=np.float32)
        for column in rows.T:
            x[:reach] += vectors[column]
        pooled = []
        for w in WIDTHS:
            total = x[:reach] @ self.filters[w][0].astype(np.float32)
            for k in range(1, w):
                total += x[k : k + reach] @ self.filters[w][k].astype(np.float32)
            best = np.maximum.reduceat(total, starts, axis=0) + self.bias[w]
            pooled.append(np.maximum(best, 0))
        return (np.concatenate(pooled, axis=1) * self.out).sum(1) + self.offset  # by row, whatever the batch

    def score(self, words: Words) -> np.ndarray:
        return _sigmoid(self.margins(words) + self.shift[languages(words)])


class _Adam:
    def __init__(self, shape, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(shape), np.zeros(shape), 0, rate

    def step(self, x: np.ndarray, gradient: np.ndarray) -> None:
        self.t += 1
        self.m += 0.1 * (gradient - self.m)
        self.v += 0.001 * (gradient**2 - self.v)
        x -= self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)


def _vocabulary(texts: list[np.ndarray], toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that get a row, and their smoothed log odds between the classes."""
    seen = [np.unique(t[t >= 0]) for t in texts]
    by_class = []
    for value in (False, True):
        ids, counts = np.unique(np.concatenate([s for s, y in zip(seen, toxic) if y == value]), return_counts=True)
        by_class.append(dict(zip(ids.tolist(), counts.tolist())))
    total = {b: by_class[0].get(b, 0) + by_class[1].get(b, 0) for b in by_class[0].keys() | by_class[1].keys()}
    chosen = sorted((b for b, n in total.items() if n >= MIN_DOCUMENTS), key=lambda b: (-total[b], b))[:MOST_ROWS]
    n0, n1 = max(1, (~toxic).sum()), max(1, toxic.sum())
    odds = [np.log((by_class[1].get(b, 0) + 1) / (n1 + 2)) - np.log((by_class[0].get(b, 0) + 1) / (n0 + 2)) for b in chosen]
    return np.array(chosen, dtype=np.int64), np.array(odds)


def train_network(texts: list[np.ndarray], toxic: np.ndarray, seed: int = 5, epochs: int = EPOCHS) -> Network:
    """Weights from the buckets of texts' words and their labels, by Adam on the logistic loss.

    The first number of a word's embedding starts at its log odds, the others small and random.
    """
    rng = np.random.default_rng(seed)
    buckets, odds = _vocabulary(texts, toxic)
    embedding = rng.normal(0, 0.05, (len(buckets) + 1, SIZE))
    embedding[1:, 0] = np.clip(odds, -4, 4) / 2 / (1 + len(STEMS))
    embedding[0] = 0
    filters = {w: rng.normal(0, 0.1, (w, SIZE, FILTERS)) for w in WIDTHS}
    for w in WIDTHS:
        filters[w][:, 0, :] += rng.uniform(0.3, 1.0, (w, FILTERS)) / w
    bias = {w: np.full(FILTERS, -0.1) for w in WIDTHS}
    out = rng.uniform(0.1, 0.4, FILTERS * len(WIDTHS))
    net = Network(buckets, embedding, filters, bias, out, -1.0)
    rows = [net.rows(t) for t in texts]
    target = toxic.astype(float)
    tune = {
        "out": _Adam(out.shape, 0.02), "embedding": _Adam(embedding.shape, 0.01),
        **{("f", w): _Adam(filters[w].shape, 0.01) for w in WIDTHS}, **{("b", w): _Adam(FILTERS, 0.01) for w in WIDTHS},
        "offset": _Adam(1, 0.02),
    }
    offset = np.array([net.offset])
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            flat, starts = _laid_out([rows[i] for i in some])
            flat = np.concatenate([flat, np.zeros((PAD, 1 + len(STEMS)), dtype=np.uint16)])
            reach = len(flat) - PAD
            x = embedding[flat].sum(1)
            lengths = np.diff(np.append(starts, reach))
            pooled, places = [], []
            for w in WIDTHS:
                total = sum(x[k : k + reach] @ filters[w][k] for k in range(w)) + bias[w]
                best = np.maximum.reduceat(total, starts, axis=0)
                is_best = total == np.repeat(best, lengths, axis=0)
                place = np.maximum.reduceat(np.where(is_best, np.arange(reach)[:, None], -1), starts, axis=0)
                pooled.append(np.maximum(best, 0))
                places.append(np.where(best > 0, place, -1))
            pooled = np.concatenate(pooled, axis=1)
            wrong = (_sigmoid(pooled @ out + offset[0]) - target[some]) / len(some)
            back = wrong[:, None] * out[None, :]
            d_embedding = np.zeros_like(embedding)
            for j, w in enumerate(WIDTHS):
                g, place = back[:, j * FILTERS : (j + 1) * FILTERS], places[j]
                doc, f = np.nonzero(place >= 0)
                strength, where = g[doc, f], place[doc, f]
                d_filter = np.zeros_like(filters[w])
                for k in range(w):
                    vector = x[where + k]
                    np.add.at(d_filter[k].T, f, strength[:, None] * vector)
                    change = strength[:, None] * filters[w][k].T[f]
                    for column in flat[where + k].T:
                        np.add.at(d_embedding, column, change)
                d_bias = np.bincount(f, weights=strength, minlength=FILTERS)
                tune["f", w].step(filters[w], d_filter + 1e-4 * filters[w])
                tune["b", w].step(bias[w], d_bias)
            d_embedding[0] = 0
            tune["out"].step(out, pooled.T @ wrong + 1e-4 * out)
            tune["offset"].step(offset, np.array([wrong.sum()]))
            tune["embedding"].step(embedding, d_embedding)
            embedding[0] = 0
    net.offset = float(offset[0])
    return net


def threshold(margins: np.ndarray, toxic: np.ndarray) -> float:
    """The margin that parts the classes best, both counted alike, in the middle of the best range."""
    ranked = np.sort(margins)
    cuts = np.concatenate([[ranked[0] - 1], (ranked[1:] + ranked[:-1]) / 2, [ranked[-1] + 1]])
    good, bad = np.sort(margins[~toxic]), np.sort(margins[toxic])
    gain = np.searchsorted(good, cuts) / max(1, len(good)) - np.searchsorted(bad, cuts) / max(1, len(bad))
    best = cuts[gain >= gain.max() - 1e-9]
    return float((best[0] + best[-1]) / 2)


def fit(texts: list[bytes | None], toxic: np.ndarray, at: float) -> Network | None:
    """A calibrated network: four fifths of the texts are for the weights, one fifth is for the thresholds."""
    toxic = toxic.astype(bool)
    if not toxic.any() or toxic.all():
        return None
    own = [_buckets(split([t])) for t in texts]
    for_cut = np.arange(len(texts)) % 5 == 0
    if len(set(toxic[for_cut])) < 2 or len(set(toxic[~for_cut])) < 2:
        for_cut = np.ones(len(texts), dtype=bool)
        weights_from = for_cut
    else:
        weights_from = ~for_cut
    net = train_network([own[i] for i in np.flatnonzero(weights_from)], toxic[weights_from])
    parts = [split(texts[at : at + BATCH]) for at in range(0, len(texts), BATCH)]
    margins = np.concatenate([net.margins(p) for p in parts])
    tongue = np.concatenate([languages(p) for p in parts])
    common = threshold(margins[for_cut], toxic[for_cut])
    goal = np.log(at / (1 - at))
    for k in range(len(LANGUAGES)):
        mine = for_cut & (tongue == k)
        enough = min(toxic[mine].sum(), (~toxic[mine]).sum()) >= LEAST
        net.shift[k] = goal - (threshold(margins[mine], toxic[mine]) if enough else common)
    net._row = None  # made anew by each task
    return net


def train(
    docs: DataFrame, labels: DataFrame, label: str, modulus: int, keep_out: int, at: float, per_class: int = PER_CLASS
) -> Network | None:
    """About 2 * `per_class` labelled texts reach the driver, no more than MOST_WORDS words of each class; it learns from those.

    A text that does not fit is passed over, and those after it are still learned from. Texts that can never fit do not
    leave the executors.
    """
    sample = labelled_sample(docs, labels, label, modulus, keep_out, per_class)
    texts, toxic, words = [], [], {0: 0, 1: 0}
    fits = F.coalesce(F.octet_length("text"), F.lit(0)) < 6 * (MOST_WORDS + 1)
    ordered = sample.where(fits).select("label", "text").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
    for row in ordered.toLocalIterator():
        text = (row["text"] or "").encode()
        if words[row["label"]] + len(text) // 6 > MOST_WORDS:
            continue
        words[row["label"]] += len(text) // 6
        texts.append(text)
        toxic.append(row["label"] == 1)
    return fit(texts, np.array(toxic, dtype=bool), at)


def _scores(batches: Iterator[pa.RecordBatch], net: Network | None) -> Iterator[pa.RecordBatch]:
    for rows, texts in slices(batches, "text"):
        score = net.score(split(texts)) if net else np.zeros(len(texts))
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(score, pa.float64())], names=["doc_id", "score"])


def scores(
    docs: DataFrame, labels: DataFrame, label: str, modulus: int, keep_out: int, at: float, per_class: int = PER_CLASS
) -> DataFrame:
    """doc_id, held_out, score and predicted (score >= `at`) of every document."""
    net = train(docs, labels, label, modulus, keep_out, at, per_class)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(lambda batches: _scores(batches, net), f"doc_id {id_type}, score double")
    return scored.select(
        "doc_id", held_out("doc_id", modulus, keep_out).alias("held_out"), "score",
        (F.col("score") >= at).cast("int").alias("predicted"),
    )
