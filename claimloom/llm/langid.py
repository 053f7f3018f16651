"""Language identification by a byte convolutional network in numpy.

Filters of several widths slide over one-hot bytes, each filter is max-pooled
over a fixed-length window, and a softmax layer reads the pooled values. The
network is trained by Adam on windows of labelled texts; the gradient of a
pooled value reaches only the bytes at its maximum. A text is predicted from all
its windows: their logits are averaged, weighted by the bytes they hold.

At prediction a filter's weights for two neighbouring bytes are added up ahead
into one table per byte pair, so a width-4 filter costs two lookups per byte.

The training sample is bounded by ``PER_LANGUAGE`` windows for each language
(a rate per language by hash, then the smallest hashes), one window of at most
``WINDOW`` bytes per document, from a place that a hash picks.

Defined results
---------------
null text, or text without a letter: ``und`` with score 0. Nothing to learn
from: ``und`` for every text. Rows without lang or id are never learnt from; a
null id is not held out. Repeated rows are predicted alike. Very long texts go
through in blocks of windows. Empty table: no rows. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.llm.common import frees_memory, slices

#: Start positions of a window; its filters may look a few bytes beyond.
WINDOW = 512
WIDTHS, FILTERS = (2, 3, 4), 16
BEYOND = max(WIDTHS) - 1
#: Bound of the training sample for each language, and of the languages.
PER_LANGUAGE, LANGUAGES = 1500, 1000
EPOCHS, BATCH, RATE, SEED = 6, 64, 0.01, 7
#: Steps of training at least, however small the sample.
STEPS = 600
#: Windows that go through the filters at once.
BLOCK = 128
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


def windows(data: bytes) -> np.ndarray:
    """All windows of a text, zero-padded: (n, WINDOW + BEYOND)."""
    count = max(1, -(-len(data) // WINDOW))
    padded = np.zeros(count * WINDOW + BEYOND, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW + BEYOND)[::WINDOW]


class Network:
    """Weights: ``kernels[w]`` is (width, 256, FILTERS); ``dense`` maps pooled values to logits."""

    def __init__(self, languages: list[str], seed: int = SEED):
        random = np.random.default_rng(seed)
        self.languages = languages
        self.kernels = [random.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        shape = (len(WIDTHS) * FILTERS, len(languages))
        self.dense = random.normal(0, 0.1, shape).astype(np.float32)
        self.shift = np.zeros(len(languages), np.float32)
        self._tables: list[list[np.ndarray]] | None = None

    def __getstate__(self):
        return {**self.__dict__, "_tables": None}

    def parameters(self) -> list[np.ndarray]:
        return [*self.kernels, self.bias, self.dense, self.shift]

    # training

    def step(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean cross entropy, in the order of ``parameters``."""
        length, count = x.shape[1] - BEYOND, len(x)
        pooled, places = [], []
        for width, kernel in zip(WIDTHS, self.kernels):
            signal = kernel[0][x[:, :length]]
            for k in range(1, width):
                signal += kernel[k][x[:, k : k + length]]
            places.append(signal.argmax(1))
            pooled.append(np.take_along_axis(signal, places[-1][:, None], 1)[:, 0])
        before = np.concatenate(pooled, 1) + self.bias
        hidden = np.maximum(before, 0)
        logits = hidden @ self.dense + self.shift
        chance = np.exp(logits - logits.max(1, keepdims=True))
        chance /= chance.sum(1, keepdims=True)
        chance[np.arange(count), y] -= 1
        chance /= count
        to_hidden = (chance @ self.dense.T) * (before > 0)
        to_kernels, rows, filters = [], np.arange(count)[:, None], np.arange(FILTERS)[None, :]
        for number, (width, kernel) in enumerate(zip(WIDTHS, self.kernels)):
            grad, part = np.zeros_like(kernel), to_hidden[:, number * FILTERS : (number + 1) * FILTERS]
            for k in range(width):
                np.add.at(grad[k], (x[rows, places[number] + k], np.broadcast_to(filters, part.shape)), part)
            to_kernels.append(grad)
        return [*to_kernels, to_hidden.sum(0), hidden.T @ chance, chance.sum(0)]

    def fit(self, x: np.ndarray, y: np.ndarray, seed: int = SEED) -> Network:
        random = np.random.default_rng(seed)
        epochs = max(EPOCHS, -(-STEPS * BATCH // len(x)))
        first = [np.zeros_like(p) for p in self.parameters()]
        second = [np.zeros_like(p) for p in self.parameters()]
        done = 0
        for _ in range(epochs):
            order = random.permutation(len(x))
            for start in range(0, len(x), BATCH):
                at = order[start : start + BATCH]
                done += 1
                for p, g, m, v in zip(self.parameters(), self.step(x[at], y[at]), first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= RATE * (m / (1 - 0.9**done)) / (np.sqrt(v / (1 - 0.999**done)) + 1e-8)
        return self

    # prediction

    def tables(self) -> list[list[np.ndarray]]:
        """Per width, tables over byte pairs (and one over bytes where the width is odd)."""
        if self._tables is None:
            self._tables = [
                [
                    (kernel[k][:, None] + kernel[k + 1][None]).reshape(-1, FILTERS) if k + 1 < len(kernel) else kernel[k]
                    for k in range(0, len(kernel), 2)
                ]
                for kernel in self.kernels
            ]
        return self._tables

    def logits(self, x: np.ndarray) -> np.ndarray:
        """Logits of windows (n, WINDOW + BEYOND)."""
        length = x.shape[1] - BEYOND
        pairs = (x[:, :-1].astype(np.int32) << 8) | x[:, 1:]
        pooled = []
        for tables in self.tables():
            signal = None
            for number, table in enumerate(tables):
                codes = pairs if len(table) > 256 else x
                part = table.take(codes[:, 2 * number : 2 * number + length], axis=0)
                signal = part if signal is None else np.add(signal, part, out=signal)
            while signal.shape[1] > 1:
                half = signal.shape[1] // 2
                rest = signal[:, 2 * half :]
                signal = np.maximum(signal[:, :half], signal[:, half : 2 * half])
                if rest.shape[1]:
                    signal[:, :1] = np.maximum(signal[:, :1], rest)
            pooled.append(signal[:, 0])
        hidden = np.maximum(np.concatenate(pooled, 1) + self.bias, 0)
        return hidden @ self.dense + self.shift

    def predict(self, texts: list[bytes]) -> np.ndarray:
        """Probability of each language for each text, from all its windows."""
        summed = np.zeros((len(texts), len(self.languages)))
        held, owners, sizes, count = [], [], [], 0

        def flush() -> None:
            found = self.logits(np.concatenate(held)) * np.array(sizes, np.float32)[:, None]
            np.add.at(summed, np.array(owners), found)

        for number, data in enumerate(texts):
            cut = windows(data)
            for start in range(0, len(cut), BLOCK):
                part = cut[start : start + BLOCK]
                held.append(part)
                owners += [number] * len(part)
                sizes += [max(1, min(WINDOW, len(data) - WINDOW * (start + i))) for i in range(len(part))]
                count += len(part)
                if count >= BLOCK:
                    flush()
                    held, owners, sizes, count = [], [], [], 0
        if held:
            flush()
        mean = summed / np.array([max(1, len(t)) for t in texts])[:, None]
        chance = np.exp(mean - mean.max(1, keepdims=True))
        return chance / chance.sum(1, keepdims=True)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> list[tuple[str, bytes]]:
    """At most ``per_language`` pieces of text of each language, none of a held-out document."""
    rows = docs.where("text IS NOT NULL AND lang IS NOT NULL AND doc_id IS NOT NULL").where(
        ~held_out(F.col("doc_id"))
    )
    counts = dict(rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect())
    if not counts:
        return []
    deal = F.xxhash64("doc_id", F.lit(SEED))
    share = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, 2.0 * per_language / n))])
    place = F.pmod(F.xxhash64("doc_id"), F.greatest(F.lit(1), F.length("text") - WINDOW)).cast("int") + 1
    dealt = rows.where(F.pmod(deal, F.lit(1 << 20)) < F.try_element_at(share, F.col("lang")) * (1 << 20))
    some = dealt.select("lang", deal.alias("deal"), "doc_id", F.substring("text", place, F.lit(WINDOW)).alias("text"))
    ranked = some.selectExpr("*", "row_number() OVER (PARTITION BY lang ORDER BY deal, doc_id) AS nr")
    found = ranked.where(F.col("nr") <= per_language).orderBy("lang", "nr").select("lang", "text").collect()
    return [(lang, text.encode()) for lang, text in found if LETTER.search(text)]


def train(sample: list[tuple[str, bytes]], seed: int = SEED) -> Network | None:
    """A network for the languages of the sample; every third window is cut short, as short texts occur."""
    if not sample:
        return None
    languages = sorted({lang for lang, _ in sample})
    random = np.random.default_rng(seed)
    lengths = np.where(np.arange(len(sample)) % 3 == 0, random.integers(6, 120, len(sample)), WINDOW // 2)
    x = np.zeros((len(sample), WINDOW // 2 + BEYOND), np.uint8)
    for row, ((_, data), length) in enumerate(zip(sample, lengths)):
        data = data[:length]
        x[row, : len(data)] = np.frombuffer(data, np.uint8)
    y = np.array([languages.index(lang) for lang, _ in sample])
    return Network(languages, seed).fit(x, y)


@frees_memory
def _identify(batches: Iterator[pa.RecordBatch], network: Network | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            texts = part.column("text").to_pylist()
            known = [i for i, t in enumerate(texts) if network and t and LETTER.search(t)]
            lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if known:
                chance = network.predict([texts[i].encode() for i in known])
                for i, best in zip(known, chance.argmax(1)):
                    lang[i] = network.languages[best]
                score[known] = chance.max(1)
            yield pa.record_batch(
                [part.column("row"), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                names=["row", "lang_pred", "score"],
            )


def identify(docs: DataFrame, network: Network | None, keep: list[str] | None = None) -> DataFrame:
    """``row`` (the columns named in ``keep``, by default all), lang_pred and score of each row."""
    kept = F.struct(*[F.col(f"`{c}`") for c in (keep or docs.columns)]).alias("row")
    rows = docs.select(kept, F.col("text").cast("string").alias("text"))
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return rows.mapInArrow(partial(_identify, network=network), T.StructType([rows.schema["row"], *added]))


def fit(docs: DataFrame) -> Network | None:
    """A network learnt from the labelled documents that are not held out."""
    return train(training_sample(docs))
