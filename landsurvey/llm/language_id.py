"""Language identification by a byte convolutional network, trained in numpy.

Text becomes lower-cased (A-Z) UTF-8 bytes cut into windows of WINDOW bytes, the
last one filled with blanks. Filters of several widths slide over embedded
bytes, each filter's largest response in a window goes on, and a softmax layer
gives the languages. A text's answer is the mean log-probability of all its
windows. For prediction the filters are tables by byte pair, which gives the
same responses with fewer operations.

Training sees at most about SAMPLE texts of each language and WINDOWS_A_TEXT windows
of each. Nothing but the text enters a prediction.

Defined results: null text and text without a letter give ``und`` with score 0;
without any labelled text everything does. Repeated rows get equal answers, of
languages that score alike the first by name wins, texts of any length are read
whole in blocks of windows, extra columns of any name are ignored by ``report`` and
carried by ``predict``, and no rows give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, crc_mod, map_batches, plain_columns, utf8_slices
from .training import Adam, bounded_sample, softmax
from .words import FOLD

WINDOW, WIDTHS, FILTERS, DIM = 128, (2, 3, 4), 16, 8
SAMPLE, WINDOWS_A_TEXT, EPOCHS, BATCH = 1500, 6, 6, 128
SLICE_BYTES = 128 << 10
AT_ONCE = 128  # windows, so that responses stay in cache
BLANK, UNKNOWN = 0x20, "und"


def windows_of(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All windows of the rows of a slice, and how many each row has."""
    counts = -(-np.diff(bounds) // WINDOW)
    out = np.full(int(counts.sum()) * WINDOW, BLANK, np.uint8)
    if len(bounds) == 2:  # one row, perhaps a long one
        out[: len(raw)] = FOLD[raw]
        return out.reshape(-1, WINDOW), counts
    to = np.concatenate([[0], np.cumsum(counts) * WINDOW])[:-1]
    out[np.arange(len(raw)) + np.repeat(to - bounds[:-1], np.diff(bounds))] = FOLD[raw]
    return out.reshape(-1, WINDOW), counts


class ByteNet:
    def __init__(self, languages: list[str], seed: int = 1):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.embed = rng.normal(0, 0.3, (256, DIM)).astype(np.float32)
        self.filters = [rng.normal(0, (2 / (k * DIM)) ** 0.5, (k * DIM, FILTERS)).astype(np.float32) for k in WIDTHS]
        self.bias = np.zeros(FILTERS * len(WIDTHS), np.float32)
        self.out = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))).astype(np.float32)
        self.out_bias = np.zeros(len(languages), np.float32)

    def train(self, windows: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, seed: int = 2) -> None:
        rng = np.random.default_rng(seed)
        adam = Adam([self.embed, *self.filters, self.bias, self.out, self.out_bias], 0.004)
        last = len(adam.params) - 1
        for _ in range(epochs):
            order = rng.permutation(len(windows))
            for i in range(0, len(order), BATCH):
                rows = order[i : i + BATCH]
                x, b = windows[rows], len(rows)
                e = self.embed[x]
                pooled, places, patches = [], [], []
                for k, f in zip(WIDTHS, self.filters, strict=True):
                    patch = np.concatenate([e[:, j : WINDOW - k + 1 + j] for j in range(k)], axis=2)
                    h = patch @ f
                    at = h.argmax(axis=1)
                    pooled.append(np.take_along_axis(h, at[:, None], 1)[:, 0])
                    places.append(at)
                    patches.append(patch)
                z = np.concatenate(pooled, axis=1) + self.bias
                a = np.maximum(z, 0)
                p = softmax(a @ self.out + self.out_bias)
                p[np.arange(b), labels[rows]] -= 1
                p /= b
                dz = (p @ self.out.T) * (z > 0)
                adam.tick()
                adam.step(last - 1, a.T @ p)
                adam.step(last, p.sum(axis=0))
                adam.step(last - 2, dz.sum(axis=0))
                de = np.zeros((256, DIM), np.float32)
                for w, (k, f) in enumerate(zip(WIDTHS, self.filters, strict=True)):
                    d = dz[:, w * FILTERS : (w + 1) * FILTERS]
                    best = patches[w][np.arange(b)[:, None], places[w]]  # b, filters, k * DIM
                    back = d[:, :, None] * f.T[None]
                    for j in range(k):
                        byte = x[np.arange(b)[:, None], places[w] + j]
                        np.add.at(de, byte.ravel(), back[:, :, j * DIM : (j + 1) * DIM].reshape(-1, DIM))
                    adam.step(1 + w, np.einsum("bf,bfd->df", d, best))
                adam.step(0, de)

    def tables(self) -> None:
        """Filter responses by pairs of bytes, as 16-bit steps: widths 2, 3 and 4 begin
        with one pair. Sums of two entries stay inside 16 bits."""
        part = [[self.embed @ f[j * DIM : (j + 1) * DIM] for j in range(k)] for k, f in zip(WIDTHS, self.filters, strict=True)]
        pair = lambda a, b: (a[:, None] + b[None]).reshape(65536, FILTERS)
        found = np.concatenate([pair(p[0], p[1]) for p in part], axis=1), part[1][2], pair(part[2][2], part[2][3])
        self.scale = 32767 / (2.05 * max(np.abs(x).max() for x in found) + 1e-9)
        self.head, self.third, self.tail = (np.round(x * self.scale).astype(np.int16) for x in found)

    def log_probs(self, windows: np.ndarray) -> np.ndarray:
        pairs = windows[:, :-1].astype(np.intp) * 256 + windows[:, 1:]
        h = np.take(self.head, pairs, axis=0)
        a, b, c = h[:, :, :FILTERS].max(axis=1), h[:, :-1, FILTERS : 2 * FILTERS], h[:, :-2, 2 * FILTERS :]
        b += np.take(self.third, windows[:, 2:], axis=0)
        c += np.take(self.tail, pairs[:, 2:], axis=0)
        z = np.concatenate([a, b.max(axis=1), c.max(axis=1)], axis=1) / self.scale
        return np.log(softmax(np.maximum(z + self.bias, 0) @ self.out + self.out_bias) + 1e-12)


def sample_windows(spark: SparkSession, docs: DataFrame) -> tuple[np.ndarray, list[str]]:
    """Training windows and their languages: at most WINDOWS_A_TEXT of each text, evenly spread."""

    def run(batches):
        for batch in batches:
            rows, labels = [], []
            lang = batch.column("lang").to_pylist()
            for first, bounds, raw in utf8_slices(batch.column("text"), SLICE_BYTES):
                windows, counts = windows_of(raw, bounds)
                ends = np.cumsum(counts)
                for i, n in enumerate(counts):
                    take = np.unique(np.linspace(0, n - 1, WINDOWS_A_TEXT).astype(int)) if n else []
                    rows += [windows[ends[i] - n + j].tobytes() for j in take]
                    labels += [lang[first + i]] * len(take)
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), pa.array(labels, pa.string())], names=["w", "lang"])

    found = map_batches(spark, docs.select("text", "lang"), run, "w binary, lang string").toArrow()
    order = np.lexsort([found["w"].to_numpy(zero_copy_only=False), np.array(found["lang"].to_pylist(), object)]) if len(found) else []
    table = found.take(pa.array(order, pa.int64()))
    return np.frombuffer(b"".join(table["w"].to_pylist()), np.uint8).reshape(-1, WINDOW), table["lang"].to_pylist()


def train(spark: SparkSession, docs: DataFrame, learn: Column, sample: int = SAMPLE) -> ByteNet | None:
    """A network from the rows of docs (doc_id, text, lang) where learn holds."""
    able = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    windows, names = sample_windows(spark, bounded_sample(able, F.col("lang"), F.col("doc_id"), sample))
    if not names:
        return None
    net = ByteNet(sorted(set(names)))
    at = {n: i for i, n in enumerate(net.languages)}
    net.train(windows, np.array([at[n] for n in names]))
    net.tables()
    return net


def predict(spark: SparkSession, docs: DataFrame, net: ByteNet | None) -> DataFrame:
    """docs (any columns, with text) plus lang_pred and score."""
    docs = docs.withColumn("_able", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    shared = spark.sparkContext.broadcast(net)

    def run(batches):
        net = shared.value
        for batch in batches:
            text = batch.column("text")
            able = batch.column("_able").to_numpy(zero_copy_only=False)
            labels, scores = np.full(len(text), UNKNOWN, object), np.zeros(len(text))
            for first, bounds, raw in utf8_slices(text, SLICE_BYTES) if net else ():
                windows, counts = windows_of(raw, bounds)
                logs = np.concatenate([net.log_probs(windows[i : i + AT_ONCE]) for i in range(0, len(windows), AT_ONCE)] or [np.empty((0, len(net.languages)))])
                full = np.flatnonzero(counts)
                if not len(full):
                    continue
                mean = np.add.reduceat(logs, (np.cumsum(counts) - counts)[full], axis=0) / counts[full, None]
                p = softmax(mean)
                best = p.argmax(axis=1)
                for row, k, s in zip(first + full, best, p.max(axis=1), strict=True):
                    if able[row]:
                        labels[row], scores[row] = net.languages[k], s
            kept = [c for c in batch.schema.names if c not in ("text", "_able")]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(labels.tolist(), pa.string()), pa.array(scores)], names=[*kept, "lang_pred", "score"])

    kept = [f for f in docs.schema.fields if f.name not in ("text", "_able", "lang_pred", "score")]
    docs = docs.select(*[column(f.name) for f in kept], "text", "_able")
    schema = ", ".join([f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in kept] + ["lang_pred string, score double"])
    return map_batches(spark, docs, run, schema)


def report(spark: SparkSession, docs: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of docs."""
    docs = plain_columns(docs, doc_id=F.col("doc_id"), text=F.col("text"), lang=F.col("lang"))
    net = train(spark, docs, crc_mod(F.col("doc_id"), folds) != held)
    rows = docs.select("doc_id", (crc_mod(F.col("doc_id"), folds) == held).alias("held_out"), "text")
    return predict(spark, rows, net)
