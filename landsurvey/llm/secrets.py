"""Secret scans: fixed patterns, and a linear-chain conditional random field.

The field tags tokens (runs of letters, digits, + / _ - and non-ASCII bytes) as
O, begin (B) or inside (I) of a secret. Its features are the token's shape, how
often letters and digits alternate in it, whether it is hexadecimal and what
stands before it, the two words before, the shape of the next token, and of the
file its length and share of digits. It is trained in numpy by maximum
likelihood on what the patterns find in about SAMPLE texts with a find and as many
without, so it learns the looks and the surroundings of secrets that the patterns
know and tags others that look alike. Decoding is Viterbi; a token that is O whatever its neighbours
are splits the chain, which leaves the best path as it is.

Pattern spans always stay; tagged runs that overlap none are added as ``crf``.

Defined results: null text is empty and has no spans; a corpus in which the
patterns find nothing trains no field and gets pattern spans only; repeated rows
get equal answers; spans that begin together go in the order of KINDS; of paths that
score alike the lowest tags win; texts of any length are scanned whole; extra columns
of any name are ignored; no rows give no rows. Spans are in code points.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, plain_columns, utf8_slices
from .training import Adam, bounded_sample
from .words import FOLD, word_bounds, word_hashes

KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24

SAMPLE, WINDOW, STEPS, SLICE_BYTES = 10_000, 32, 100, 1 << 20
#: What the patterns look for, for Spark; it only tells two kinds of text apart for the sample.
LIKELY = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{6}|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"
SHOWN = 0.5  # share of features seen in each training step
O, B, I = 0, 1, 2
SIZES = (192, 36, 84, 1024, 1024, 193, 16, 48)  # values of each feature

_BYTE = np.arange(256)
DIGIT = (_BYTE >= 0x30) & (_BYTE < 0x3A)
SMALL = (_BYTE >= 0x61) & (_BYTE < 0x7B)
CAPITAL = (_BYTE >= 0x41) & (_BYTE < 0x5B)
HIGH = _BYTE >= 0x80
MARK = np.isin(_BYTE, [ord(c) for c in "+/_-"])
TOKEN = DIGIT | SMALL | CAPITAL | HIGH | MARK
HEX = DIGIT | ((_BYTE >= 0x61) & (_BYTE < 0x67))
HEX_ANY = HEX | ((_BYTE >= 0x41) & (_BYTE < 0x47))
#: 0 other, 1 blank, 2 line end, 3 quote, 4 equals, 5 colon; 6 is the text's start
GAP = np.zeros(256, np.int64)
for _c, _k in ((" ", 1), ("\t", 1), ("\n", 2), ("\r", 2), ('"', 3), ("'", 3), ("=", 4), (":", 5)):
    GAP[ord(_c)] = _k


def pattern_spans(raw: bytes) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the secret) of assign and access, in bytes."""
    out = []
    low = raw.lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(raw) if len(m[2]) >= MIN_ASSIGN]
    if b"AKIA" in raw:
        out += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(raw) if len(m[0]) >= MIN_ACCESS]
    return out


def slice_spans(raw: np.ndarray, bounds: np.ndarray) -> dict[int, list[tuple[int, int, int, int]]]:
    """Pattern spans by row of a slice, in bytes of the row, sorted."""
    out: dict[int, list] = {}
    data = raw.tobytes()
    for i, (a, b) in enumerate(zip(bounds.tolist(), bounds[1:].tolist())):
        if found := pattern_spans(data[a:b]):
            out[i] = found
    starts, ends = word_bounds(raw, HEX, bounds)
    long = ends - starts >= MIN_HEX
    for s, e in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
        i = int(np.searchsorted(bounds, s, "right")) - 1
        out.setdefault(i, []).append((s - int(bounds[i]), 2, e - int(bounds[i]), s - int(bounds[i])))
    return {i: sorted(v) for i, v in out.items()}


def features(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Token starts and ends, bounds of rows in tokens, and feature ids by token."""
    starts, ends = word_bounds(raw, TOKEN, bounds)
    rows = np.searchsorted(starts, bounds)
    n = len(starts)
    ids = np.zeros((len(SIZES), n), np.int64)
    if not n:
        return starts, ends, rows, ids
    length = ends - starts
    size = np.searchsorted([4, 8, 16, 24, 36], length, "right")  # 0..5

    def holds(of: np.ndarray) -> np.ndarray:
        return np.add.reduceat(of[raw].view(np.uint8), edges, dtype=np.int32)[::2] if len(edges) else np.zeros(n, np.int32)

    # reduceat over start, end, start, ...; the last end may be the slice's end
    edges = np.empty(2 * n, np.int64)
    edges[::2], edges[1::2] = starts, ends
    if edges[-1] == len(raw):
        edges = edges[:-1]
    digits, small, capital, high, mark = (holds(x) for x in (DIGIT, SMALL, CAPITAL, HIGH, MARK))
    flags = ((digits > 0) * 1 + (small > 0) * 2 + (capital > 0) * 4 + (high > 0) * 8 + (mark > 0) * 16).astype(np.int64)
    shape = size * 32 + flags
    kind = DIGIT[raw]
    turns = np.zeros(len(raw), np.uint8)
    turns[1:] = kind[1:] != kind[:-1]
    turns[starts] = 0
    changes = np.add.reduceat(turns, edges, dtype=np.int32)[::2]
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(rows))
    before = np.where(starts > bounds[row], GAP[raw[np.maximum(starts - 1, 0)]], 6)
    pure = holds(HEX_ANY) == length
    word = (word_hashes(FOLD[raw], starts, ends) >> np.uint64(54)).astype(np.int64)
    ids[0] = shape
    ids[1] = np.searchsorted([1, 2, 3, 5, 9], changes, "right") * 6 + size
    ids[2] = (pure * 6 + size) * 7 + before
    ids[3, 1:] = word[:-1]
    ids[4, 2:] = word[:-2]
    ids[5, :-1] = shape[1:] + 1
    first, last = rows[:-1][np.diff(rows) > 0], rows[1:][np.diff(rows) > 0] - 1
    ids[3, first] = ids[4, first] = ids[5, last] = 0
    second = first[first < last] + 1
    ids[4, second] = 0
    text_size = np.diff(bounds)
    share = np.bincount(row, digits, len(text_size)) / np.maximum(text_size, 1)
    ids[6] = (np.searchsorted([0.005, 0.03, 0.1], share, "right") * 4 + np.searchsorted([300, 3000, 30000], text_size, "right"))[row]
    ids[7] = size * 8 + (digits > 0) + 2 * (small + capital + high > 0) + 4 * (mark > 0)
    return starts, ends, rows, ids


class Field:
    def __init__(self):
        self.weights = [np.zeros((n, 3), np.float32) for n in SIZES]
        self.moves = np.zeros((3, 3), np.float32)  # score of a tag after a tag

    def emissions(self, ids: np.ndarray) -> np.ndarray:
        out = self.weights[0][ids[0]]
        for w, i in zip(self.weights[1:], ids[1:], strict=True):
            out = out + w[i]
        return out

    def train(self, ids: np.ndarray, tags: np.ndarray, steps: int = STEPS) -> None:
        """Maximum likelihood on windows: ids (feature, window, token), tags (window,
        token), -1 after a window's end."""
        live = tags >= 0
        last = live.sum(axis=1) - 1
        n, width = tags.shape
        rows = np.arange(n)
        adam = Adam([*self.weights, self.moves], 0.15)
        pairs = np.zeros((3, 3))
        both = live[:, 1:] & live[:, :-1]
        np.add.at(pairs, (tags[:, :-1][both], tags[:, 1:][both]), 1)
        truth = np.zeros((n, width, 3), np.float32)
        np.put_along_axis(truth, np.maximum(tags, 0)[:, :, None], 1, axis=2)
        truth[~live] = 0
        flat = ids.reshape(len(SIZES), -1)
        total = max(1, live.sum())
        rng = np.random.default_rng(5)
        for _ in range(steps):
            # hiding features at random makes each carry its part, seen shape or not
            shown = np.repeat(rng.random((len(SIZES), n)) < SHOWN, width, axis=1)
            e = sum(w[i] * s[:, None] for w, i, s in zip(self.weights, flat, shown, strict=True)).reshape(n, width, 3).astype(np.float32)
            m = self.moves
            alpha, beta = np.empty_like(e), np.zeros_like(e)
            alpha[:, 0] = e[:, 0]
            for t in range(1, width):
                x = alpha[:, t - 1, :, None] + m[None]
                top = x.max(axis=1)
                alpha[:, t] = top + np.log(np.exp(x - top[:, None]).sum(axis=1)) + e[:, t]
            for t in range(width - 2, -1, -1):
                x = m[None] + (e[:, t + 1] + beta[:, t + 1])[:, None, :]
                top = x.max(axis=2)
                beta[:, t] = np.where(live[:, t + 1, None], top + np.log(np.exp(x - top[:, :, None]).sum(axis=2)), 0)
            end = alpha[rows, last]
            top = end.max(axis=1)
            norm = top + np.log(np.exp(end - top[:, None]).sum(axis=1))
            p = np.exp(np.minimum(alpha + beta - norm[:, None, None], 0))
            p[~live] = 0
            adam.tick()
            diff = ((p - truth) / total).reshape(-1, 3)
            for f, size in enumerate(SIZES):
                grad = np.stack([np.bincount(flat[f], diff[:, k] * shown[f], size) for k in range(3)], axis=1)
                adam.step(f, grad.astype(np.float32) + 1e-6 * self.weights[f])
            expected = np.zeros((3, 3))
            for t in range(1, width):
                x = alpha[:, t - 1, :, None] + m[None] + (e[:, t] + beta[:, t])[:, None, :] - norm[:, None, None]
                expected += np.exp(np.minimum(x, 0))[live[:, t]].sum(axis=0)
            adam.step(len(SIZES), ((expected - pairs) / total).astype(np.float32) + 1e-4 * self.moves)

    def decode(self, e: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Best tags of all tokens; rows: bounds of the texts in tokens."""
        m = self.moves
        tags = np.zeros(len(e), np.int8)
        # what B or I can gain over O from any neighbours
        gain = [max(m[a, y] + m[y, c] - m[a, O] - m[O, c] for a in range(3) for c in range(3)) for y in (B, I)]
        open_ = ~((e[:, O] - e[:, B] > gain[0]) & (e[:, O] - e[:, I] > gain[1]))
        at = np.flatnonzero(open_)
        if not len(at):
            return tags
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) > 1) | np.isin(at[1:], rows)
        first = np.flatnonzero(new)
        lens = np.diff(np.append(first, len(at)))
        order = np.argsort(-lens, kind="stable")
        begin, lens = at[first[order]], lens[order]
        best = m[O][None] + e[begin]
        steps = []
        for t in range(1, int(lens[0])):
            k = int(np.searchsorted(-lens, -t, "left"))  # runs longer than t
            x = best[:k, :, None] + m[None]
            back = x.argmax(axis=1)
            steps.append(back)
            best[:k] = np.take_along_axis(x, back[:, None], 1)[:, 0] + e[begin[:k] + t]
        tag = (best + m[:, O][None]).argmax(axis=1)
        tags[begin + lens - 1] = tag
        for t in range(int(lens[0]) - 1, 0, -1):
            back = steps[t - 1]
            k = len(back)
            tag[:k] = back[np.arange(k), tag[:k]]
            tags[begin[:k] + t - 1] = tag[:k]
        return tags


def _training_windows(spark: SparkSession, docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Feature ids and tags of windows around pattern spans, and of one plain window a text."""

    def run(batches):
        for batch in batches:
            out = []
            for _, bounds, raw in utf8_slices(batch.column("text"), SLICE_BYTES):
                starts, ends, rows, ids = features(raw, bounds)
                tags = np.zeros(len(starts), np.int16)
                spans, centres = slice_spans(raw, bounds), []
                for i, found in spans.items():
                    for s, _, e, secret in found:
                        a = int(np.searchsorted(ends, bounds[i] + secret, "right"))
                        b = int(np.searchsorted(starts, bounds[i] + e))
                        if a < b:
                            tags[a:b] = I
                            tags[a] = B
                            centres.append((i, a))
                centres += [(i, int(rows[i] + rows[i + 1]) // 2) for i in range(len(rows) - 1) if rows[i] < rows[i + 1]]
                for i, c in centres:
                    a, b = max(int(rows[i]), c - WINDOW // 2), min(int(rows[i + 1]), c + WINDOW // 2)
                    block = np.zeros((len(SIZES) + 1, WINDOW), np.int16)
                    block[-1] = -1
                    block[:-1, : b - a], block[-1, : b - a] = ids[:, a:b], tags[a:b]
                    out.append(block.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["w"])

    blocks = sorted(map_batches(spark, docs, run, "w binary").toArrow()["w"].to_pylist())
    data = np.frombuffer(b"".join(blocks), np.int16).reshape(-1, len(SIZES) + 1, WINDOW)
    return data[:, :-1].transpose(1, 0, 2).astype(np.int64), data[:, -1].astype(np.int64)


def train(spark: SparkSession, docs: DataFrame, sample: int = SAMPLE) -> Field | None:
    ids, tags = _training_windows(spark, bounded_sample(docs, F.coalesce(F.col("text").rlike(LIKELY), F.lit(False)), F.col("doc_id"), sample).select("text"))
    if not (tags == B).any():
        return None
    field = Field()
    field.train(ids, tags)
    return field


def scan(spark: SparkSession, docs: DataFrame, field: Field | None) -> DataFrame:
    """doc_id and found: spans (kind, start, end) in code points, by start and kind."""
    shared = spark.sparkContext.broadcast(field)

    def run(batches):
        field = shared.value
        for batch in batches:
            found: list[list] = [[] for _ in range(batch.num_rows)]
            for row, bounds, raw in utf8_slices(batch.column("text"), SLICE_BYTES):
                spans = slice_spans(raw, bounds)
                if field:
                    starts, ends, rows, ids = features(raw, bounds)
                    tags = field.decode(field.emissions(ids), rows)
                    hit = np.flatnonzero(tags)
                    for a, b in _runs(hit, tags, rows):
                        i = int(np.searchsorted(rows, a, "right")) - 1
                        s, e = int(starts[a] - bounds[i]), int(ends[b] - bounds[i])
                        own = spans.setdefault(i, [])
                        if all(e <= x[0] or x[2] <= s for x in own if x[1] < 3):
                            own.append((s, 3, e, s))
                for i, own in spans.items():
                    if own:
                        chars = np.concatenate([[0], np.cumsum((raw[bounds[i] : bounds[i + 1]] & 0xC0) != 0x80)])
                        found[row + i] = [{"kind": KINDS[k], "start": int(chars[s]), "end": int(chars[e])} for s, k, e, _ in sorted(own)]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], names=["doc_id", "found"])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, found array<struct<kind:string,start:bigint,end:bigint>>"
    return map_batches(spark, docs.select("doc_id", "text"), run, schema)


def _runs(hit: np.ndarray, tags: np.ndarray, rows: np.ndarray):
    """(first, last) tokens of the tagged runs: a run begins at B, after O, or in a new text."""
    if not len(hit):
        return
    new = np.ones(len(hit), bool)
    new[1:] = (np.diff(hit) > 1) | (tags[hit[1:]] == B) | np.isin(hit[1:], rows)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(hit)) - 1
    yield from zip(hit[first].tolist(), hit[last].tolist(), strict=True)


def report(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for every row of docs."""
    docs = plain_columns(docs, doc_id=F.col("doc_id"), text=F.col("text"))
    found = scan(spark, docs, train(spark, docs))
    written = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    base = F.filter("found", lambda x: x["kind"] != "crf")
    count = lambda k: F.size(F.filter("found", lambda x: x["kind"] == k)).cast("bigint")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(F.array_join(F.transform(base, written), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("found", written), ",").alias("spans"),
    )
