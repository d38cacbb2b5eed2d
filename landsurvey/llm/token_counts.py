"""Token counts with a public tokenizer, long texts by overlap resynchronisation.

A text of more than CHUNK bytes is encoded in chunks that overlap, each with the
offsets of what it holds. Two neighbours are spliced at a boundary that is proven
stable, an ASCII blank, before a stretch on whose offsets and tokens both agree.
For the tokenizers accepted here no token holds a blank, no rule looks across one,
and normalisation neither joins what stands beside it nor depends on it, so what
follows a blank is encoded as it is in the whole text. Where an overlap has no
such boundary it is doubled; where a whole chunk has none the chunk is doubled, up
to the whole text, so the work stays in proportion to the text.

A chunk (or a short text) is encoded piece by piece between blanks, and a piece
met before is looked up: by a 64-bit hash, and then its bytes are compared. What
is remembered is bounded in pieces and in bytes. The tests hold counts against
encoding each text whole.

Defined results: null is empty text with no bytes and no tokens; special strings
inside texts count as the library's default has them; repeated rows are counted
row by row; texts of any length are counted whole; extra columns are ignored; no
rows give no rows.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import map_batches, plain_columns, utf8_slices
from .words import ALNUM, DARK, FOLD, word_bounds, word_hashes

CHUNK, OVERLAP, LIMIT = 1 << 12, 256, 2048
SLICE_BYTES = 1 << 20
#: Pieces that a worker remembers, their bytes together, and the longest of them.
MEMO, MEMO_BYTES, MEMO_PIECE = 2_000_000, 32 << 20, 64
ALNUM_ASCII = ALNUM & (np.arange(256) < 0x80)

#: Rules of the pre-tokenizers under which no token holds or sees past a blank.
KNOWN_SPLITS = (r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",)


def blanks_are_stable(spec: dict) -> bool:
    """Whether a tokenizer's file shows that a blank always separates."""
    steps = spec["pre_tokenizer"].get("pretokenizers", [spec["pre_tokenizer"]])
    splits = any(s["type"] == "Split" and s["behavior"] == "Removed" and s["invert"] and s["pattern"].get("Regex") in KNOWN_SPLITS for s in steps)
    marks = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"])) for t in spec["added_tokens"])
    shapes = (spec["normalizer"] or {}).get("normalizers", [])
    plain = all(n["type"] in ("NFC", "Lowercase") or n.get("pattern") == {"Regex": r"\s+"} for n in shapes)
    return bool(splits and marks and plain and not any(s.get("add_prefix_space") for s in steps))


def folds_case(spec: dict) -> bool:
    """Whether the tokenizer lower-cases, so that A-Z may be folded before it."""
    shapes = (spec["normalizer"] or {}).get("normalizers", [spec["normalizer"] or {}])
    return any(n.get("type") == "Lowercase" for n in shapes)


def runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] of them), start[1], ..."""
    return np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)


def equal_runs(one: np.ndarray, a: np.ndarray, two: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether one[a[i]:][:size[i]] is two[b[i]:][:size[i]], for each i."""
    differ = one[runs(a, size)] != two[runs(b, size)]
    upto = np.concatenate([[0], np.cumsum(differ)])
    ends = np.cumsum(size)
    return upto[ends] == upto[ends - size]


class Memo:
    """Counts of pieces by their bytes: sorted hashes, and the bytes to compare."""

    def __init__(self):
        self.keys, self.values, self.at, self.size = np.empty(0, np.uint64), *(np.empty(0, np.int64) for _ in range(3))
        self.data = np.empty(0, np.uint8)

    def look_up(self, keys: np.ndarray, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(known, counts) of the pieces raw[starts:][:sizes] with these hashes."""
        known, found = np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            at_hit = np.flatnonzero((self.keys[at] == keys) & (self.size[at] == sizes))
            at = at[at_hit]
            same = equal_runs(self.data, self.at[at], raw, starts[at_hit], sizes[at_hit])
            known[at_hit[same]] = True
            found[at_hit[same]] = self.values[at[same]]
        return known, found

    def add(self, keys: np.ndarray, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> None:
        """Remember pieces of distinct hashes; the old ones go when there are too many."""
        if len(self.keys) + len(keys) > MEMO or len(self.data) + sizes.sum() > MEMO_BYTES:
            self.__init__()
        where = np.searchsorted(self.keys, keys)
        there = np.append(self.keys, np.uint64(0))[where] == keys if len(self.keys) else np.zeros(len(keys), bool)
        new = np.flatnonzero(~there & (sizes <= MEMO_PIECE))
        keys, starts, sizes, counts, where = keys[new], starts[new], sizes[new], counts[new], where[new]
        at = len(self.data) + np.cumsum(sizes) - sizes
        self.data = np.concatenate([self.data, raw[runs(starts, sizes)]])
        self.keys, self.values, self.at, self.size = (
            np.insert(x, where, y) for x, y in ((self.keys, keys), (self.values, counts), (self.at, at), (self.size, sizes))
        )


class Counter:
    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.chunk, self.overlap, self.memo = chunk, overlap, Memo()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if not blanks_are_stable(spec):
            raise ValueError(f"blanks are not proven stable boundaries in {path}")
        self.folds = folds_case(spec)
        self.marks = [FOLD[np.frombuffer(t["content"].encode(), np.uint8)].tobytes() for t in spec["added_tokens"] if t["content"]]
        # runs of up to three full stops (1) and commas (2), last one first
        tails = ["".join(" .,"[c // 3**k % 3] for k in (2, 1, 0)).strip() for c in range(27)]
        self.tails = np.array(self.whole(tails))

    def whole(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def pieces(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and token counts of the pieces between blanks of all rows."""
        low = raw
        if self.folds:
            low = FOLD[raw]
            data = low.tobytes()
            if any(m in data for m in self.marks):  # special strings keep their case
                low = raw
        starts, full_ends = word_bounds(low, DARK, bounds)
        if not len(starts):
            return starts, full_ends, np.zeros(0, np.int64)
        # Up to three full stops and commas after an ASCII letter or digit, before
        # a blank, are a run of their own.
        tail, code = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        rest = np.arange(len(starts))
        for _ in range(4):
            last = low[full_ends[rest] - tail[rest] - 1]
            rest = rest[((last == 0x2E) | (last == 0x2C)) & (full_ends[rest] - tail[rest] - 1 > starts[rest])]
            code[rest] += np.where(low[full_ends[rest] - tail[rest] - 1] == 0x2E, 1, 2) * 3 ** np.minimum(tail[rest], 3)
            tail[rest] += 1
        keep = (tail > 3) | ~ALNUM_ASCII[low[full_ends - tail - 1]]
        tail[keep] = code[keep] = 0
        ends = full_ends - tail
        keys, first, back = np.unique(word_hashes(low, starts, ends), return_index=True, return_inverse=True)
        known, found = self.memo.look_up(keys, low, starts[first], (ends - starts)[first])
        new, data = np.flatnonzero(~known), low.tobytes()
        found[new] = self.joined([data[starts[i] : ends[i]].decode() for i in first[new]])
        self.memo.add(keys[new], low, starts[first[new]], (ends - starts)[first[new]], found[new])
        counts = found[back]
        # equal hashes of different bytes: these pieces are counted by themselves
        size, like = ends - starts, first[back]
        other = np.flatnonzero(size != size[like])
        alike = np.flatnonzero(size == size[like])
        other = np.concatenate([other, alike[~equal_runs(low, starts[alike], low, starts[like[alike]], size[alike])]])
        if len(other):
            counts[other] = self.joined([data[starts[i] : ends[i]].decode() for i in other])
        return starts, full_ends, counts + self.tails[code]

    def joined(self, words: list[str]) -> np.ndarray:
        """Counts of single words, encoded with blanks between them."""
        out = np.zeros(len(words), np.int64)
        for i in range(0, len(words), 20_000):
            part = words[i : i + 20_000]
            edges = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
            enc = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            begins = np.fromiter((a for a, _ in enc.offsets), np.int64, len(enc))
            out[i : i + len(part)] = np.bincount(np.searchsorted(edges, begins, "right"), minlength=len(part))
        return out

    def chunk_edges(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends, between characters, of the overlapping chunks of a text."""
        ends = np.append(np.arange(self.chunk, len(raw), self.chunk), len(raw))
        starts = np.maximum(0, np.concatenate([[0], ends[:-1] - self.overlap]))
        for edge in (starts, ends):
            for _ in range(3):
                inside = edge < len(raw)
                edge[inside] += (raw[edge[inside]] & 0xC0) == 0x80
        return starts, ends

    def counts(self, raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Counts of the rows of a slice: short ones as one chunk, all chunks at once."""
        size = np.diff(bounds)
        edges = [self.chunk_edges(raw[a:b]) if n > self.chunk else (np.array([0]), np.array([n])) for a, b, n in zip(bounds, bounds[1:], size.tolist())]
        row = np.repeat(np.arange(len(size)), [len(x) for x, _ in edges])
        left = np.concatenate([x for x, _ in edges]) + bounds[row]
        right = np.concatenate([y for _, y in edges]) + bounds[row]
        cut = np.concatenate([[0], np.cumsum(right - left)])
        starts, ends, n = self.pieces(raw[runs(left, right - left)], cut)
        at = np.searchsorted(starts, cut)  # pieces of each chunk
        chunk = np.repeat(np.arange(len(left)), np.diff(at))
        starts, ends = (x - cut[chunk] + left[chunk] for x in (starts, ends))  # in the slice
        upto = np.concatenate([[0], np.cumsum(n)])
        out, done = np.zeros(len(size), np.int64), np.searchsorted(row, np.arange(len(size) + 1))
        for i in range(len(size)):
            first, last = int(done[i]), int(done[i + 1])
            begin, total = int(at[first]), 0
            for k in range(first, last - 1):
                found = self.splice((starts, ends, n), begin, int(at[k + 1]), int(at[k + 2]), int(left[k + 1]), int(right[k]))
                if found is None:
                    total = self.widened(raw[bounds[i] : bounds[i + 1]])
                    break
                total += upto[found[0]] - upto[begin]
                begin = found[1]
            else:
                total += upto[at[last]] - upto[begin]
            out[i] = total
        return out

    @staticmethod
    def splice(spans: tuple, begin: int, turn: int, stop: int, left: int, right: int) -> tuple[int, int] | None:
        """Pieces begin..turn of one encoding and turn..stop of the next overlap in
        left..right: the first piece after a blank on whose offsets and tokens both
        agree, as its place in either."""
        starts, ends, n = spans
        a = begin + int(np.searchsorted(starts[begin:turn], left, "right"))
        b, stop = turn, turn + int(np.searchsorted(starts[turn:stop], right))
        b += int(np.searchsorted(starts[b:stop], left, "right"))
        while a < turn and b < stop and ends[a] < right:
            if starts[a] == starts[b]:
                if ends[a] == ends[b] and n[a] == n[b]:
                    return a, b
                a, b = a + 1, b + 1
            elif starts[a] < starts[b]:
                a += 1
            else:
                b += 1
        return None

    def widened(self, raw: np.ndarray) -> int:
        """Count of a text some of whose overlaps have no stable boundary."""

        def at_char(p: int) -> int:
            while p < len(raw) and raw[p] & 0xC0 == 0x80:
                p += 1
            return min(p, len(raw))

        def encode(a: int, b: int) -> tuple:
            starts, ends, n = self.pieces(raw[a:b], np.array([0, b - a]))
            return starts + a, ends + a, n

        total, floor, end, overlap = 0, 0, at_char(self.chunk), self.overlap
        here = encode(floor, end)
        while end < len(raw):
            whole = np.flatnonzero((here[0] > floor) & (here[1] < end))  # pieces between two blanks
            if not len(whole) or end - overlap // 2 <= floor:  # no stable boundary: double the chunk
                end, overlap = at_char(floor + 2 * (end - floor)), self.overlap
                here = encode(floor, end)
                continue
            while end - overlap >= here[0][whole[-1]]:
                overlap *= 2
            left, right = at_char(max(floor, end - overlap)), at_char(end + self.chunk)
            following = encode(left, right)
            turn = len(here[0])
            spans = tuple(np.concatenate([x, y]) for x, y in zip(here, following, strict=True))
            found = self.splice(spans, 0, turn, len(spans[0]), left, end)
            if found is None:  # the encodings differ: widen the overlap
                overlap *= 2
                continue
            total += int(here[2][: found[0]].sum())
            here = tuple(x[found[1] - turn :] for x in following)
            floor, end, overlap = int(here[0][0]), right, self.overlap
        return total + int(here[2].sum())


_counters: dict[str, Counter] = {}


def token_counts(spark: SparkSession, docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of docs; path: the
    tokenizer's file, present on every executor."""

    def run(batches):
        if path not in _counters:
            _counters[path] = Counter(path)
        counter = _counters[path]
        for batch in batches:
            sizes, counts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for _, bounds, raw in utf8_slices(batch.column("text"), SLICE_BYTES):
                sizes.append(np.diff(bounds))
                counts.append(counter.counts(raw, bounds))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(sizes)), pa.array(np.concatenate(counts))], names=["doc_id", "n_bytes", "n_tokens"])

    rows = plain_columns(docs, doc_id=F.col("doc_id"), text=F.col("text"))
    found = map_batches(spark, rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes bigint, n_tokens bigint")
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
