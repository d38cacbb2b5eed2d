"""Suffix-array dedup: remove what is covered by LENGTH bytes that start elsewhere too.

Every LENGTH-byte string holds one anchor: the GRAM bytes of least hash in it,
leftmost of equals. Equal strings have the same anchor at the same offset, so
comparing all texts falls apart into groups by anchor hash, of which most have
one occurrence and are done. An occurrence stands for the stretch of text, its
context, of all strings that chose it.

Equal contexts of a group are repeats as a whole. The distinct contexts of a
group form a sparse enhanced suffix array: their suffixes from the anchor on in
order, with common prefixes of neighbours. A stack scan of these gives the
common-prefix interval tree. In every interval the members are put in order of
what stands to the left of the anchor: neighbours whose left extension and the
interval's prefix make LENGTH bytes form a repeat, and where the left extensions
part (or a member's child interval parts) the repeat is maximal. Pairs inside
one child interval are left to it, as their prefix there is longer. All members
get their interval of bytes, not only neighbours of the array.

A group of more than KINDS distinct contexts is spread over tasks instead, by
the digests of its strings, which is exact as well.

Defined results: null is empty text; texts under LENGTH bytes keep everything;
repeated rows are repeats of each other; extra columns are ignored; empty input
gives no rows. Texts are cut into pieces of bounded size with LENGTH - 1 bytes
in common, which changes no string and no anchor.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import byte_powers, fresh_path, map_batches, materialise, mix64, plain_columns, utf8_slices
from .words import BASE, INVERSE

LENGTH, GRAM = 200, 64
PIECE = 1 << 20
KINDS = 2000  # distinct contexts of a group that one task compares
BATCH = 20_000  # contexts compared at once, in whole groups
ROWS_A_BUCKET = 8192
_PLACE = np.uint64((1 << 22) - 1)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, PIECE + 2 * LENGTH)
        _POWERS[:] = [byte_powers(size, BASE), byte_powers(size, INVERSE)]
    return _POWERS


def anchors(raw: np.ndarray, bounds: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Anchors of all rows of a slice: hash, digest of the context, first and last
    string that chose it, its place (all as positions in the slice), and its row."""
    n, width = len(raw), length - gram + 1
    if n < length:
        return tuple(np.empty(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64, np.int64))
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    hashes = mix64((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])
    least = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    size = np.maximum(0, np.diff(bounds) - length + 1)  # strings of each row
    row = np.repeat(np.arange(len(size)), size)
    at = bounds[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    place = (least[at] & _PLACE).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(place) != 0) | (np.diff(row) != 0)
    start = np.flatnonzero(new)
    first, last, place, row = at[start], at[np.append(start[1:], len(at)) - 1] if len(at) else at, place[start], row[start]
    shape = ((place - first) * 1000 + (last - first)).astype(np.uint64)
    digest = mix64((sums[last + length] - sums[first]) * down[first]) ^ mix64(shape + np.uint64(1))
    return hashes[place], digest, first, last, place, row


def pieces(column: pa.Array, length: int = LENGTH):
    """(first row, row bounds, bytes, offset in the row) of slices; long rows in pieces."""
    for row, bounds, raw in utf8_slices(column, PIECE):
        if len(raw) <= 2 * PIECE:
            yield row, bounds, raw, 0
            continue
        for at in range(0, max(1, len(raw) - length + 1), PIECE):
            part = raw[at : at + PIECE + length - 1]
            yield row, np.array([0, len(part)]), part, at


def merged(owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of intervals of each owner; touching ones join."""
    if not len(owner):
        return owner, start, end
    order = np.lexsort((start, owner))
    owner, start, end = owner[order], start[order], end[order]
    _, index = np.unique(owner, return_inverse=True)
    far = int(end.max()) + 1
    top = np.maximum.accumulate(end + index * far)  # ends so far of this owner
    new = np.ones(len(owner), bool)
    new[1:] = (start[1:] + index[1:] * far > top[:-1]) | (index[1:] != index[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(owner)) - 1
    return owner[first], start[first], top[last] - index[last] * far


def _anchor_rows(batches):
    for batch in batches:
        uid = batch.column("uid").to_numpy()
        cols: list[list] = [[] for _ in range(6)]
        for row, bounds, raw, offset in pieces(batch.column("text")):
            a, c, first, last, place, at = anchors(raw, bounds)
            base = offset - bounds[at]
            for x, y in zip(cols, (a.view(np.int64), c.view(np.int64), first + base, last + base, place + base, uid[row + at]), strict=True):
                x.append(y)
        a, c, first, last, place, own = (np.concatenate(x) if x else np.empty(0, np.int64) for x in cols)
        # equal contexts of this batch: one stands for all, and all are repeats
        order = np.lexsort((first, own, c, a))
        a, c, first, last, place, own = (x[order] for x in (a, c, first, last, place, own))
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (c[1:] != c[:-1])
        lead = np.flatnonzero(new)
        count = np.diff(np.append(lead, len(a)))
        many = np.repeat(count > 1, count)
        who, start, end = merged(own[many], first[many], last[many] + LENGTH)
        k, m = len(lead), len(who)
        blank = np.zeros(m, np.int64)
        join = lambda x, y: pa.array(np.concatenate([x, y]).astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([np.ones(k, bool), np.zeros(m, bool)])), join(a[lead], blank), join(c[lead], blank), join(count, blank),
                join(own[lead], who), join(first[lead], start), join(last[lead], end), join(place[lead], blank),
            ],
            names=["anchor", "a", "c", "n", "uid", "first", "last", "place"],
        )


def _common_prefix(x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common prefix of rows of x and y, at most most."""
    differ = x != y
    return np.minimum(np.where(differ.any(axis=1), differ.argmax(axis=1), x.shape[1]), most)


def _matrix(parts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    out = np.zeros((len(parts), width), np.uint8)
    row = np.repeat(np.arange(len(parts)), size)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = np.frombuffer(b"".join(parts), np.uint8)
    return out, size


def _ordered(group: np.ndarray, rows: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Order by group, bytes and size."""
    text = np.ascontiguousarray(rows).view(f"V{rows.shape[1]}").ravel()
    _, rank = np.unique(text, return_inverse=True)
    return np.lexsort((size, rank, group))


def interval_pairs(group: np.ndarray, prefix: np.ndarray, left_rank: np.ndarray, least: int) -> tuple[list, list, list]:
    """Stack scan of an enhanced suffix array: for every interval of at least
    ``least`` common bytes, the pairs of its members that are neighbours by what
    stands left of them and come from different children, with the depth.

    group: of each place of the array; prefix: common prefix of each place with
    the one before, 0 at a group's first; left_rank: of each place.
    """
    one, two, depths = [], [], []
    rank = left_rank.tolist()
    depth_of = prefix.tolist() + [0]
    stack: list[list] = []  # [depth, [members of each child in left order]]

    def close(depth: int, children: list[list[int]]) -> list[int]:
        child = {m: k for k, ms in enumerate(children) for m in ms}
        members = sorted(child, key=rank.__getitem__)
        for x, y in zip(members, members[1:]):
            if child[x] != child[y]:
                one.append(x)
                two.append(y)
                depths.append(depth)
        return members

    below: list[int] = [0] if len(rank) else []
    for i in range(1, len(rank) + 1):
        depth = depth_of[i] if depth_of[i] >= least else 0
        while stack and stack[-1][0] > depth:
            top, children = stack.pop()
            below = close(top, [*children, below])
        if depth:
            if stack and stack[-1][0] == depth:
                stack[-1][1].append(below)
            else:
                stack.append([depth, [below]])
        below = [i]
    return one, two, depths


def repeated_parts(group: np.ndarray, lefts: list[bytes], rights: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, bytes left of the anchor, bytes right of its start) of repeats of at
    least length bytes between different contexts of the same group."""
    right, right_size = _matrix(rights, length)
    left, left_size = _matrix([x[::-1] for x in lefts], length - gram)
    order = _ordered(group, right, right_size)
    rank = np.empty(len(order), np.int64)
    rank[_ordered(group, left, left_size)] = np.arange(len(order))
    prefix = np.zeros(len(order), np.int64)
    up, here = order[:-1], order[1:]
    prefix[1:] = np.where(group[up] == group[here], _common_prefix(right[up], right[here], np.minimum(right_size[up], right_size[here])), 0)
    one, two, depth = interval_pairs(group[order], prefix, rank[order], gram)
    out: list[list] = [[np.empty(0, np.int64)] for _ in range(3)]
    for i in range(0, len(one), 100_000):
        a, b = order[np.array(one[i : i + 100_000], np.int64)], order[np.array(two[i : i + 100_000], np.int64)]
        r = np.array(depth[i : i + 100_000], np.int64)
        extent = _common_prefix(left[a], left[b], np.minimum(left_size[a], left_size[b]))
        good = extent + r >= length
        for x in (a, b):
            for store, value in zip(out, (x, extent, r), strict=True):
                store.append(value[good])
    return tuple(np.concatenate(x) for x in out)


def _context_rows(batches):
    """Texts with their wanted contexts -> contexts cut at the anchor."""
    for batch in batches:
        out: list[list] = [[] for _ in range(7)]
        texts = batch.column("text").cast(pa.large_binary())
        wanted = batch.column("wanted")
        for i in range(batch.num_rows):
            raw = texts[i].as_py() or b""
            for w in wanted[i].as_py():
                cut = w["place"]
                values = (w["a"], batch.column("uid")[i].as_py(), cut, w["single"], w["hot"], raw[w["first"] : cut], raw[cut : w["last"] + LENGTH])
                for x, v in zip(out, values, strict=True):
                    x.append(v)
        types = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types, strict=True)], names=["a", "uid", "place", "single", "hot", "before", "after"])


def _compare_rows(batches):
    """Contexts in order of their group -> intervals of those that occur once."""
    held: list = []
    for batch in _with_end(batches):
        if batch is not None:
            held.append(batch)
            if sum(b.num_rows for b in held) < BATCH:
                continue
        table = pa.Table.from_batches(held) if held else None
        held = []
        if table is None or not table.num_rows:
            continue
        keys = table["a"].to_numpy()
        # the last group may go on in the next batch
        stop = len(keys) if batch is None else int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if (keys != keys[-1]).any() else 0
        if stop < len(keys):
            held = table.slice(stop).combine_chunks().to_batches()
        if not stop:
            continue
        part = table.slice(0, stop)
        who, left, right = repeated_parts(np.unique(keys[:stop], return_inverse=True)[1], part["before"].to_pylist(), part["after"].to_pylist())
        single = part["single"].to_numpy()[who]
        who, left, right = who[single], left[single], right[single]
        place = part["place"].to_numpy()[who]
        own, start, end = merged(part["uid"].to_numpy()[who], place - left, place + right)
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (own, start, end)], names=["uid", "first", "last"])


def _with_end(batches):
    yield from batches
    yield None


def _string_rows(batches):
    """Contexts of crowded groups -> the digests of all their strings."""
    for batch in batches:
        digests, own, start = [], [], []
        for uid, place, before, after in zip(*[batch.column(c).to_pylist() for c in ("uid", "place", "before", "after")], strict=True):
            text = before + after
            for j in range(len(text) - LENGTH + 1):
                digests.append(hashlib.blake2b(text[j : j + LENGTH], digest_size=16).digest())
                own.append(uid)
                start.append(place - len(before) + j)
        yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(own, pa.int64()), pa.array(start, pa.int64())], names=["digest", "uid", "first"])


def _cut_rows(batches):
    for batch in batches:
        texts, spans = batch.column("text").cast(pa.large_binary()), batch.column("spans")
        out: list[list] = [[] for _ in range(4)]
        for i in range(batch.num_rows):
            raw = texts[i].as_py() or b""
            found = spans[i].as_py() or []
            s, e = np.array([x["first"] for x in found], np.int64), np.array([x["last"] for x in found], np.int64)
            _, s, e = merged(np.zeros(len(s), np.int64), s, e)
            kept, at = hashlib.sha256(), 0
            for a, b in zip(s.tolist(), e.tolist(), strict=True):
                kept.update(raw[at:a])
                at = b
            kept.update(raw[at:])
            for x, v in zip(out, (len(raw), int((e - s).sum()), len(s), kept.hexdigest()), strict=True):
                x.append(v)
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(x, t) for x, t in zip(out, types, strict=True)]], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        )


def _text_table(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """docs with row ids, bucketed by them in the shared folder, so that no later join
    moves the texts again."""
    rows = plain_columns(docs, doc_id=F.col("doc_id").cast("bigint"), text=F.col("text"))
    buckets = max(8, rows.count() // ROWS_A_BUCKET + 1)
    name = f"substring_texts_{uuid.uuid4().hex}"
    (
        rows.withColumn("uid", F.monotonically_increasing_id())
        .repartition(buckets, "uid")
        .write.bucketBy(buckets, "uid").sortBy("uid").option("path", fresh_path(spark, "substring-texts")).saveAsTable(name)
    )
    texts = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name goes, the files and what reads them stay
    return texts


def covered(spark: SparkSession, texts: DataFrame) -> DataFrame:
    """(uid, first, last): byte intervals of texts (uid, text) that repeats cover; they
    may overlap."""
    found = map_batches(
        spark, texts.select("uid", "text"), _anchor_rows, "anchor boolean, a bigint, c bigint, n bigint, uid bigint, first bigint, last bigint, place bigint"
    )
    rows = materialise(spark, found, "substring-anchors")
    of_context, of_anchor = Window.partitionBy("a", "c"), Window.partitionBy("a")
    marked = (
        rows.filter("anchor")
        .withColumn("at", F.row_number().over(of_context.orderBy("uid", "first")))
        .withColumn("same", F.sum("n").over(of_context))
        .withColumn("kind", F.dense_rank().over(of_anchor.orderBy("c")))
        .withColumn("kinds", F.max("kind").over(of_anchor))
        .filter("kinds > 1 OR same > 1")
        .select("a", "uid", "first", "last", "place", "same", "at", "kinds")
    )
    repeated = materialise(spark, marked, "substring-repeated")
    wanted = (
        repeated.filter("at = 1 AND kinds > 1")
        .groupBy("uid")
        .agg(F.collect_list(F.struct("a", "first", "last", "place", (F.col("same") == 1).alias("single"), (F.col("kinds") > KINDS).alias("hot"))).alias("wanted"))
    )
    cut = map_batches(
        spark, texts.select("uid", "text").join(wanted.hint("merge"), "uid").select("uid", "text", "wanted"), _context_rows,
        "a bigint, uid bigint, place bigint, single boolean, hot boolean, before binary, after binary",
    )
    contexts = materialise(spark, cut, "substring-contexts")
    groups = contexts.filter("NOT hot").repartition("a").sortWithinPartitions("a")
    compared = map_batches(spark, groups.select("a", "uid", "place", "single", "before", "after"), _compare_rows, "uid bigint, first bigint, last bigint")
    strings = map_batches(spark, contexts.filter("hot"), _string_rows, "digest binary, uid bigint, first bigint")
    crowded = strings.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("digest"))).filter("n > 1").select("uid", "first", (F.col("first") + LENGTH).alias("last"))
    whole = repeated.filter("same > 1").select("uid", "first", (F.col("last") + LENGTH).alias("last"))
    inside = rows.filter("NOT anchor").select("uid", "first", "last")
    return inside.union(whole).union(compared).union(crowded)


def report(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of docs."""
    texts = _text_table(spark, docs)
    spans = covered(spark, texts).groupBy("uid").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    joined = texts.join(spans.hint("merge"), "uid", "left").select("doc_id", "text", "spans")
    return map_batches(spark, joined, _cut_rows, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
