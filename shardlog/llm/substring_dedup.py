"""Substring dedup by seed and extend: exact removal of every n-word window that occurs earlier.

Seeds. Each n-word window takes as its anchor the least hashed 6-word run inside it (winnowing: equal windows take equal anchors, at
equal offsets). Neighbouring windows share anchors, so a text has about one anchor per eight words.

Extension. An anchor extends left and right to all windows that chose it; that stretch is a unit. Units are dealt out by anchor. If
all units of an anchor are equal, the first (document, start) stays and every other is removed, in one step for all its windows. If
an anchor has different units (a passage's ends, or a common phrase), the first of each kind goes on to a second pass, where its
windows are compared one by one. Every window's first occurrence is in its unit's first occurrence, so nothing is missed.
Consecutive removed windows make up the maximal repeats, which are never shorter than n words.

Skew. A task first settles its own repeats: of equal units in one bounded segment of the input only the first is sent, and an anchor
with several kinds of units is sent as one marker. So an anchor costs at most one entry per segment however often it occurs, and no
list of occurrences is ever built. Texts move once, to meet the verdicts on them.

Order: rows are ordered by id, null ids last, then by a hash of the text; rows equal in both are one document and get equal results.
Edge cases: null or empty texts have no words; texts under n words are kept; other columns are neither read nor kept by ``digest``
and all kept by ``strip``, which rewrites ``text`` (and ``n_chars``, where there is one) only where words go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import NO_ID, Scratch, WordHashes, gram_hashes, mix, partitions, slices
from .near_dedup import _runs

ANCHOR = 6
SEGMENT = 250_000
REMOVE, AGAIN = 1, 2
_BASE = 0x9E3779B97F4A7C15
_INV = pow(_BASE, -1, 2**64)
#: Fields of an entry: anchor, unit, id, text hash, first window, windows.
_FIELDS = ("<u8", "<u4", "<i8", "<i4", "<i4", "<i4")


def _pack(cols: list[np.ndarray]) -> bytes:
    """Columns byte plane by byte plane, which shuffles compress well."""
    return b"".join(np.ascontiguousarray(np.ascontiguousarray(c, t).view(np.uint8).reshape(len(c), -1).T).tobytes() for c, t in zip(cols, _FIELDS, strict=True))


def _unpack(blob: bytes) -> list[np.ndarray]:
    widths = [np.dtype(t).itemsize for t in _FIELDS]
    n, at, out = len(blob) // sum(widths), 0, []
    for w, t in zip(widths, _FIELDS, strict=True):
        out.append(np.ascontiguousarray(np.frombuffer(blob, np.uint8, n * w, at).reshape(w, n).T).view(t).ravel())
        at += n * w
    return out


class _Powers:
    """Powers of the base and its inverse modulo 2**64, as far as asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(_BASE, k, 2**64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(_INV, k, 2**64))])
        return self.up, self.down


def units(h: np.ndarray, n: int, powers: _Powers) -> list[np.ndarray]:
    """anchor, unit hash, first window, number of windows of each unit of a text with word hashes h (at least n)."""
    g = gram_hashes(h, ANCHOR)
    best = np.lib.stride_tricks.sliding_window_view(g, n - ANCHOR + 1).argmin(1) + np.arange(len(h) - n + 1)
    first = np.flatnonzero(np.r_[True, best[1:] != best[:-1]])
    count = np.diff(np.r_[first, len(best)])
    up, down = powers.to(len(h) + 1)
    s = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * down[: len(h)], dtype=np.uint64)])
    span = (s[first + count - 1 + n] - s[first]) * up[first]  # hash of the words of all windows of the unit
    shape = ((best[first] - first).astype(np.uint64) << np.uint64(20)) + count.astype(np.uint64)
    return [g[best[first]], (mix(mix(span) + shape) >> np.uint64(32)).astype(np.uint32), first.astype(np.int32), count.astype(np.int32)]


def windows(h: np.ndarray, n: int, starts: np.ndarray) -> list[np.ndarray]:
    """The same four for single windows: two independent hashes in place of anchor and unit."""
    a, b = gram_hashes(h, n, 0), gram_hashes(h, n, 1)
    return [a[starts], (b[starts] >> np.uint64(32)).astype(np.uint32), starts.astype(np.int32), np.ones(len(starts), np.int32)]


def _same(cols: list[np.ndarray], at: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether the entries at ``at`` have the place (id, text hash, window) of those at ``first``."""
    return (cols[2][at] == cols[2][first]) & (cols[3][at] == cols[3][first]) & (cols[4][at] == cols[4][first])


def _settle(cols: list[np.ndarray], mixed_goes_on: bool) -> tuple[list[np.ndarray], list[list[np.ndarray]]]:
    """Of one segment: entries to send on, and verdicts (id, text hash, window, windows, kind)."""
    h, c, k, f, lo, n = cols = [x[o] for o in [np.lexsort((cols[4], cols[3], cols[2], cols[1], cols[0]))] for x in cols]
    new_h = np.r_[True, h[1:] != h[:-1]]
    new = new_h | np.r_[True, c[1:] != c[:-1]]
    at = np.arange(len(h))
    start = np.maximum.accumulate(np.where(new, at, 0))
    again = ~new & ~_same(cols, at, start)
    verdicts = [[k[again], f[again], lo[again], n[again], np.full(int(again.sum()), REMOVE, np.int32)]]
    if not mixed_goes_on:
        return [x[new] for x in cols], verdicts
    heads = np.flatnonzero(new_h)
    several = np.add.reduceat(new.astype(np.int64), heads) > 1
    mixed = np.repeat(several, np.diff(np.r_[heads, len(h)]))
    on = new & mixed
    verdicts.append([k[on], f[on], lo[on], n[on], np.full(int(on.sum()), AGAIN, np.int32)])
    send = new & (~mixed | new_h)
    mark = send & mixed
    cols = [x.copy() for x in cols]
    cols[2][mark] = -1
    for x in (1, 3, 4, 5):
        cols[x][mark] = 0
    return [x[send] for x in cols], verdicts


def _judge(cols: list[np.ndarray], mixed_goes_on: bool) -> list[np.ndarray]:
    """Verdicts on all entries of some anchors."""
    if mixed_goes_on:
        h, c, k, f, lo, n = cols = [x[o] for o in [np.lexsort((cols[4], cols[3], cols[2], cols[0]))] for x in cols]
        new = np.r_[True, h[1:] != h[:-1]]
        heads = np.flatnonzero(new)
        several = (k[heads] < 0) | (np.minimum.reduceat(c, heads) != np.maximum.reduceat(c, heads))
        mixed = np.repeat(several, np.diff(np.r_[heads, len(h)]))
    else:
        h, c, k, f, lo, n = cols = [x[o] for o in [np.lexsort((cols[4], cols[3], cols[2], cols[1], cols[0]))] for x in cols]
        new = np.r_[True, (h[1:] != h[:-1]) | (c[1:] != c[:-1])]
        mixed = np.zeros(len(h), bool)
    at = np.arange(len(h))
    start = np.maximum.accumulate(np.where(new, at, 0))
    kind = np.where(mixed, AGAIN, np.where(new | _same(cols, at, start), 0, REMOVE)).astype(np.int32)
    use = (kind > 0) & (k >= 0)
    return [k[use], f[use], lo[use], n[use], kind[use]]


def _by_document(verdicts: list[list[np.ndarray]]) -> pa.RecordBatch | None:
    """_k, _f, marks: one row per document, marks being its (window, windows, kind) triples."""
    k, f, lo, n, kind = (np.concatenate(x) for x in zip(*verdicts, strict=True))
    if not len(k):
        return None
    o = np.lexsort((lo, f, k))
    k, f, lo, n, kind = k[o], f[o], lo[o], n[o], kind[o]
    heads = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (f[1:] != f[:-1])])
    body = np.ascontiguousarray(np.stack([lo, n, kind], 1), "<i4")
    ends = np.r_[heads, len(k)].astype(np.int32) * 12
    marks = pa.Array.from_buffers(pa.binary(), len(heads), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(body.tobytes())])
    return pa.RecordBatch.from_arrays([pa.array(k[heads]), pa.array(f[heads]), marks], ["_k", "_f", "marks"])


_DEALT = "bucket int, direct boolean, entries binary"
_MARKS = "_k long, _f int, marks binary"


def _deal(entries: Iterator[list[np.ndarray]], buckets: int, mixed_goes_on: bool, settle=_settle) -> Iterator[pa.RecordBatch]:
    """Rows for the exchange, from entries of one task; at most SEGMENT (and one text's) entries are held."""

    def out(held):
        sent, verdicts = settle([np.concatenate(x) for x in zip(*held, strict=True)], mixed_goes_on)
        to = ((sent[0] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        cuts = np.searchsorted(to, np.arange(buckets + 1))
        rows = [(b, False, _pack([x[lo:hi] for x in sent])) for b, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False)) if hi > lo]
        k, f, lo, n, kind = (np.concatenate(x) for x in zip(*verdicts, strict=True))
        to = (mix(k.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        o = np.argsort(to, kind="stable")
        cuts = np.searchsorted(to[o], np.arange(buckets + 1))
        rows += [(b, True, _pack([kind[i].astype(np.uint64), np.zeros(len(i)), k[i], f[i], lo[i], n[i]])) for b, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False)) if z > a for i in [o[a:z]]]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.bool_()), pa.array([r[2] for r in rows], pa.binary())], ["bucket", "direct", "entries"])

    held, n = [], 0
    for e in entries:
        held.append(e)
        n += len(e[0])
        if n >= SEGMENT:
            yield out(held)
            held, n = [], 0
    if held:
        yield out(held)


def _verdicts(dealt: DataFrame, buckets: int, mixed_goes_on: bool, judge=_judge) -> DataFrame:
    def run(batches):
        for _, direct, blobs in _runs(batches, 1):
            direct, blobs = direct.to_pylist(), blobs.to_pylist()
            found = []
            if mine := [_unpack(b) for d, b in zip(direct, blobs, strict=True) if not d]:
                found.append(judge([np.concatenate(x) for x in zip(*mine, strict=True)], mixed_goes_on))
            for d, b in zip(direct, blobs, strict=True):
                if d:
                    kind, _, k, f, lo, n = _unpack(b)
                    found.append([k, f, lo, n, kind.astype(np.int32)])
            if (b := _by_document(found)) is not None:
                yield b

    # A bucket has its share of the anchors, each at most once per segment of the input.
    return dealt.repartition(partitions(dealt.sparkSession), "bucket").sortWithinPartitions("bucket").mapInArrow(run, _MARKS).groupBy("_k", "_f").agg(F.collect_list("marks").alias("_marks"))


def _triples(marks: list[bytes] | None) -> np.ndarray:
    return np.frombuffer(b"".join(marks or []), "<i4").reshape(-1, 3)


def _covered(marks: np.ndarray, words: int, n: int) -> np.ndarray:
    """Which words the removed windows cover."""
    d = np.zeros(words + 1, np.int64)
    gone = marks[marks[:, 2] == REMOVE]
    np.add.at(d, gone[:, 0], 1)
    np.add.at(d, gone[:, 0] + gone[:, 1] - 1 + n, -1)
    return np.cumsum(d)[:words] > 0


def _split(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def _without(text: str, gone: np.ndarray) -> str:
    """The text without the words that are gone; what stays keeps its own white space."""
    raw, at, out = text.encode("utf-8", "surrogatepass"), 0, []
    for word, drop in zip(raw.split(), gone, strict=True):
        here = raw.index(word, at)
        if not drop:
            out.append(raw[at:here] + word)
        at = here + len(word)
    return b"".join(out).strip(b" \t\n\x0b\x0c\r").decode("utf-8", "surrogatepass")


def _remove(docs: DataFrame, n: int, strip: bool) -> DataFrame:
    spark = docs.sparkSession
    scratch = Scratch(spark, "substring-dedup")
    buckets = 4 * partitions(spark)
    keyed = docs.select("*", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_k"), F.coalesce(F.xxhash64("text").bitwiseAND(0x7FFFFFFF), F.lit(0)).cast("int").alias("_f"))

    def seeds(batches):
        words, powers = WordHashes(), _Powers()

        def entries():
            for b in slices(batches):
                for text, k, f in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    parts = _split(text)
                    if len(parts) >= n:
                        a, c, lo, m = units(words.of(parts), n, powers)
                        yield [a, c, np.full(len(a), k, np.int64), np.full(len(a), f, np.int32), lo, m]

        yield from _deal(entries(), buckets, True)

    found = keyed.select("text", "_k", "_f").mapInArrow(seeds, _DEALT)
    marks = scratch.save(_verdicts(found, buckets, True), "marks", docs.count())
    # The texts meet the verdicts twice, by the same exchange: Spark writes it once and reads it again for the second pass's verdicts.
    met = keyed.join(marks, ["_k", "_f"], "left").select(*docs.columns, "_k", "_f", "_marks")
    width = len(docs.columns)

    def singles(batches):
        words = WordHashes()

        def entries():
            for b in slices(batches):
                for text, k, f, got in zip(b.column(b.schema.get_field_index("text")).to_pylist(), *(b.column(width + i).to_pylist() for i in range(3)), strict=True):
                    m = _triples(got)
                    on = m[m[:, 2] == AGAIN]
                    if len(on):
                        starts = np.unique(np.concatenate([np.arange(lo, lo + c) for lo, c, _ in on]))
                        a, c, lo, one = windows(words.of(_split(text)), n, starts)
                        yield [a, c, np.full(len(a), k, np.int64), np.full(len(a), f, np.int32), lo, one]

        yield from _deal(entries(), buckets, False)

    more = _verdicts(met.mapInArrow(singles, _DEALT), buckets, False).withColumnRenamed("_marks", "_more")
    whole = met.join(more, ["_k", "_f"], "left").select(*docs.columns, "_marks", "_more")
    at = {c: i for i, c in enumerate(docs.columns)}
    out = docs.schema if strip else T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())])
    out = T.StructType([T.StructField(f.name, f.dataType, True) for f in out.fields])

    def apply(batches):
        for b in slices(batches):
            cols = list(b.columns[:width])
            texts, sizes, removed, digests, n_chars = [], [], [], [], None
            if strip and "n_chars" in at:
                n_chars = cols[at["n_chars"]].to_pylist()
            for i, (text, got, late) in enumerate(zip(cols[at["text"]].to_pylist(), b.column(width).to_pylist(), b.column(width + 1).to_pylist(), strict=True)):
                parts = _split(text)
                gone = _covered(_triples([*(got or []), *(late or [])]), len(parts), n)
                some = int(gone.sum())
                if strip:
                    texts.append(_without(text, gone) if some else text)
                    if some and n_chars is not None:
                        n_chars[i] = len(texts[-1])
                else:
                    left = [w for w, g in zip(parts, gone.tolist(), strict=True) if not g] if some else parts
                    digests.append(hashlib.sha256(b" ".join(left)).hexdigest())
                    sizes.append(len(parts))
                    removed.append(some)
            if not strip:
                cols = [cols[at["doc_id"]].cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
            else:
                cols[at["text"]] = pa.array(texts, pa.string())
                if n_chars is not None:
                    cols[at["n_chars"]] = pa.array(n_chars, cols[at["n_chars"]].type)
            yield pa.RecordBatch.from_arrays(cols, out.names)

    return whole.mapInArrow(apply, out)


def digest(docs: DataFrame, n: int = 20) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row of docs."""
    return _remove(docs.select("doc_id", "text"), n, False)


def strip(docs: DataFrame, n: int = 20) -> DataFrame:
    """The rows and columns of docs, their texts without what occurs earlier. Other columns may have any names."""
    ours = {"doc_id", "text", "n_chars"}
    names = [c if c in ours else f"other_{i}" for i, c in enumerate(docs.columns)]
    return _remove(docs.toDF(*names), n, True).toDF(*docs.columns)
