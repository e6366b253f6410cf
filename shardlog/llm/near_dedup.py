"""MinHash near-deduplication with odd sketches.

1. One pass over the texts gives each document's set of distinct word shingles (64-bit hashes) as a 128-bit set fingerprint, band keys
   of its MinHash signature and an odd sketch: every MinHash sample toggles one bit of a small bitmap, so the XOR of two bitmaps counts
   (by parity) the samples that differ, which is most precise for high similarities.
2. Documents with equal sets become one node. Nodes that share a band key are candidates: 32 bands of 4 rows miss a pair of similarity
   0.75 with probability (1 - 0.75**4)**32 = 5e-6.
3. Buckets are compared by sketch inside tasks, nothing is paired in a table; a bucket of over ``block`` nodes is dealt out as pairs
   of blocks. Candidates are pairs whose XOR count is within six standard deviations of what the threshold gives and pass a second,
   lossless test: the XOR of parity bitmaps of the whole sets never counts more bits than the sets differ in, and can't exceed what
   the threshold allows. Of these a task first returns a spanning forest by estimate only. Those are verified on full sets and joined to components. A second pass returns the
   candidates that still lie in different components; verifying these makes the result complete: only pairs already connected, or
   refuted, are left out.
4. Components of the verified links; every document takes its set's component.

Full sets are only made for nodes with candidates. They are picked by a Bloom filter (16 bits an id, 16 MB at most): false positives
cost some space, nothing else. Nothing about single documents comes to the driver, and the texts are never shuffled.

Edge cases: texts that are null, empty or without words have an empty set and are linked with nothing; a text of fewer words than a
shingle is one shingle; rows with a null id are kept and not linked (component null); rows that share an id are one document, linked
by whatever any of them is linked by; other columns are neither read nor kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import Scratch, WordHashes, gram_hashes, mix, partitions, slices
from ._graph import components

BANDS, ROWS, BITS = 32, 4, 512
PARITY_BITS = 2048
BLOOM_BITS = (20, 27)
_K = BANDS * ROWS
_rng = np.random.default_rng(20240501)
_A = (_rng.integers(0, 2**31, _K, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_B = _rng.integers(0, 2**32, _K, dtype=np.uint32)
_SAMPLE = np.arange(_K, dtype=np.uint64) << np.uint64(32)
_BAND = mix(np.arange(1, BANDS + 1, dtype=np.uint64))


def shingles(text: str | None, n: int, words: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles of a text, A-Z lower-cased."""
    parts = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not parts:
        return np.empty(0, np.uint64)
    h = words.of(parts)
    if len(h) < n:
        return gram_hashes(h, len(h)) ^ np.uint64(len(h))
    return np.unique(gram_hashes(h, n))


def minhash(s: np.ndarray) -> np.ndarray:
    x = (s >> np.uint64(32)).astype(np.uint32)
    out = np.full(_K, 2**32 - 1, np.uint32)
    for lo in range(0, len(x), 2048):
        out = np.minimum(out, (_A[:, None] * x[lo : lo + 2048] + _B[:, None]).min(1))
    return out


def odd_sketch(sig: np.ndarray) -> bytes:
    bit = (mix(sig.astype(np.uint64) | _SAMPLE) >> np.uint64(64 - 9)).astype(np.int64)
    return np.packbits(np.bincount(bit, minlength=BITS).astype(np.uint8) & 1).tobytes()


def parity(s: np.ndarray) -> bytes:
    """Odd sketch of a whole set: one bit toggled per element."""
    return np.packbits(np.bincount((s & np.uint64(PARITY_BITS - 1)).astype(np.int64), minlength=PARITY_BITS).astype(np.uint8) & 1).tobytes()


def band_keys(sig: np.ndarray) -> np.ndarray:
    return mix(gram_fold(sig.astype(np.uint64).reshape(BANDS, ROWS)) ^ _BAND)


def gram_fold(m: np.ndarray) -> np.ndarray:
    out = np.zeros(len(m), np.uint64)
    for k in range(m.shape[1]):
        out = mix(out + m[:, k] + np.uint64(k + 1))
    return out


def most_different(similarity: float, sigmas: float = 6.0) -> int:
    """The XOR count that a pair at the threshold exceeds with negligible probability."""
    differ = _K * (1 - similarity) + sigmas * np.sqrt(_K * similarity * (1 - similarity))
    mean = BITS / 2 * (1 - np.exp(-4 * min(differ, _K) / BITS))
    return int(np.ceil(mean + sigmas / 2 * np.sqrt(mean * (1 - mean / BITS) / 2)))


def signatures(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, n_shingles, f1, f2, sketch (of samples, then of the set), bands for every row."""

    def run(batches):
        words = WordHashes()
        for b in slices(batches):
            ns, f, sk, bd = [], [], [], []
            for text in b.column(1).to_pylist():
                s = shingles(text, n, words)
                ns.append(len(s))
                f.append((int(s.sum(dtype=np.uint64)), int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))))
                sig = minhash(s) if len(s) else None
                sk.append(odd_sketch(sig) + parity(s) if len(s) else b"")
                bd.append(band_keys(sig).tobytes() if len(s) else b"")
            f1, f2 = (np.array([x[k] for x in f], np.uint64).view(np.int64) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ns, pa.int64()), pa.array(f1), pa.array(f2), pa.array(sk, pa.binary()), pa.array(bd, pa.binary())], ["doc_id", "n_shingles", "f1", "f2", "sketch", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_shingles long, f1 long, f2 long, sketch binary, bands binary")


def _band_rows(nodes: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            keys = np.frombuffer(b"".join(b.column(1).to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.repeat(b.column(0).to_numpy(), BANDS))], ["bk", "rep"])

    return nodes.select("rep", "bands").mapInArrow(run, "bk long, rep long")


def _runs(batches, keys: int) -> Iterator[list[pa.Array]]:
    """Column lists of each run of equal first ``keys`` columns of a sorted stream."""
    held: list[pa.RecordBatch] = []

    def whole() -> list:
        return pa.Table.from_batches(held).combine_chunks().columns

    last = None
    for b in batches:
        if not b.num_rows:
            continue
        k = np.stack([b.column(i).to_numpy() for i in range(keys)])
        cuts = [0, *(np.flatnonzero((k[:, 1:] != k[:, :-1]).any(0)) + 1).tolist(), b.num_rows]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            now = tuple(k[:, lo])
            if held and now != last:
                yield whole()
                held = []
            held.append(b.slice(lo, hi - lo))
            last = now
    if held:
        yield whole()


def _bucket_pairs(members: DataFrame, percent: int, forest: bool) -> DataFrame:
    """a, b of candidates in each dealt-out bucket whose labels differ; with forest, a spanning forest of them only."""

    def find(up: list[int], i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    most = most_different(percent / 100)

    def run(batches):
        out: list[np.ndarray] = []
        for _, i, j, block, rep, label, size, sketch in _runs(batches, 3):
            rep, label, block, size = (np.asarray(c.to_numpy()) for c in (rep, label, block, size))
            if len(rep) < 2 or (label == label[0]).all():
                continue
            both = np.frombuffer(b"".join(sketch.to_pylist()), np.uint64).reshape(len(rep), -1)
            s, whole = np.ascontiguousarray(both[:, : BITS // 64]), both[:, BITS // 64 :]
            cross = i[0].as_py() != j[0].as_py()
            x, y, d = [], [], []
            for lo in range(0, len(rep), 64):  # bounded temporaries
                dist = np.bitwise_count(s[lo : lo + 64, None] ^ s[None]).sum(2, dtype=np.int32)
                ok = (dist <= most) & (np.arange(lo, min(lo + 64, len(rep)))[:, None] < np.arange(len(rep))) & (label[lo : lo + 64, None] != label)
                if cross:
                    ok &= block[lo : lo + 64, None] != block
                p, q = np.nonzero(ok)
                apart = np.concatenate([np.empty(0, np.int64), *(np.bitwise_count(whole[p[k : k + 4096] + lo] ^ whole[q[k : k + 4096]]).sum(1, dtype=np.int64) for k in range(0, len(p), 4096))])
                may = apart * (100 + percent) <= (100 - percent) * (size[p + lo] + size[q])
                p, q = p[may], q[may]
                x.append(p + lo)
                y.append(q)
                d.append(apart[may])
            x, y, d = map(np.concatenate, (x, y, d))
            if forest:
                up, keep = list(range(len(rep))), []
                for k in np.argsort(d, kind="stable"):
                    u, v = find(up, int(x[k])), find(up, int(y[k]))
                    if u != v:
                        up[u] = v
                        keep.append(k)
                x, y = x[keep], y[keep]
            out.append(np.stack([np.minimum(rep[x], rep[y]), np.maximum(rep[x], rep[y])]))
            if len(out) > 2000:
                yield flush(out)
                out = []
        yield flush(out)

    def flush(out):
        m = np.unique(np.concatenate(out, 1), axis=1) if out else np.empty((2, 0), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(m[0]), pa.array(m[1])], ["a", "b"])

    dealt = members.select("bk", "i", "j", "block", "rep", "label", "n_shingles", "sketch").repartition(partitions(members.sparkSession), "bk", "i", "j").sortWithinPartitions("bk", "i", "j", "rep")
    return dealt.mapInArrow(run, "a long, b long").where("a <> b").distinct()


def _bloom(ids: DataFrame) -> tuple[int, np.ndarray]:
    """Two-hash Bloom filter of the ids: its bits' logarithm (by their number, within BLOOM_BITS) and its words."""
    n = ids.count()
    log = min(max(BLOOM_BITS[0], (16 * n).bit_length()), BLOOM_BITS[1])
    bits = ids.select(F.explode(F.array(*(F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1 << log)) for k in (0, 1)))).alias("bit"))
    words = bits.groupBy(F.shiftright("bit", 5).cast("int").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(bit & 31 as int)))").alias("m"))
    out = np.zeros(1 << (log - 5), np.uint32)
    got = words.toArrow()  # at most as many rows as the filter has words: 4 million
    out[got.column("w").to_numpy()] = got.column("m").to_numpy().astype(np.uint32)
    return log, out


def _sets(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """id, set (sorted 64-bit hashes) of the rows of docs whose id the Bloom filter holds."""
    log, words_ = _bloom(ids)
    sent = docs.sparkSession.sparkContext.broadcast(words_)

    def run(batches):
        words, bloom = WordHashes(), sent.value
        for b in slices(batches):
            at = [b.column(k).to_numpy() for k in (2, 3)]
            hit = np.logical_and(*((bloom[x >> 5] >> (x & 31).astype(np.uint32)) & 1 for x in at))
            rows = np.flatnonzero(hit)
            b = b.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingles(t, n, words).tobytes() for t in b.column(1).to_pylist()], pa.binary())], ["id", "set"])

    d = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("id"), "text")
    return d.select("id", "text", *(F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1 << log)).alias(f"b{k}") for k in (0, 1))).mapInArrow(run, "id long, set binary")


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b, linked (100 * |intersection| >= percent * |union|)."""

    def run(batches):
        for b in slices(batches, 200):
            ok = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(bool(both) and 100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ok, pa.bool_())], ["a", "b", "linked"])

    full = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a").join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b")
    return full.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long, linked boolean")


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 75, block: int = 256) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "near-dedup")
    sig = scratch.save(signatures(docs, n), "signatures")
    n_docs = sig.count()
    key = ["n_shingles", "f1", "f2"]
    nodes = scratch.save(sig.where("doc_id is not null and n_shingles > 0").groupBy(*key).agg(F.min(F.struct("doc_id", "bands", "sketch")).alias("m")).select(*key, F.col("m.doc_id").alias("rep"), "m.bands", "m.sketch"), "nodes", n_docs)
    # An id with several texts is one document: its sets' nodes are linked through it.
    same = sig.where("doc_id is not null and n_shingles > 0").select("doc_id", *key).groupBy("doc_id").agg(F.min(F.struct(*key)).alias("p"), F.max(F.struct(*key)).alias("q")).where("p <> q").select("doc_id").join(sig, "doc_id").where("n_shingles > 0").select("doc_id", *key).distinct().join(nodes.select("rep", *key), key).select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b")
    bands = _band_rows(nodes)
    shared = bands.groupBy("bk").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    rows = scratch.save(bands.join(shared, "bk"), "buckets", n_docs)
    one = rows.groupBy("bk", "m").agg(F.bit_xor(F.xxhash64("rep")).alias("s"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("t"), F.min("rep").alias("lo"), F.max("rep").alias("hi")).groupBy("m", "s", "t", "lo", "hi").agg(F.min("bk").alias("bk")).select("bk")
    parts = F.ceil(F.col("m") / block).cast("int")
    placed = rows.join(one, "bk").join(nodes.select("rep", "n_shingles", "sketch"), "rep").withColumn("block", F.when(F.col("m") > block, F.pmod(F.xxhash64("rep"), parts)).otherwise(0).cast("int"))
    others = F.when(F.col("m") > block, F.sequence(F.lit(0), parts - 1)).otherwise(F.array(F.lit(0)))
    members = scratch.save(placed.select("bk", "rep", "n_shingles", "sketch", "block", F.explode(others).alias("o")).select("bk", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "block", "rep", "n_shingles", "sketch"), "members", n_docs)
    first = scratch.save(_bucket_pairs(members.withColumn("label", F.col("rep")), percent, True), "pairs-1", n_docs)
    sets = scratch.save(_sets(docs, first.select(F.explode(F.array("a", "b")).alias("id")).distinct(), n), "sets")
    seen = scratch.save(_verify(first, sets, percent), "verified-1", n_docs)
    labels = components(seen.where("linked").select("a", "b").union(same), scratch, "cc1", n_docs)
    named = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    second = _bucket_pairs(named, percent, False).join(seen.select("a", "b"), ["a", "b"], "left_anti")
    more = scratch.save(_verify(second, sets, percent).where("linked").select("a", "b"), "verified-2", n_docs)
    # The links between components, then each node's component's component.
    up = lambda c: F.coalesce(f"l{c}", c).alias(c)
    between = more.join(labels.select(F.col("node").alias("a"), F.col("label").alias("la")), "a", "left").join(labels.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b", "left").select(up("a"), up("b"))
    top = components(between, scratch, "cc2", n_docs).select(F.col("node").alias("l1"), F.col("label").alias("l2"))
    final = scratch.save(nodes.select(*key, "rep").join(labels.select(F.col("node").alias("rep"), "label"), "rep", "left").withColumn("l1", F.coalesce("label", "rep")).join(top, "l1", "left").select(*key, F.coalesce("l2", "l1").alias("found")), "classes", n_docs)
    scratch.drop("nodes", "buckets", "members", "pairs-1", "sets", "verified-1", "verified-2")
    got = sig.select("doc_id", *key).join(final, key, "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id")).alias("component_id"))
    return got.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, n: int = 5, percent: int = 75, most: int = 1_000_000) -> DataFrame:
    """The rows of docs, all columns as they are, that are the document of smallest id of their component; one row for each id.

    The ids that go are written first; up to ``most`` of them are broadcast, more are joined by shuffle.
    """
    scratch = Scratch(docs.sparkSession, "keep-one")
    found = scratch.save(near_duplicates(docs, n, percent).select("doc_id", "kept"), "found", docs.count())
    gone = found.where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    if gone.count() <= most:
        gone = F.broadcast(gone)
    left = docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
    if not found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count():
        return left
    # Rows that share an id are one document: the row of the least text hash stays, by an aggregate and not by chance.
    least = left.where("doc_id is not null").groupBy(F.col("doc_id").alias("_one_id")).agg(F.min(F.xxhash64("text")).alias("_one_hash"))
    named = left.join(least, (left["doc_id"] == least["_one_id"]) & (F.xxhash64(left["text"]) == least["_one_hash"]), "left_semi")
    return named.dropDuplicates(["doc_id"]).unionByName(left.where("doc_id is null"))
