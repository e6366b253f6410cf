"""Toxicity: a linear classifier on character n-grams whose features are scaled by naive Bayes log-count ratios.

Every distinct n-gram of 3 to 5 characters of the lower-cased text is a binary feature (hashed to 2**18 slots). A slot's value is
its log-count ratio r = log P(slot | toxic) - log P(slot | clean); a logistic regression is fitted on the scaled features, so a
text's log-odds are b + sum of r*w over its distinct slots: one addition per slot, no shuffle and no state between texts.

Training reads a bounded sample: the ``per_class`` labelled rows of each class with the smallest hashed ids (default 2,500). Class
weights restore the class shares that all training labels have. Scoring reads every whole text.

Nulls and edge cases: a null or empty text has no features and gets the prior score; a null id is never held out; label rows with a
null id or label are left out; several labels of one id count as the highest; with no usable labels, or only one class, every text
gets the share of toxic labels (0 when there are none). Repeated rows are scored alike. Other columns are neither read nor kept.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import crc_mod, slices, smallest_hashed

ORDERS = (3, 4, 5)
BITS = 18
THRESHOLD = 0.3
_MUL = np.uint32(0x9E3779B1)


def _slots(text: str | None, seen: np.ndarray) -> np.ndarray:
    """The distinct slots of a text's n-grams. seen: scratch of 2**BITS int32, no need to clear it."""
    if not text:
        return np.empty(0, np.int32)
    c = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    out, acc = [], np.zeros(len(c), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        if len(c) < n:
            break
        acc = acc[: len(c) - n + 1] * _MUL + c[n - 1 :]
        if n in ORDERS:
            out.append(((acc ^ (acc >> np.uint32(15))) * np.uint32(0x85EBCA6B + 2 * n)) >> np.uint32(32 - BITS))
    if not out:
        return np.empty(0, np.int32)
    h = np.concatenate(out).astype(np.int32)
    at = np.arange(len(h), dtype=np.int32)
    seen[h] = at
    return h[seen[h] == at]


def _pack(slots: np.ndarray) -> bytes:
    """Distinct slots, sorted, as a byte or so each: the gap to the one before as bytes of 255 and a last one below that."""
    gap = np.diff(np.sort(slots), prepend=np.int32(0))
    out = np.full(len(gap) + int((gap // 255).sum()), 255, np.uint8)
    out[np.cumsum(gap // 255 + 1) - 1] = gap % 255
    return out.tobytes()


class _Packed:
    """Texts' slots that are unpacked when their turn comes."""

    def __init__(self, texts: list[np.ndarray]):
        self.texts = texts

    def __iter__(self) -> Iterator[np.ndarray]:
        for x in self.texts:
            yield np.cumsum(x, dtype=np.int32)[x != 255]


@dataclass
class ToxicityModel:
    weights: np.ndarray
    bias: float
    seen: np.ndarray = field(default_factory=lambda: np.zeros(1 << BITS, np.int32), repr=False, compare=False)

    def score(self, texts: list[str | None]) -> np.ndarray:
        z = np.array([self.weights[_slots(t, self.seen)].sum(dtype=np.float64) for t in texts], np.float64) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def fit_arrays(docs: Iterable[np.ndarray], y: np.ndarray, prior: float, least_docs: int = 3, least_ratio: float = 0.4, rounds: int = 120, l2: float = 2.0, block: int = 1 << 17) -> ToxicityModel:
    """docs: distinct slots of each sampled text, gone through more than once; y: its label; prior: share of toxic labels among all training labels.
    block: slots of texts that a round works on at once, one text at least, so that its arrays don't grow with the sample."""
    w_out = np.zeros(1 << BITS, np.float32)
    if len(y) == 0 or y.min() == y.max():
        p = min(max(prior, 1e-9), 1 - 1e-9)
        return ToxicityModel(w_out, float(np.log(p / (1 - p))))
    n1, n0 = int(y.sum()), int((1 - y).sum())
    df1 = np.zeros(1 << BITS)
    df0 = np.zeros(1 << BITS)
    for d, label in zip(docs, y, strict=True):
        (df1 if label else df0)[d] += 1
    r = np.log((df1 + 1) / (n1 + 2)) - np.log((df0 + 1) / (n0 + 2))
    use = (df1 + df0 >= least_docs) & (np.abs(r) >= least_ratio)
    new = (np.cumsum(use) - 1).astype(np.int32)
    lens = np.array([np.count_nonzero(use[d]) for d in docs])
    ends = np.concatenate([[0], np.cumsum(lens)])
    idx = np.empty(ends[-1], np.int32)
    for k, d in enumerate(docs):
        idx[ends[k] : ends[k + 1]] = new[d[use[d]]]
    blocks, at = [], 0  # of whole texts
    while at < len(y):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + block, "right")) - 1)
        blocks.append((slice(at, to), slice(int(ends[at]), int(ends[to]))))
        at = to
    rr, m = r[use], int(use.sum())
    cost = np.where(y == 1, prior / n1, (1 - prior) / n0) * len(y)
    scale = 1 / np.sqrt(max(1.0, lens.mean()))
    val = rr * scale

    def margins(v: np.ndarray, b: float) -> np.ndarray:
        out, w = np.empty(len(y)), val * v
        for texts, slots in blocks:
            s = np.concatenate([[0.0], np.cumsum(w[idx[slots]])])
            at = ends[texts.start : texts.stop + 1] - slots.start
            out[texts] = s[at[1:]] - s[at[:-1]]
        return out + b

    def slot_sums(g: np.ndarray) -> np.ndarray:
        out = np.zeros(m)
        for texts, slots in blocks:
            out += np.bincount(idx[slots], weights=np.repeat(g[texts], lens[texts]), minlength=m)
        return out

    v, b = np.zeros(m), float(np.log(prior / (1 - prior)))
    m1, m2, mb1, mb2 = np.zeros(m), np.zeros(m), 0.0, 0.0
    for t in range(1, rounds + 1):  # Adam on the whole sample
        g = cost * (1 / (1 + np.exp(-np.clip(margins(v, b), -50, 50))) - y) / len(y)
        gv, gb = slot_sums(g) * val + l2 * v / len(y) / 10, g.sum()
        m1, m2, mb1, mb2 = 0.9 * m1 + 0.1 * gv, 0.99 * m2 + 0.01 * gv * gv, 0.9 * mb1 + 0.1 * gb, 0.99 * mb2 + 0.01 * gb * gb
        a, c = 1 - 0.9**t, 1 - 0.99**t
        v -= 0.05 * (m1 / a) / (np.sqrt(m2 / c) + 1e-8)
        b -= 0.05 * (mb1 / a) / (np.sqrt(mb2 / c) + 1e-8)
    w_out[use] = val * v
    return ToxicityModel(w_out, float(b))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 2500, held_out_mod: int = 4, held_out_rest: int = 2) -> ToxicityModel:
    """Fit on labelled rows that are not held out; see the module text for the sample."""
    spark = docs.sparkSession
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("y")).where("doc_id is not null and y in (0, 1)").where(crc_mod("doc_id", held_out_mod) != held_out_rest).groupBy("doc_id").agg(F.max("y").alias("y"))
    shares = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(shares.values())
    prior = shares.get(1, 0) / total if total else 0.0
    if len(shares) < 2:
        return fit_arrays([], np.empty(0, np.int64), prior)
    picked = None
    for y in (0, 1):
        part = smallest_hashed(known.where(F.col("y") == y), ["doc_id"], per_class)
        picked = part if picked is None else picked.unionByName(part)
    rows = picked.collect()  # at most 2 * per_class pairs
    picked = spark.createDataFrame(rows, "doc_id long, y int")

    def slots(batches):
        seen = np.zeros(1 << BITS, np.int32)
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([_pack(_slots(t, seen)) for t in b.column(2).to_pylist()], pa.binary())], ["doc_id", "y", "slots"])

    sample = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("doc_id", "y", "text").mapInArrow(slots, "doc_id long, y int, slots binary")
    got = {}
    for r in sample.repartition(8).toLocalIterator():  # eight jobs, whatever the number of partitions; an eighth of the sample at once
        x = bytes(r["slots"])
        got[r["doc_id"], sha256(x).digest()] = x, r["y"]
    rows = [got[k] for k in sorted(got)]
    return fit_arrays(_Packed([np.frombuffer(x, np.uint8) for x, _ in rows]), np.array([y for _, y in rows], np.int64), prior)


def score(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted for every row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))  # 1 MB whatever the input

    def run(batches):
        made = ToxicityModel(*shared.value)
        for b in slices(batches):
            s = made.score(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, predicted int")


def reject(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, all columns as they are, whose text scores under the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    text = docs.columns.index("text")

    def run(batches):
        made = ToxicityModel(*shared.value)
        for b in slices(batches):
            yield b.filter(pa.array(made.score(b.column(text).to_pylist()) < threshold))

    return docs.mapInArrow(run, T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema.fields]))
