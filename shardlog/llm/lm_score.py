"""Language-model scores by context-tree weighting (CTW), beside a unigram baseline.

A text is its UTF-8 bytes with A-Z lower-cased, then one end byte (0); the contexts of a byte are the 0 to ``DEPTH`` bytes before it
(zeros before the start). Each byte is eight binary decisions from the top bit down, so a node of the model is (context, bits already
known), with counts of zeros and ones. A node's weighted probability mixes its own Krichevsky-Trofimov estimate with the product
over its longer contexts, half and half at every depth; both depend on the counts alone, so counting is a distributed sum over the
whole training corpus and the weights follow bottom-up, the predictive mixtures top-down.

Size. Counts of all byte (DEPTH+1)-grams are gathered, and every node seen in training keeps its own counts, however rare. Grams are
dealt out by their last CUT context bytes; all longer contexts that end in these are in one task, which weighs its subtrees. Only the
weights of nodes of under CUT context bytes (at most 65,793 contexts times 255, whatever the input) come to the driver and go back by
broadcast; then each task works out the code lengths of its grams, those of held-out texts too. They are a stored table: the most
frequent ones, up to ``FREQUENT``, are broadcast, which saves time only; all others are looked up by a join.

Baseline: log10((c + 0.5) / (N + 0.5 * (V + 1))) summed over the tokens and one end token, from exact counts of all training tokens.
Words with at least 1/2**RESOLUTION of all tokens are broadcast (at most 2**RESOLUTION); all others are looked up by a join.

Edge cases: a null text is empty and still has its end; a null id is never held out; repeated rows are scored each; without training
texts every bit has probability 1/2 and every token 1; other columns are neither read nor kept.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import Scratch, slices

DEPTH = 5
#: Nodes with at least so many context bytes are weighed in tasks, the others on the driver.
CUT = 3
RESOLUTION = 20
#: Grams whose code lengths are broadcast at most, and grams a task weighs on average.
FREQUENT = 1 << 20
GRAMS = 50_000
#: Stands for the end token in the word counts; words have no spaces.
END = b" "
_L10 = np.log(10.0)


def text_bytes(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass").lower() if text else b""


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All (DEPTH+1)-grams of the texts with their ends, the byte itself lowest; and where each text's begin."""
    pad = bytes(DEPTH)
    a = np.frombuffer(b"".join(x for t in texts for x in (pad, t, b"\0")), np.uint8).astype(np.uint64)
    g = np.zeros(max(0, len(a) - DEPTH), np.uint64)
    for k in range(DEPTH + 1):
        g = g << np.uint64(8) | a[k : len(a) - DEPTH + k]
    lens = np.array([len(t) + 1 for t in texts], np.int64)
    first = np.concatenate([[0], np.cumsum(lens + DEPTH)[:-1]]).astype(np.int64) if len(texts) else np.empty(0, np.int64)
    keep = np.repeat(first - np.concatenate([[0], np.cumsum(lens)[:-1]]), lens) + np.arange(lens.sum()) if len(texts) else np.empty(0, np.int64)
    return g[keep], np.concatenate([[0], np.cumsum(lens)]).astype(np.int64)


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    k = np.concatenate(keys)
    o = np.argsort(k, kind="stable")
    k = k[o]
    at = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.empty(0, np.int64)
    return k[at], *(np.add.reduceat(np.concatenate(c)[o], at) if len(k) else np.concatenate(c) for c in zip(*counts, strict=True))


def count_corpus(docs: DataFrame) -> DataFrame:
    """key, n: 'g' + 8 bytes for a gram, 'w' + bytes for a word (END for the end token), over all training texts; grams of held-out texts with 0."""

    def run(batches):
        words: Counter = Counter()
        keys, counts, held = [], [], 0

        def flush():
            nonlocal keys, counts, held
            if keys:
                k, n = _merge(keys, [(c,) for c in counts])
                raw = np.empty((len(k), 9), np.uint8)
                raw[:, 0] = ord("g")
                raw[:, 1:] = k.astype(">u8").view(np.uint8).reshape(-1, 8)
                ends = (np.arange(len(k) + 1, dtype=np.int32) * 9).tobytes()
                yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), len(k), [None, pa.py_buffer(ends), pa.py_buffer(raw.tobytes())]), pa.array(n.astype(np.int64))], ["key", "n"])
            if words:
                yield pa.RecordBatch.from_arrays([pa.array([b"w" + w for w in words], pa.binary()), pa.array(list(words.values()), pa.int64())], ["key", "n"])
            words.clear()
            keys, counts, held = [], [], 0

        for b in slices(batches):
            texts = [text_bytes(t) for t in b.column(0).to_pylist()]
            out = b.column(1).to_pylist()
            for lo in range(0, len(texts), 500):
                part = [t for t, h in zip(texts[lo : lo + 500], out[lo : lo + 500], strict=True) if not h]
                for t in part:
                    words.update(t.split())
                if part:
                    words[END] += len(part)
                for some, seen in ((part, 1), ([t for t, h in zip(texts[lo : lo + 500], out[lo : lo + 500], strict=True) if h], 0)):
                    k, n = np.unique(grams(some)[0], return_counts=True)
                    keys.append(k)
                    counts.append(n * seen)
                    held += len(k)
                if held > 4_000_000:
                    k, n = _merge(keys, [(c,) for c in counts])
                    keys, counts, held = [k], [n], len(k)
                if len(words) > 500_000 or held > 2_000_000 and len(keys) == 1:
                    yield from flush()
        yield from flush()

    return docs.select("text", "held_out").mapInArrow(run, "key binary, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _nodes(g: np.ndarray, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each of the eight bits of the grams' last bytes: node keys at a depth, and the bits."""
    ctx = (g >> np.uint64(8)) & np.uint64((1 << 8 * depth) - 1)
    byte, out = g & np.uint64(255), []
    for bit in range(8):
        node = np.uint64(1 << bit) | byte >> np.uint64(8 - bit)
        out.append((np.uint64(depth) << np.uint64(56) | ctx << np.uint64(8) | node, byte >> np.uint64(7 - bit) & np.uint64(1)))
    return out


def node_counts(g: np.ndarray, n: np.ndarray, depths: range) -> tuple[np.ndarray, ...]:
    """node, n0, n1 of all nodes of the depths that were seen."""
    g, n = g[n > 0], n[n > 0]
    parts = []
    for depth in depths:
        got = _nodes(g, depth)
        parts.append(_merge([x for x, _ in got], [(np.where(bit == 0, n, 0), np.where(bit == 1, n, 0)) for _, bit in got]))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _parents(keys: np.ndarray) -> np.ndarray:
    """The nodes of one context byte less."""
    depth = (keys >> np.uint64(56)) - np.uint64(1)
    ctx = keys >> np.uint64(8) & (np.uint64(1) << np.uint64(8) * depth) - np.uint64(1)
    return depth << np.uint64(56) | ctx << np.uint64(8) | keys & np.uint64(255)


def _lgamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for x > 0, by Stirling's series after eight steps up."""
    shift = sum(np.log(x + k) for k in range(8))
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


def _kt_block(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _lgamma(a + 0.5) + _lgamma(b + 0.5) - _lgamma(a + b + 1.0) - np.log(np.pi)


@dataclass
class Tree:
    """keys: nodes, sorted; one: probability that the next bit is 1 where no longer context was seen; weighted: log weights; said, left:
    what the nodes up to this one give to that probability, and the share that is left to longer contexts."""

    keys: np.ndarray
    one: np.ndarray
    weighted: np.ndarray
    said: np.ndarray
    left: np.ndarray

    @classmethod
    def build(cls, keys: np.ndarray, n0: np.ndarray, n1: np.ndarray, below: np.ndarray | None = None, above: Tree | None = None) -> Tree:
        """below: for each node, the log weights of its children that are not among the keys; above: tree of the parents that are not."""
        o = np.argsort(keys)
        keys, n0, n1 = keys[o].astype(np.uint64), n0[o].astype(np.float64), n1[o].astype(np.float64)
        below = np.zeros(len(keys)) if below is None else below[o].copy()
        depth = (keys >> np.uint64(56)).astype(np.int64)
        cuts = np.searchsorted(depth, np.arange(DEPTH + 2))
        first = int(depth[0]) if len(keys) else 0
        up = np.full(len(keys), -1)
        for d in range(first + 1, DEPTH + 1):
            s = slice(cuts[d], cuts[d + 1])
            up[s] = np.searchsorted(keys, _parents(keys[s]))  # seen as the child was
        own = _kt_block(n0, n1)
        weighted, share = own.copy(), np.ones(len(keys))  # share: of the node's own estimate
        for d in range(DEPTH, first - 1, -1):
            s = slice(cuts[d], cuts[d + 1])
            if d < DEPTH:
                weighted[s] = np.logaddexp(own[s], below[s]) - np.log(2)
                share[s] = 1 / (1 + np.exp(np.clip(below[s] - own[s], -700, 700)))
            if d > first:
                np.add.at(below, up[s], weighted[s])
        kt = (n1 + 0.5) / (n0 + n1 + 1)
        said, left = np.zeros(len(keys)), np.ones(len(keys))
        for d in range(first, DEPTH + 1):
            s = slice(cuts[d], cuts[d + 1])
            if d > first:
                base, open_ = said[up[s]], left[up[s]]
            elif above is not None and len(above.keys):
                at = np.searchsorted(above.keys, _parents(keys[s]))
                base, open_ = above.said[at], above.left[at]
            else:
                base, open_ = 0.0, 1.0
            said[s], left[s] = base + open_ * share[s] * kt[s], open_ * (1 - share[s])
        return cls(keys, np.clip(said + left * 0.5, 1e-12, 1 - 1e-12), weighted, said, left)

    def with_subtrees(self, g: np.ndarray, n: np.ndarray) -> Tree:
        """This tree of all nodes under CUT, and below it what the grams add."""
        sub = Tree.build(*node_counts(g, n, range(CUT, DEPTH + 1)), above=self)
        return Tree(*(np.concatenate([getattr(self, x), getattr(sub, x)]) for x in ("keys", "one", "weighted", "said", "left")))

    def log10(self, g: np.ndarray) -> np.ndarray:
        """log10 probability of each gram's last byte after its others."""
        out = np.zeros(len(g))
        p = np.full((8, len(g)), 0.5)
        bits = [bit for _, bit in _nodes(g, 0)]
        for d in range(DEPTH + 1):
            for k, (key, _) in enumerate(_nodes(g, d)):
                at = np.minimum(np.searchsorted(self.keys, key), max(0, len(self.keys) - 1))
                hit = self.keys[at] == key if len(self.keys) else np.zeros(len(g), bool)
                p[k][hit] = self.one[at[hit]]
        for k in range(8):
            out += np.log(np.where(bits[k] == 1, p[k], 1 - p[k]))
        return out / _L10


class Lookup:
    """Hash table of the frequent grams' values; grams given must be in order of their frequency."""

    def __init__(self, frequent: np.ndarray, values: np.ndarray):
        self.bits = max(10, int(np.ceil(np.log2(len(frequent) + 1))) + 2)
        self.keys = np.full(1 << self.bits, 2**64 - 1, np.uint64)
        self.values = np.zeros(1 << self.bits)
        at = self._slot(frequent)
        self.keys[at], self.values[at] = frequent, values  # of grams that share a slot the last stays
        lost = np.flatnonzero(self.keys[at] != frequent)  # the others are kept in order
        lost = lost[np.argsort(frequent[lost])]
        self.more, self.more_values = np.r_[frequent[lost], np.uint64(2**64 - 1)], np.r_[values[lost], 0.0]

    def _slot(self, g: np.ndarray) -> np.ndarray:
        return ((g * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def log10(self, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values (0 where there is none), and the places that have none."""
        at = self._slot(g)
        out = self.values[at]
        miss = np.flatnonzero(self.keys[at] != g)
        at = np.searchsorted(self.more, g[miss])
        hit = self.more[at] == g[miss]
        out[miss] = np.where(hit, self.more_values[at], 0.0)
        return out, miss[~hit]


def _gram_columns(batches) -> tuple[np.ndarray, np.ndarray]:
    got = [(b.column(0).to_numpy().astype(np.uint64), b.column(1).to_numpy()) for b in batches if b.num_rows]
    return tuple(map(np.concatenate, zip(*got, strict=True))) if got else (np.empty(0, np.uint64), np.empty(0, np.int64))


def code_lengths(counts: DataFrame, distinct: int) -> DataFrame:
    """g, n, value (log10 probability of the last byte) of all grams counted."""
    spark = counts.sparkSession
    dealt = counts.select("g", "n").repartition(max(16, -(-distinct // GRAMS)), F.shiftright("g", 8).bitwiseAND(F.lit((1 << 8 * CUT) - 1)))

    def roots(batches):
        tree = Tree.build(*(x := node_counts(*_gram_columns(batches), range(CUT, DEPTH + 1))))
        o = np.argsort(x[0])
        cut = int(np.searchsorted(tree.keys, np.uint64(CUT + 1) << np.uint64(56)))
        k, n0, n1, w = _merge([_parents(tree.keys[:cut])], [(x[1][o][:cut], x[2][o][:cut], tree.weighted[:cut])])
        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int64)), pa.array(n0), pa.array(n1), pa.array(w)], ["node", "n0", "n1", "below"])

    top = dealt.mapInArrow(roots, "node long, n0 long, n1 long, below double").groupBy("node").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("below").alias("below")).toArrow()
    k, n0, n1, below = (top.column(c).to_numpy() for c in ("node", "n0", "n1", "below"))
    keys, zeros, ones, weights = [k.astype(np.uint64)], [n0], [n1], [below]
    for _ in range(CUT - 1):
        k, a, b = _merge([_parents(keys[-1])], [(zeros[-1], ones[-1])])
        keys, zeros, ones, weights = [*keys, k], [*zeros, a], [*ones, b], [*weights, np.zeros(len(k))]
    tree = Tree.build(*map(np.concatenate, (keys, zeros, ones, weights)))
    sent = spark.sparkContext.broadcast((tree.keys, tree.one, tree.weighted, tree.said, tree.left))

    def valued(batches):
        g, n = _gram_columns(batches)
        whole = Tree(*sent.value).with_subtrees(g, n)
        for i in range(0, len(g), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(g[i : i + 50_000].astype(np.int64)), pa.array(n[i : i + 50_000]), pa.array(whole.log10(g[i : i + 50_000]))], ["g", "n", "value"])

    return dealt.mapInArrow(valued, "g long, n long, value double")


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte for every row of docs."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "lm-score")
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    counts = scratch.save(count_corpus(d), "counts")
    kind = F.substring("key", 1, 1)
    sizes = {bytes(r["k"]): (r["n"], r["v"]) for r in counts.groupBy(kind.alias("k")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
    distinct = sizes.get(b"g", (0, 0))[1]
    n_all, vocabulary = sizes.get(b"w", (0, 0))
    values = scratch.save(code_lengths(counts.where(kind == F.lit(b"g")).select(F.conv(F.hex(F.substring("key", 2, 8)), 16, 10).cast("long").alias("g"), "n"), distinct), "values")
    level = F.floor(F.log2(F.col("n") + 1) * 16)
    least, room = 2**31, FREQUENT
    for r in sorted(values.groupBy(level.alias("l")).count().collect(), reverse=True):  # some hundred rows
        room -= r["count"]
        if room < 0:
            break
        least = r["l"]
    often = values.where(level >= least).toArrow()  # at most FREQUENT
    order = np.argsort(often.column("n").to_numpy(), kind="stable")
    frequent, lengths = often.column("g").to_numpy().astype(np.uint64)[order], often.column("value").to_numpy()[order]
    del often
    known = counts.where((kind == F.lit(b"w")) & (F.col("n") >= max(1, n_all >> RESOLUTION))).select(F.expr("substring(key, 2)").alias("w"), "n").toArrow()
    floor = float(np.log10(n_all + 0.5 * (vocabulary + 1)))
    sent = spark.sparkContext.broadcast((frequent, lengths, dict(zip(known.column("w").to_pylist(), np.log10(known.column("n").to_numpy() + 0.5).tolist(), strict=True))))

    def run(batches):
        frequent, lengths, words = sent.value
        lookup, get, end = Lookup(frequent, lengths), words.get, words.get(END)
        for b in slices(batches):
            texts = [text_bytes(t) for t in b.column(2).to_pylist()]
            out: list[np.ndarray] = []
            others: list[tuple[np.ndarray, ...]] = []  # text, gram, times
            group, size, begin = [], 0, 0
            for i, t in enumerate(texts):  # bounded temporaries
                group.append(t)
                size += len(t)
                if size > 2_000_000 or i == len(texts) - 1:
                    g, at = grams(group)
                    got, miss = lookup.log10(g)
                    out.append(np.add.reduceat(got, at[:-1]))
                    who = np.searchsorted(at, miss, "right") - 1
                    miss = g[miss]
                    o = np.lexsort((miss, who))
                    who, miss = who[o], miss[o]
                    new = np.flatnonzero(np.r_[True, (who[1:] != who[:-1]) | (miss[1:] != miss[:-1])]) if len(who) else np.empty(0, np.int64)
                    others.append((who[new] + begin, miss[new].astype(np.int64), np.diff(np.r_[new, len(who)])))
                    group, size, begin = [], 0, i + 1
            who, miss, often = map(np.concatenate, zip(*others, strict=True)) if others else [np.empty(0, np.int64)] * 3
            ends = pa.array(np.searchsorted(who, np.arange(len(texts) + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (miss, often)]
            tokens, seen, base, names, ns = [], [], [], [], []
            for t in texts:
                parts, m, s, rest, times = t.split(), 0, 0.0, [], []
                for w, n in Counter(parts).items():
                    v = get(w)
                    if v is None:
                        rest.append(w)
                        times.append(n)
                    else:
                        m += n
                        s += n * v
                tokens.append(len(parts) + 1)
                if end is None:
                    rest.append(END)
                    times.append(1)
                else:
                    m, s = m + 1, s + end
                seen.append(m)
                base.append(s)
                names.append(rest)
                ns.append(times)
            total = np.concatenate(out) if out else np.empty(0)
            lens = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(tokens, pa.int64()), pa.array(seen, pa.int64()), pa.array(base, pa.float64()), pa.array(total, pa.float64()), lens, pa.array(names, pa.list_(pa.binary())), pa.array(ns, pa.list_(pa.int64())), *lists], ["doc_id", "held_out", "n_tokens", "seen", "base", "score", "n_bytes", "rare", "times", "grams", "often"])

    rows = scratch.save(d.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, seen long, base double, score double, n_bytes long, rare array<binary>, times array<long>, grams array<long>, often array<long>").withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = rows.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("w"), F.col("x.times").alias("t"))
    table = counts.where(kind == F.lit(b"w")).select(F.expr("substring(key, 2)").alias("w"), "n")
    c = F.coalesce("n", F.lit(0))
    looked = rare.join(table, "w", "left").groupBy("row").agg(F.sum(F.when(c > 0, F.col("t")).otherwise(0)).alias("more"), F.sum(F.col("t") * F.log10(c + 0.5)).alias("add"))
    far = rows.select("row", F.explode(F.arrays_zip("grams", "often")).alias("x")).select("row", F.col("x.grams").alias("g"), F.col("x.often").alias("t"))
    coded = far.join(values.where(level < least).select("g", "value"), "g").groupBy("row").agg(F.sum(F.col("t") * F.col("value")).alias("far"))
    full = rows.drop("rare", "times", "grams", "often").join(looked, "row", "left").join(coded, "row", "left").withColumn("score", F.col("score") + F.coalesce("far", F.lit(0.0)))
    zero = F.lit(0)
    return full.select("doc_id", "held_out", "n_tokens", (F.col("seen") + F.coalesce("more", zero)).alias("n_known"), F.lit(int(n_all)).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("add", zero) - F.col("n_tokens") * F.lit(floor)).alias("base_score"), "score", (-F.col("score") * F.lit(float(np.log2(10.0))) / (F.col("n_bytes") + 1)).alias("bits_per_byte"))
