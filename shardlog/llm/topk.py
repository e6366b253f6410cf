"""Exact top-k search by inner product: columnar branch and bound.

Candidates are held dimension by dimension (vertical layout). Partial scores of a block of queries are accumulated block of
dimensions by block of dimensions; after each, the Cauchy-Schwarz bound on the mass that remains (norm of the query's remaining
dimensions times the candidate's) drops every pair that can't reach the query's k-th best score so far, and only the surviving pairs
are carried on. The bound is never below the true score, so the result is exact.

Queries are taken in blocks of at most ``block`` bytes of components (default 32 MB, 65,536 queries of 64 dimensions), each broadcast
and held against one scan of all candidates; a task sends at most k rows per query. A block's result is written before the next one
is begun, so neither the plan nor the driver grows with the queries. Within a task, pairs are formed for so many queries at a time
that they stay within ``PAIRS``. No pair is shuffled.

Components are floor(scale * x), x as double. Vectors that are null, empty or hold a null or non-finite component take no part, and
neither do rows with a null id. Repeated rows count each, as in the query's SQL: a query never gets a row with its own id, another id
appears once per row of it, and once more for each further row of the query's id (each with its own vector). So the result does not
depend on how rows are spread over tasks. Vectors of different lengths are only compared with their like. Scores are exact up to 2**53.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import Scratch

STEP = 16
BATCH = 4096
#: Pairs of a query and a candidate that a task looks at together.
PAIRS = 1 << 21


def quantised(df: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """id, v (array<double>) of usable vectors."""
    v = F.col(vec_col).cast("array<double>")
    ok = F.col(id_col).isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return df.where(ok).select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: F.floor(x * F.lit(float(scale))).cast("double")).alias("v"))


def _norms(x: np.ndarray) -> np.ndarray:
    """Norm of what remains from each step on: shape (steps + 1, rows)."""
    steps = range(0, x.shape[1], STEP)
    sq = np.stack([(x[:, s : s + STEP] ** 2).sum(1) for s in steps])
    return np.sqrt(np.vstack([np.cumsum(sq[::-1], 0)[::-1], np.zeros((1, len(x)))])) * (1 + 1e-9)


class Search:
    """Running top-k of a block of queries over any number of candidate batches."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, copies: np.ndarray, k: int):
        self.ids, self.q, self.copies, self.k = ids, q, copies, k
        self.rest = _norms(q)
        self.best = np.full((len(ids), k), -np.inf)
        self.who = np.full((len(ids), k), np.iinfo(np.int64).max)

    def add(self, ids: np.ndarray, x: np.ndarray) -> None:
        rest, columns = _norms(x), np.ascontiguousarray(x.T)
        some = max(1, PAIRS // max(1, len(ids)))
        for lo in range(0, len(self.ids), some):
            self._add(ids, x, rest, columns, lo, lo + some)

    def _add(self, ids: np.ndarray, x: np.ndarray, rest: np.ndarray, columns: np.ndarray, lo: int, hi: int) -> None:
        floor = self.best[:, -1]
        partial = self.q[lo:hi, :STEP] @ columns[:STEP]
        alive = (partial + self.rest[1][lo:hi, None] * rest[1] >= floor[lo:hi, None]) & (self.ids[lo:hi, None] != ids)
        qi, ci = np.nonzero(alive)
        s = partial[qi, ci]
        qi += lo
        for n, at in enumerate(range(STEP, x.shape[1], STEP), 1):
            for lo in range(0, len(qi), 1 << 18):  # bounded temporaries
                a, b = qi[lo : lo + (1 << 18)], ci[lo : lo + (1 << 18)]
                s[lo : lo + (1 << 18)] += np.einsum("ij,ij->i", self.q[a, at : at + STEP], x[b, at : at + STEP])
            keep = s + self.rest[n + 1][qi] * rest[n + 1][ci] >= floor[qi]
            qi, ci, s = qi[keep], ci[keep], s[keep]
        if not len(qi):
            return
        order = np.lexsort((ids[ci], -s, qi))
        qi, ci, s = qi[order], ci[order], s[order]
        first = np.r_[True, qi[1:] != qi[:-1]]
        place = np.arange(len(qi)) - np.maximum.accumulate(np.where(first, np.arange(len(qi)), 0))
        top = place < self.k
        rows = np.unique(qi)
        new, who = np.full((len(rows), self.k), -np.inf), np.full((len(rows), self.k), np.iinfo(np.int64).max)
        at = np.searchsorted(rows, qi[top])
        new[at, place[top]], who[at, place[top]] = s[top], ids[ci[top]]
        new, who = np.hstack([self.best[rows], new]), np.hstack([self.who[rows], who])
        order = np.lexsort((who, -new), axis=1)[:, : self.k]
        self.best[rows], self.who[rows] = np.take_along_axis(new, order, 1), np.take_along_axis(who, order, 1)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b = np.nonzero(np.isfinite(self.best))
        return self.ids[a], self.who[a, b], self.best[a, b].astype(np.int64), self.copies[a]


def search(vectors: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5, scale: float = 256.0, block: int = 32 << 20) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of every row that is_query (a Column on "id") picks."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    usable = quantised(vectors, id_col, vec_col, scale)
    queries = scratch.save(usable.where(is_query).groupBy("id", "v").agg(F.count(F.lit(1)).alias("copies")).withColumn("dim", F.size("v")), "queries")
    out = "query_id long, vec_id long, score long, copies long"
    sizes = queries.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per vector length
    made = 0
    for dim, n in sorted((r["dim"], r["n"]) for r in sizes):
        blocks = -(-n // max(1, block // (8 * dim)))
        for i in range(blocks):
            mine = queries.where((F.col("dim") == dim) & (F.pmod(F.xxhash64("id", "v"), F.lit(blocks)) == i)).select("id", "copies", "v").toArrow().combine_chunks()  # about a block
            if not mine.num_rows:
                continue
            ids, copies = (mine.column(c).to_numpy().astype(np.int64) for c in ("id", "copies"))
            sent = spark.sparkContext.broadcast((ids, mine.column("v").combine_chunks().flatten().to_numpy().reshape(len(ids), dim), copies))

            def run(batches, sent=sent, dim=dim):
                found = Search(*sent.value, k)
                for b in batches:
                    for lo in range(0, b.num_rows, BATCH):
                        part = b.slice(lo, BATCH)
                        found.add(part.column(0).to_numpy(zero_copy_only=False).astype(np.int64), part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, dim))
                a, b, s, c = found.rows()
                for lo in range(0, len(a), 1 << 16):
                    yield pa.RecordBatch.from_arrays([pa.array(x[lo : lo + (1 << 16)]) for x in (a, b, s, np.minimum(c, k))], ["query_id", "vec_id", "score", "copies"])

            got = usable.where(F.size("v") == dim).mapInArrow(run, out)
            each = got.select("query_id", "vec_id", "score", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))  # k times at most
            w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")  # at most k rows per task and row of the query
            top = each.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
            top.write.parquet(scratch.path(f"top/part={made}"))
            sent.unpersist()
            made += 1
    if not made:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = spark.read.schema("query_id long, rank int, vec_id long, score long").parquet(*(scratch.path(f"top/part={i}") for i in range(made)))
    if made == 1:
        return found
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id", "rank")  # an id with several vectors may be in several blocks
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
