"""Operator 9, exact top-k search by inner product over an impact-ordered index.

Vectors of integers are dealt into blocks of about ``BLOCK`` vectors. In a block every dimension has
posting segments: the vectors whose value there lies in one of ``LEVELS`` quantised steps. For a query, a segment's impact is the
most that the dimension can add for a vector of that step. Segments are processed in the order
of descending impact, in ``ROUNDS`` rounds for a batch of queries at once: a vector's score is bounded by the
impacts gathered so far plus, for every dimension not yet seen, the largest impact still to come. A query stops
only when that bound proves that all but a few vectors stay below its k-th best exact score so far, or when
nothing is left to process; the possible members are then scored exactly from their values.

Blocks and batches of queries meet by a key made of both, so that a task holds one block and one batch
of at most about ``BATCH`` queries (8 MB of vectors of 64 numbers), whatever the table's size: a vector moves once for each batch. Each pair
returns at most k rows a query, which an aggregate merges.

Defined results: vectors that are null, empty or hold null or non-finite components take no part; of rows with an
equal id each is a candidate of its own, but no candidate of a query with its own id; query rows with an equal id and an equal integer vector
are one query, with another vector each is a query of its own with ranks from 1; ties go to the smaller id;
with fewer candidates than k all are returned; a null id takes no part; vectors of unequal lengths
raise an error.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise

BLOCK, BATCH = 8192, 16384
LEVELS, ROUNDS = 8, 4
FEW = 64


def integer_vectors(rows: DataFrame, vec_id: str, vector: str, scale: int = 256) -> DataFrame:
    """id and v (floor(scale * x) of each component) of the rows that take part."""
    v = F.col(vector)
    fine = ~F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return rows.where(F.col(vec_id).isNotNull() & (F.size(v) > 0) & fine).select(
        F.col(vec_id).cast("long").alias("id"), F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"))


class ImpactIndex:
    """Posting segments of a block: for each dimension and step, which vectors are in it."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors.astype(np.float64)  # exact for integer products below 2**53
        n, d = vectors.shape
        lo, hi = vectors.min(0), vectors.max(0)
        width = np.maximum(1, -(-(hi - lo + 1) // LEVELS))
        step = (vectors - lo) // width
        self.low = lo[:, None] + np.arange(LEVELS) * width[:, None]  # smallest and largest value of a step
        self.high = np.minimum(self.low + width[:, None] - 1, hi[:, None])
        self.postings = np.zeros((d * LEVELS, n), np.float32)
        self.postings[(np.arange(d) * LEVELS + step).ravel(), np.repeat(np.arange(n), d)] = 1
        self.filled = self.postings.any(1)

    def impacts(self, q: np.ndarray) -> np.ndarray:
        """Largest addition of each segment to each query's score; empty segments have none."""
        x = q[:, :, None]
        most = np.maximum(x * self.low, x * self.high).reshape(len(q), -1)
        return np.where(self.filled, most, -np.inf)

    def search(self, ids: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[int, int, int]]:
        """(place of the query, id, score): at least the query's k best of the block by score and smaller id."""
        q = queries.astype(np.float64)
        n, d = self.vectors.shape
        impact = self.impacts(q)
        order = np.sort(impact, axis=1)[:, ::-1]
        filled = int(self.filled.sum())
        theta = np.full(len(q), -np.inf)
        out = []
        open_ = np.arange(len(q))
        for r in range(1, ROUNDS + 1):
            end = filled * r // ROUNDS
            last = r == ROUNDS
            # the largest impact still to come
            to_come = np.full(len(open_), 0.0) if last else order[open_, end]
            seen = (impact[open_] > to_come[:, None]) & self.filled if not last else np.broadcast_to(self.filled, (len(open_), len(self.filled)))
            weight = np.where(seen, impact[open_] - to_come[:, None], 0.0)
            # single precision holds integers to 2**24; the slack covers rounding beyond
            bound = (weight.astype(np.float32) @ self.postings).astype(np.float64) + (d * to_come)[:, None]
            slack = 1e-5 * (np.abs(weight).sum(1) / LEVELS + d * np.abs(to_come)) + 1
            still = []
            for row, (i, b) in enumerate(zip(open_, bound)):
                own = ids == query_ids[i]
                if theta[i] == -np.inf:  # a first threshold from the best bounds so far, scored exactly
                    top = np.argpartition(-b, min(4 * k, n - 1))[: 4 * k + 1] if n > 4 * k + 1 else np.arange(n)
                    top = top[~own[top]]
                    if len(top) >= k:
                        theta[i] = np.sort(self.vectors[top] @ q[i])[-k]
                members = np.flatnonzero((b + slack[row] >= theta[i]) & ~own)
                if len(members) > max(FEW, 8 * k) and not last:
                    still.append(i)
                    continue
                score = self.vectors[members] @ q[i]
                best = np.lexsort((ids[members], -score))[:k]
                out += [(int(i), int(ids[members[x]]), int(score[x])) for x in best]
            open_ = np.array(still, np.int64)
            if not len(open_):
                break
        return out


def top_k(rows: DataFrame, *, is_query: Callable[[Column], Column], vec_id: str = "vec_id", vector: str = "embedding", k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` best candidates of each query; ``is_query`` is a condition on the id."""
    clean = materialise(integer_vectors(rows, vec_id, vector, scale), "topk_vectors")
    # numbered once, as written
    asked = materialise(clean.where(is_query(F.col("id"))).distinct().withColumn("query", F.monotonically_increasing_id()), "topk_queries")
    blocks, batches = -(-max(clean.count(), 1) // BLOCK), -(-max(asked.count(), 1) // BATCH)

    def deal(df: DataFrame, own: str, parts: int, other: str, others: int, kind: int) -> DataFrame:
        return df.select(
            F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other), F.lit(kind).alias("kind"), "query", "id", "v"
        ).select("block", "batch", "kind", "query", "id", "v")

    vectors = clean.withColumn("query", F.lit(-1).cast("long"))
    both = deal(vectors, "block", blocks, "batch", batches, 0).union(deal(asked, "batch", batches, "block", blocks, 1))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        one, two = frame[frame["kind"] == 0], frame[frame["kind"] == 1]
        if not len(one) or not len(two):
            return pd.DataFrame({"query": [], "query_id": [], "vec_id": [], "score": []}, dtype="int64")
        index = ImpactIndex(np.vstack(one["v"].to_numpy()).astype(np.int64))
        ids, query_ids, numbers = one["id"].to_numpy(), two["id"].to_numpy(), two["query"].to_numpy()
        queries = np.vstack(two["v"].to_numpy()).astype(np.int64)
        got = [(numbers[at + i], query_ids[at + i], c, score) for at in range(0, len(queries), 128)
               for i, c, score in index.search(ids, query_ids[at: at + 128], queries[at: at + 128], k)]
        return pd.DataFrame(got, columns=["query", "query_id", "vec_id", "score"], dtype="int64")

    found = both.groupBy("block", "batch").applyInPandas(run, "query bigint, query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
