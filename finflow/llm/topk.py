"""Exact top-k search by inner product, pruned with segment statistics at several resolutions.

A vector is cut into 1, 2, 4 ... segments. With a segment's mean m and deviation s over n
components, the inner product of two segments is at most n * (m m' + s s') (Cauchy-Schwarz on what
is left when the means are taken away); with the lengths, which are known, this is the lower bound
of the distance. The bounds of one segment rule out candidates below the k-th best score known so
far; bounds of more segments are computed for what is left, step by step, and exact scores for the
last survivors alone.

Queries and candidates are dealt out in blocks of bounded size; each pair of blocks is one task's
work and keeps k rows a query, and the last step ranks those. A first round, each query against one
block, gives every query a floor (its k-th best score there) that all blocks then start from.

Defined cases: rows without id or vector, or with null or non-finite components, take no part; every
other row is a candidate of all rows but itself, and a query if its id says so, also where ids
repeat; vectors of another length are no candidates of a query; ties go to the smaller id; fewer than
k candidates are all returned; empty tables work. A score is a long: a sum beyond 64 bits counts as
the largest (or smallest) long, and a component times the scale likewise.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finflow.llm.common import written

K = 5
QUERY_BLOCK, CANDIDATE_BLOCK = 2048, 4096
RESOLUTIONS = (1, 4, 16)


def integers(vectors: DataFrame, vec: str = "embedding", scale: int = 256) -> DataFrame:
    """vec_id, v: floor(scale * component) of every valid row."""
    double = F.transform(vec, lambda x: x.cast("double"))
    valid = F.forall(double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col(vec).isNotNull()).where(valid)
    return rows.select("vec_id", F.transform(double, lambda x: F.floor(x * scale).cast("double")).alias("v"))


def _stats(x: np.ndarray, parts: int) -> np.ndarray:
    """Columns whose inner product bounds that of the vectors, from ``parts`` segments."""
    pieces = np.array_split(np.arange(x.shape[1]), min(parts, x.shape[1]))
    means = np.stack([x[:, p].mean(axis=1) * len(p) ** 0.5 for p in pieces], axis=1)
    devs = np.stack([x[:, p].std(axis=1) * len(p) ** 0.5 for p in pieces], axis=1)
    return np.concatenate([means, devs], axis=1)


def _exact(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Integer inner products; beyond what a double holds exactly, in Python's integers."""
    if np.abs(x).max(initial=0) * np.abs(q).max(initial=0) * max(1, x.shape[1]) < 2 ** 53:
        return (x @ q).astype(np.int64)
    whole = [sum(int(a) * int(b) for a, b in zip(row, q)) for row in x.tolist()]
    return np.array([min(max(s, -(1 << 63)), (1 << 63) - 1) for s in whole], np.int64)


def _best(q, own: int, floor: int | None, c_rows, c_ids, c, fine, mine, slack: float, k: int):
    """Places and scores of the k best candidates of one query, without those surely below the floor."""
    alive = np.flatnonzero(c_rows != own)
    for (theirs, _), stats in zip(fine, mine):
        bounds = theirs[alive] @ stats + slack
        if len(alive) > 4 * k:  # the k-th best exact score among the most promising is a floor as well
            seed = alive[np.argpartition(-bounds, 4 * k)[:4 * k]]
            here = int(np.sort(_exact(c[seed], q))[-k])
            floor = here if floor is None else max(floor, here)
        if floor is not None:
            alive = alive[bounds >= floor]
    scores = _exact(c[alive], q)
    top = np.lexsort((c_ids[alive], ~scores))[:k]  # ~s falls as s rises and, unlike -s, has no overflow
    return alive[top], scores[top]


def best_of(q_rows, floors, q, c_rows, c_ids, c, k: int):
    """(query row, candidate id, score) of the k best candidates of every query, its own row left out."""
    if not len(c_rows) or not len(q_rows):
        return []
    if not q.shape[1]:
        q, c = np.zeros((len(q_rows), 1)), np.zeros((len(c_rows), 1))
    # Candidates' statistics serve all queries; a query's own are computed once for each resolution.
    fine = [(_stats(c, r), _stats(q, r)) for r in RESOLUTIONS]
    slack = 1e-6 * (1 + np.abs(q).max() * np.abs(c).max() * q.shape[1])
    out = []
    for i, row in enumerate(q_rows):
        at, scores = _best(q[i], row, floors[i], c_rows, c_ids, c, fine, [own[i] for _, own in fine], slack, k)
        out += [(row, c_ids[a], s) for a, s in zip(at, scores)]
    return out


def search(queries: DataFrame, candidates: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score; both tables hold (row, vec_id, v), ``row`` telling all rows of both apart."""
    n_q = -(-queries.count() // QUERY_BLOCK) or 1
    n_c = -(-candidates.count() // CANDIDATE_BLOCK) or 1
    block = lambda n, salt: F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.select("row", "v", block(n_q, 1).alias("qb"))
    right = candidates.select(F.col("row").alias("c_row"), "vec_id", F.col("v").alias("w"), block(n_c, 2).alias("cb"))

    def load(t: pa.Table, vec: str, *names):
        lists = t.column(vec).combine_chunks()
        sizes, ends = lists.value_lengths().to_numpy(), lists.offsets.to_numpy()[1:]
        flat = lists.values.to_numpy()
        for n in np.unique(sizes):
            at = np.flatnonzero(sizes == n)
            x = flat[(ends[at] - n)[:, None] + np.arange(n)[None, :]].reshape(len(at), n)
            yield int(n), [t.column(c).take(pa.array(at)) for c in names], x

    def run(q: pa.Table, c: pa.Table) -> pa.Table:
        found, theirs = [], {n: (cols, x) for n, cols, x in load(c, "w", "c_row", "vec_id")} if c.num_rows else {}
        for n, (rows, floors), x in load(q, "v", "row", "floor") if q.num_rows else ():
            if n in theirs:
                (c_rows, c_ids), y = theirs[n]
                found += best_of(rows.to_numpy(), floors.to_pylist(), x, c_rows.to_numpy(), c_ids.to_numpy().astype(np.int64), y, k)
        cols = list(zip(*found)) or [(), (), ()]
        return pa.table({n: pa.array([int(v) for v in col], pa.int64()) for n, col in zip(("row", "vec_id", "score"), cols)})

    def met(queries: DataFrame, candidates: DataFrame) -> DataFrame:
        return queries.groupBy("qb", "cb").cogroup(candidates.groupBy("qb", "cb")).applyInArrow(run, "row long, vec_id long, score long")

    # The first round: the queries of a block meet one block of candidates; a query with k of them there has a floor.
    blocks = F.when(F.col("cb") < n_q, F.sequence("cb", F.lit(n_q - 1), F.lit(n_c)))
    once = met(left.withColumn("cb", F.col("qb") % n_c).withColumn("floor", F.lit(None).cast("long")), right.withColumn("qb", F.explode(blocks)))
    floors = once.groupBy("row").agg(F.count("*").alias("n"), F.min("score").alias("floor")).where(F.col("n") >= k).drop("n")
    pairs = met(left.join(floors, "row", "left").withColumn("cb", every(n_c)), right.withColumn("qb", every(n_q)))
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    best = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(queries.select("row", F.col("vec_id").alias("query_id")), "row").select("query_id", "rank", "vec_id", "score")


def neighbours(vectors: DataFrame, every: int = 50, k: int = K) -> DataFrame:
    """The k best of all other rows for every row whose id is divisible by ``every``."""
    # Written with a number for each row, so that it is the same wherever the row is read again.
    rows = written(integers(vectors).withColumn("row", F.monotonically_increasing_id()), "vectors")
    return search(rows.where(F.col("vec_id") % every == 0), rows, k)
