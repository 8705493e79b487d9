"""Exact top-k search by multi-resolution segment statistics.

A vector is cut into segments at several resolutions. Means and deviations of the segments bound the distance of two
vectors from below: d(q, c)^2 >= sum of length * ((mean_q - mean_c)^2 + (dev_q - dev_c)^2) over the segments, and
finer segments bound it more tightly. With the lengths of both vectors known, a lower bound of the distance is an upper
bound of the inner product, length * (mean_q * mean_c + dev_q * dev_c). Candidates whose bound falls below a query's k-th score
so far are left out, coarse to fine; scores of the survivors are computed exactly, in 64-bit integers.

The stated queries meet all rows in blocks: queries and candidates are dealt into blocks of bounded size, every pair
of blocks is one group, and each group returns at most k rows a query.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

#: Rows of a block of queries and of candidates.
QUERY_BLOCK, CANDIDATE_BLOCK = 2_048, 16_384
#: Number of segments, coarse to fine.
RESOLUTIONS = (1, 4, 16)
#: Candidates that are looked at together.
CHUNK = 2_048


def quantised(vector: Column) -> Column:
    """floor(256 * x) of every component as long; null where the vector is null or has a component that is null or not
    finite."""
    doubles = vector.cast("array<double>")
    usable = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(usable, F.transform(doubles, lambda x: F.floor(x * 256)))


def statistics(rows: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of the segments of each row, scaled so that their inner product bounds that of the rows."""
    edges = np.linspace(0, rows.shape[1], min(segments, rows.shape[1]) + 1).astype(int)
    size = np.diff(edges)
    sums = np.add.reduceat(rows, edges[:-1], axis=1)
    squares = np.add.reduceat(rows * rows, edges[:-1], axis=1)
    means = sums / size
    deviations = np.sqrt(np.maximum(squares / size - means * means, 0))
    return np.concatenate([means * np.sqrt(size), deviations * np.sqrt(size)], axis=1)


def matrix(vectors, width: int) -> np.ndarray:
    """Rows of equal width; shorter vectors end in zeros, which add nothing to an inner product."""
    lengths = np.fromiter(map(len, vectors), int, len(vectors))
    out = np.zeros((len(vectors), width), "i8")
    out[np.arange(width) < lengths[:, None]] = np.concatenate([*vectors, np.empty(0, "i8")])
    return out


def best_of(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best candidates of each query: higher score first, then smaller id."""
    candidates = candidates.sort_values("id", kind="stable")
    width = max(map(len, [*queries["v"], *candidates["v"]]), default=0)
    if not width:
        width = 1
    q, c = matrix(queries["v"], width), matrix(candidates["v"], width)
    q_ids, c_ids = queries["id"].to_numpy(), candidates["id"].to_numpy()
    largest = [max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) for x in (q, c)]
    if largest[0] * largest[1] * width >= 2**63:
        raise OverflowError("scores from 2^63 on do not fit a long")
    top_scores, top_rows = np.full((len(q), k), 1 - 2**63), np.full((len(q), k), -1)
    wide = [x.astype("f8") for x in (q, c)]
    levels = [tuple(statistics(x, s) for x in wide) for s in RESOLUTIONS if s == 1 or s < width]
    # Bounds are rounded; this much keeps a candidate that ties.
    slack = 1e-9 * (1 + float(largest[0]) * largest[1] * width)
    # Long vectors first, so that thresholds rise early.
    for chunk in np.array_split(np.argsort(-np.linalg.norm(wide[1], axis=1), kind="stable"), -(-len(c) // CHUNK)):
        coarse_q, coarse_c = levels[0]
        alive = coarse_q @ coarse_c[chunk].T >= top_scores[:, -1:].astype("f8") - slack
        for i in np.flatnonzero(alive.any(axis=1)):
            rows = chunk[alive[i]]
            for fine_q, fine_c in levels[1:]:
                if len(rows) > k:
                    rows = rows[fine_c[rows] @ fine_q[i] >= float(top_scores[i, -1]) - slack]
            rows = rows[c_ids[rows] != q_ids[i]]
            scores = np.concatenate([top_scores[i], c[rows] @ q[i]])
            rows = np.concatenate([top_rows[i], rows])
            if len(scores) > 4 * k:
                near = scores >= np.partition(scores, -k)[-k]
                scores, rows = scores[near], rows[near]
            order = np.lexsort((rows, -scores))[:k]
            top_scores[i], top_rows[i] = scores[order], rows[order]
    at, place = np.nonzero(top_rows >= 0)
    return pd.DataFrame({
        "query_id": q_ids[at], "vec_id": c_ids[top_rows[at, place]], "score": top_scores[at, place],
    })


def top_k(df: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k best other rows by inner product of quantised vectors.

    Ties go to the smaller id. Fewer rows than k give fewer results. Rows with a null id and vectors that are null or
    hold a null or non-finite component take no part. The id is a key: of rows that repeat one, the smallest vector
    counts. Vectors of unlike length are compared over their common components; an empty one scores 0. Other columns
    are not read; an empty table gives no rows. Scores that do not fit a long raise an error.
    """
    rows = (df.select(F.col(key).cast("long").alias("id"), quantised(F.col(vector)).alias("v"), is_query.alias("q"))
            .filter("id is not null and v is not null"))
    rows = rows.groupBy("id").agg(F.min("v").alias("v"), F.max("q").alias("q"))
    numbers = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("q"), 1)).alias("m")).first()
    across, down = -(-numbers["n"] // CANDIDATE_BLOCK) or 1, -(-numbers["m"] // QUERY_BLOCK) or 1
    deal = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    queries = rows.filter("q").select("id", "v", deal(down).alias("down")).select("*", every(across).alias("across"))
    candidates = rows.select("id", "v", deal(across).alias("across")).select("*", every(down).alias("down"))

    def search(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or candidates.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("i8")
        return best_of(queries, candidates, k)

    found = queries.groupBy("across", "down").cogroup(candidates.groupBy("across", "down")).applyInPandas(
        search, "query_id long, vec_id long, score long"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.select("query_id", F.row_number().over(best).alias("rank"), "vec_id", "score")
    return ranked.filter(F.col("rank") <= k)
