"""Exact top-k search (9): distributed histogram selection.

Candidates are scored in blocks against blocks of queries. Every round adds up
one global histogram of scores per query and narrows the interval that holds
the k-th highest score, until it is a single value. A last pass keeps the
scores above it, and of those equal to it the smallest ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smogline.llm.common import reachable
from smogline.session import stage

#: Queries in a block, candidates in a run, queries scored at once, bins of a histogram.
QUERY_BLOCK = 2048
CANDIDATES = 8192
AT_ONCE = 256
BINS = 64
#: Largest sum of products that a double holds exactly.
EXACT = 2.0**53


def quantised(vectors: DataFrame, scale: float = 1024.0, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id`` and ``v``: floor(scale * x) of every component.

    Vectors that are missing, empty, or hold a missing or non-finite component,
    and rows without id, take no part.
    """
    reachable(vectors.sparkSession)
    x = F.transform(vectors[vec_col], lambda e: e.cast("double"))
    finite = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), x.alias("x")).where("vec_id is not null and x is not null and size(x) > 0")
    return rows.where(finite).select("vec_id", F.transform("x", lambda e: F.floor(e * F.lit(scale)).cast("double")).alias("v"))


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products; in whole numbers where a double might round."""
    bound = np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * max(q.shape[1], 1)
    if bound < EXACT:
        return (q @ c.T).astype(np.int64)
    return q.astype(np.int64) @ c.astype(np.int64).T


def numbered(vectors: DataFrame) -> DataFrame:
    """The vectors with a number of their own per row, staged so that it stays the same."""
    return stage(vectors.withColumn("row", F.monotonically_increasing_id()), "vectors")


def dealt(vectors: DataFrame, n_runs: int) -> DataFrame:
    """Numbered vectors with their ``run``; rows of one id, or copies, spread over all runs."""
    return vectors.withColumn("run", F.pmod(F.xxhash64("row"), F.lit(n_runs)))


def asked_of(vectors: DataFrame, every: int) -> DataFrame:
    """The queries: of every id divisible by ``every`` the row with the smallest vector, of equal ones the first."""
    own = F.min(F.struct("v", "row")).alias("own")
    return vectors.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(own).select("vec_id", "own.v", "own.row")


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, block: int = QUERY_BLOCK, bins: int = BINS) -> DataFrame:
    """The ``k`` highest integer inner products per query, ties to the smaller id.

    vectors: ``vec_id``, ``v`` (whole numbers as doubles). Queries are the rows
    whose id is divisible by ``every``, candidates all rows of the same length
    but the query's own; with fewer than ``k`` all are returned. A repeated
    query id is one query, with the smallest of its vectors in the order of
    arrays; its other rows are candidates like all. An empty table, or one
    without queries, gives an empty table.
    """
    vectors = numbered(vectors)
    asked = asked_of(vectors, every)
    n_blocks = (asked.count() - 1) // block + 1
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(max(n_blocks, 1))).cast("int"))
    peak = F.aggregate("v", F.lit(0.0), lambda a, x: a + F.abs(x))
    most = vectors.agg(F.max(F.array_max(F.transform("v", F.abs))).alias("m")).first()["m"] or 0.0
    # |score| is at most the sum of the query's components times the largest component
    reach = F.ceil(peak * F.lit(float(most))).cast("long") + 1
    state = asked.select("block", "vec_id", "v", "row", (-reach).alias("lo"), (reach * 2 + 1).alias("width"), F.lit(k).cast("long").alias("need"))
    state = stage(state, "state")

    def paired(state: DataFrame) -> DataFrame:
        """Blocks of queries with their state, dealt to every run of candidates."""
        blocks = state.groupBy("block").agg(F.collect_list(F.struct("vec_id", "v", "row", "lo", "width")).alias("queries"))
        each = dealt(vectors, n_runs).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(max(n_blocks, 1) - 1))))
        runs = each.groupBy("block", "run").agg(F.collect_list(F.struct("vec_id", "v", "row")).alias("candidates"))
        return runs.join(blocks, "block").select("queries", "candidates")

    n_runs = vectors.count() // CANDIDATES + 1

    def unpack(row_queries, row_candidates):
        ids, own = (np.array([c[name] for c in row_candidates], dtype=np.int64) for name in ("vec_id", "row"))
        lengths = np.array([len(c["v"]) for c in row_candidates])
        for size in {len(q["v"]) for q in row_queries}:
            queries = [q for q in row_queries if len(q["v"]) == size]
            here = lengths == size
            if here.any():
                c = np.array([x["v"] for x, ok in zip(row_candidates, here) if ok])
                for at in range(0, len(queries), AT_ONCE):
                    some = queries[at : at + AT_ONCE]
                    yield some, ids[here], own[here], _scores(np.array([q["v"] for q in some]), c)

    def histograms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for qs, cs in zip(batch["queries"], batch["candidates"]):
                for queries, ids, own, scores in unpack(qs, cs):
                    out = []
                    for q, s in zip(queries, scores):
                        s = s[own != q["row"]] - q["lo"]
                        s = s[(s >= 0) & (s < q["width"])]
                        step = -(-q["width"] // bins)
                        bin_, n = np.unique(s // step, return_counts=True)
                        out.append(pd.DataFrame({"query_id": q["vec_id"], "bin": bin_, "n": n}))
                    yield pd.concat(out)

    while True:
        step = F.expr(f"cast(ceil(width / {bins}) as long)")
        open_ = state.where("width > 1")
        if open_.isEmpty():
            break
        counted = paired(open_).mapInPandas(histograms, "query_id long, bin long, n long").groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("query_id").orderBy(F.desc("bin"))
        counted = counted.withColumn("upto", F.sum("n").over(down)).join(state.select(F.col("vec_id").alias("query_id"), "need"), "query_id")
        # the bin in which the k-th value lies; a query with fewer scores keeps none
        hit = counted.where("upto >= need").groupBy("query_id").agg(F.max(F.struct("bin", "n", "upto")).alias("h")).select(
            F.col("query_id").alias("vec_id"), F.col("h.bin").alias("bin"), (F.col("h.upto") - F.col("h.n")).alias("above")
        )
        joined = state.join(hit, "vec_id", "left")
        narrowed = joined.select(
            "block", "vec_id", "v", "row",
            F.when(F.col("width") <= 1, F.col("lo")).when(F.col("bin").isNull(), F.col("lo")).otherwise(F.col("lo") + F.col("bin") * step).alias("lo"),
            F.when(F.col("bin").isNull() | (F.col("width") <= 1), F.lit(1)).otherwise(F.least(step, F.col("width") - F.col("bin") * step)).cast("long").alias("width"),
            (F.col("need") - F.when(F.col("width") <= 1, 0).otherwise(F.coalesce("above", F.lit(0)))).alias("need"),
        )
        state = stage(narrowed, "state")

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for qs, cs in zip(batch["queries"], batch["candidates"]):
                for queries, ids, own, scores in unpack(qs, cs):
                    out = []
                    for q, s in zip(queries, scores):
                        other = own != q["row"]
                        above = np.flatnonzero(other & (s > q["lo"]))
                        tied = np.flatnonzero(other & (s == q["lo"]))
                        if len(tied) > k:  # of equal scores only the smallest ids can count
                            tied = tied[np.argsort(ids[tied], kind="stable")[:k]]
                        at = np.concatenate([above, tied])
                        out.append(pd.DataFrame({"query_id": q["vec_id"], "vec_id": ids[at], "score": s[at]}))
                    yield pd.concat(out)

    kept = paired(state).mapInPandas(keep, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return kept.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
