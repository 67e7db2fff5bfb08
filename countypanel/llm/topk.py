"""Exact top-k search by inner product (operator 4): three phases with a uniform threshold.

Components become integers, floor(scale * x), so scores are exact. The dimensions are cut into `lists` slices; the score of a
vector for a query is the sum of its partial scores in the slices, its lists.

1. Every task gathers the heads of its local score lists: the best partial scores of its vectors for each query and
   list. The k-th best exact score among the vectors of all heads is a safe cutoff t: k vectors reach it.
2. The cutoffs go out with the queries. A vector that reaches t has a partial score of at least t / lists in some
   list, so collecting all entries from t / lists up misses none. Vectors whose best possible sum, with less than
   t / lists in the lists where they have no entry, stays below t are dropped.
3. The remaining scores of what is left are resolved exactly, where the other lists of the vector lie, and only
   vectors that reach t leave the task. They are merged and ranked.

Vectors are dealt into chunks and queries into groups of bounded size; a task sees one chunk and one group, as a block of one
matrix product per list, and no pairs leave it but heads and those that reach the cutoff. Equal vectors are one class
of which the k + 1 smallest ids are kept: no other can be among the k best, since ties go to the smaller id.

Defined results: vectors that are null or hold null or non-finite components, and rows without an id, take no part.
Shorter vectors count as padded with zeros. Repeated rows count once. Rows with the query's id are not its candidates.
Scores must fit 53 bits. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from countypanel.llm.common import stored, table

K = 20
SCALE = 64
QUERY_EVERY = 20

LISTS = 2
CHUNK_ROWS, GROUP_ROWS = 4_096, 1_024

def _integers(vectors: DataFrame, scale: int) -> DataFrame:
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(whole).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("v")
    ).distinct()


def _first(rows: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    return rows.withColumn("n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("n") <= n)


def _partials(queries: pd.Series, vectors: pd.Series, lists: int, width: int) -> np.ndarray:
    """Partial scores: list, query, vector. Whole numbers below 2 ** 53, so doubles are exact."""

    def whole(rows: pd.Series) -> np.ndarray:
        out = np.zeros((len(rows), width))
        for i, v in enumerate(rows):
            out[i, : len(v)] = v
        return out

    q, v = whole(queries), whole(vectors)
    edges = [width * i // lists for i in range(lists + 1)]
    return np.stack([q[:, a:b] @ v[:, a:b].T for a, b in zip(edges, edges[1:], strict=False)])


def heads(partials: np.ndarray, keep: int) -> np.ndarray:
    """Which (query, vector) are among the keep best of some list."""
    found = np.zeros(partials.shape[1:], bool)
    n = min(keep, partials.shape[2])
    for scores in partials:
        np.put_along_axis(found, np.argpartition(-scores, n - 1, axis=1)[:, :n], True, axis=1)
    return found


def reaching(partials: np.ndarray, cutoff: np.ndarray) -> np.ndarray:
    """Which (query, vector) can reach the query's cutoff, by the entries that each list has to tell."""
    lists = len(partials)
    least = np.ceil(cutoff / lists)[:, None]
    told = partials >= least
    found = told.any(0)
    q, v = np.nonzero(found)
    here = told[:, q, v]
    possible = np.where(here, partials[:, q, v], least[q, 0] - 1).sum(0)
    found[q, v] = possible >= cutoff[q]
    return found


class Blocks:
    """Queries and vectors dealt into blocks: one for each group of queries and chunk of vectors."""

    def __init__(self, queries: DataFrame, vectors: DataFrame, lists: int, width: int) -> None:
        self.groups = ceil(max(1, queries.count()) / GROUP_ROWS)
        self.chunks = ceil(max(1, vectors.count()) / CHUNK_ROWS)
        self.queries, self.vectors, self.lists, self.width = queries, vectors, lists, width

    def scores(self, choose: Callable[[np.ndarray, pd.DataFrame], np.ndarray], cutoffs: DataFrame | None = None) -> DataFrame:
        """query, vector and exact score of what choose(partials, queries) picks in every block and, with cutoffs, reaches them."""
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        dealt = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
        queries = self.queries if cutoffs is None else self.queries.join(cutoffs, "id")
        q = queries.withColumn("group", dealt(self.groups)).withColumn("chunk", every(self.chunks))
        v = self.vectors.withColumn("chunk", dealt(self.chunks)).withColumn("group", every(self.groups))
        lists, width, cut = self.lists, self.width, cutoffs is not None

        def run(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
            if queries.empty or vectors.empty:
                return pd.DataFrame({"query": [], "vector": [], "score": []}, dtype="int64")
            partials = _partials(queries["v"], vectors["v"], lists, width)
            i, j = np.nonzero(choose(partials, queries))
            score = partials[:, i, j].sum(0)
            if cut:
                reached = score >= queries["cutoff"].to_numpy()[i]
                i, j, score = i[reached], j[reached], score[reached]
            return pd.DataFrame({"query": queries["id"].to_numpy()[i], "vector": vectors["id"].to_numpy()[j], "score": score.astype(np.int64)})

        keys = ["group", "chunk"]
        return q.groupBy(*keys).cogroup(v.groupBy(*keys)).applyInPandas(run, "query bigint, vector bigint, score bigint")


def top_k(vectors: DataFrame, is_query: Column, *, k: int = K, scale: int = SCALE, lists: int = LISTS) -> DataFrame:
    """query_id, rank, vec_id, score of the k best rows of vectors (vec_id, embedding) for every row where is_query."""
    rows = stored(_integers(vectors, scale), "integers")
    classes = stored(_first(rows, ["v"], [F.col("vec_id").asc()], k + 1), "classes")
    distinct = stored(classes.where("n = 1").select(F.col("vec_id").alias("id"), "v"), "distinct")
    members = stored(classes.join(distinct, "v").select("id", "vec_id"), "members")
    asked = stored(rows.where(is_query).join(distinct, "v").select(F.col("vec_id").alias("query_id"), F.col("id").alias("query")), "asked")
    queries = stored(asked.select(F.col("query").alias("id")).distinct().join(distinct, "id"), "queries")
    width = distinct.agg(F.max(F.size("v"))).first()[0] or 1
    lists = max(1, min(lists, width))
    blocks = Blocks(queries, distinct, lists, width)
    keep = k + 1

    # Phase 1: heads of the lists, and from their exact scores a cutoff for each query.
    known = blocks.scores(lambda partials, _: heads(partials, keep))
    kth = _first(known, ["query"], [F.desc("score")], keep)
    cutoffs = stored(kth.groupBy("query").agg(F.min("score").alias("cutoff")).withColumnRenamed("query", "id"), "cutoffs")

    # Phases 2 and 3: entries that can belong to a vector reaching the cutoff, and the rest of their scores.
    scored = blocks.scores(lambda partials, queries: reaching(partials, queries["cutoff"].to_numpy()), cutoffs)
    best = _first(scored, ["query"], [F.desc("score"), F.asc("vector")], keep).drop("n")
    named = best.join(members.withColumnRenamed("id", "vector"), "vector").select("query", "vec_id", "score")
    named = _first(named, ["query"], [F.desc("score"), F.asc("vec_id")], keep).drop("n")
    own = named.join(asked, "query").where("vec_id <> query_id")
    return _first(own, ["query_id"], [F.desc("score"), F.asc("vec_id")], k).select(
        "query_id", F.col("n").cast("int").alias("rank"), "vec_id", "score"
    )


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_EVERY == 0)


OP4_SQL = """
WITH v AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
"""
