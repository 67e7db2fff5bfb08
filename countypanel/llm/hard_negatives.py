"""Hard-negative mining (operator 12): angular triangle filtering before integer scoring.

Components become integers, floor(scale * x), and a score is an integer inner product. Every vector stores its angles to a few
reference directions. For an anchor a, a candidate c and a direction r, the angle between a and c lies between |ar - cr| and
min(ar + cr, 2 pi - ar - cr), so the directions together give an interval of its cosine, and the norms one of the score, widened by
more than all rounding errors. Only pairs whose interval meets a window that is asked for are scored.

1. Positives: in every block the window is all that may still be among an anchor's best: up from the k-th best lower end.
2. Negatives: the windows are the shares of the positive scores in which a negative counts as hard.

Vectors are dealt into chunks and anchors into groups of bounded size; a task sees one of each, and only the best of each window leave it.
Rows of one label with equal vectors are one class, of which only the smallest ids can be among the best, so copies cost nothing.

The directions are centres of a sample of at most SAMPLE vectors; they decide how much is scored, never what is found.

Defined results: rows with a null id or label, a null vector, or any component that is null or not finite (also once scaled) take no part.
Shorter vectors count as padded with zeros. Repeated rows count once; rows with the anchor's id are not its positives. A score beyond the range of a long
counts as the end of that range. Ties go to the smaller id. A negative positive score has an empty window. Other columns are ignored.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from countypanel.llm.common import stored, table

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: A negative's score in per cent of the positive's.
LOW, HIGH = 30, 90

DIRECTIONS, SAMPLE = 16, 1024
CHUNK_ROWS, GROUP_ROWS = 8192, 512
#: More than an angle can be off: the cosine of two vectors is right to some 1e-13, and its angle to the root of twice that.
_SLACK = 1e-6
_LONG = 2**63


def _valid(rows: DataFrame, scale: int) -> DataFrame:
    scaled = F.transform("embedding", lambda x: x.cast("double") * scale)
    whole = F.forall(scaled, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(whole)
    # Doubles from 2 ** 52 up are whole numbers; floor() would cut the large ones to a long.
    v = F.transform(scaled, lambda x: F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x))
    return kept.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), v.alias("v")).distinct()


def _best(rows: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= n)


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width))
    for i, v in enumerate(rows):
        out[i, : len(v)] = v
    return out


def directions(sample: np.ndarray, n: int, rounds: int = 10) -> np.ndarray:
    """At most n unit vectors: centres of the directions of a sample, the first ones as far apart as can be."""
    norm = np.abs(sample).max(1, initial=0)
    unit = sample[norm > 0] / norm[norm > 0][:, None]
    unit /= np.sqrt((unit**2).sum(1))[:, None]
    if not len(unit):
        return np.eye(1, max(1, sample.shape[1]))
    centres, near = unit[:1], unit @ unit[0]
    while len(centres) < n and near.min() < 1 - 1e-9:
        centres = np.vstack([centres, unit[near.argmin()]])
        near = np.maximum(near, unit @ centres[-1])
    for _ in range(rounds):
        own = (unit @ centres.T).argmax(1)
        sums = np.stack([unit[own == k].sum(0) for k in range(len(centres))])
        length = np.sqrt((sums**2).sum(1))
        centres = np.where(length[:, None] > 1e-9, sums / np.maximum(length, 1e-9)[:, None], centres)
    return centres / np.sqrt((centres**2).sum(1))[:, None]


def exact_limit(width: int) -> float:
    """Integers below this have inner products that doubles hold exactly."""
    return 2.0 ** ((53 - max(0, width - 1).bit_length()) // 2)


def angles(v: np.ndarray, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norm of every vector, infinite where it is too large for doubles, and its angles to the directions."""
    narrow = np.abs(v).max(1, initial=0) < exact_limit(v.shape[1])
    v = np.where(narrow[:, None], v, 0)
    norm = np.sqrt((v**2).sum(1))
    cosine = (v @ refs.T) / np.maximum(norm, 1)[:, None]
    return np.where(narrow, norm, np.inf), np.arccos(np.clip(cosine, -1, 1))


class Side:
    """Vectors of one side of a block."""

    def __init__(self, rows: pd.DataFrame, width: int) -> None:
        self.cid, self.label = rows["cid"].to_numpy(), rows["label"].to_numpy()
        self.v, self.norm = _matrix(rows["v"], width), rows["norm"].to_numpy()
        self.angles = np.array(rows["angles"].tolist()).reshape(len(rows), -1)

    def bounds(self, other: Side, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible score of these vectors i with the other's vectors j."""
        least, most = np.zeros((len(i), len(j))), np.full((len(i), len(j)), np.pi)
        for k in range(self.angles.shape[1]):
            a, b = self.angles[i, k][:, None], other.angles[j, k][None, :]
            np.maximum(least, np.abs(a - b), out=least)
            both = a + b
            np.minimum(most, np.minimum(both, 2 * np.pi - both), out=most)
        size = self.norm[i][:, None] * other.norm[j][None, :]
        with np.errstate(invalid="ignore"):
            low = np.floor(size * np.cos(np.minimum(most + _SLACK, np.pi))) - 1
            high = np.ceil(size * np.cos(np.maximum(least - _SLACK, 0))) + 1
        wide = ~np.isfinite(size)
        return np.where(wide, -np.inf, low), np.where(wide, np.inf, high)

    def scores(self, other: Side, i: np.ndarray, j: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Scores of the wanted pairs of vectors i and j, all as long; rows and columns without any are left out."""
        out = np.zeros(wanted.shape, np.int64)
        r, c = np.nonzero(wanted.any(1))[0], np.nonzero(wanted.any(0))[0]
        narrow, narrow_c = np.isfinite(self.norm[i[r]]), np.isfinite(other.norm[j[c]])
        if len(r) and len(c):
            out[np.ix_(r[narrow], c[narrow_c])] = (self.v[i[r[narrow]]] @ other.v[j[c[narrow_c]]].T).astype(np.int64)
            for a, b in np.argwhere(wanted[np.ix_(r, c)] & ~(narrow[:, None] & narrow_c[None, :])):
                pair = zip(self.v[i[r[a]]], other.v[j[c[b]]], strict=True)
                out[r[a], c[b]] = min(max(sum(int(x) * int(y) for x, y in pair), -_LONG), _LONG - 1)
        return out


def top(scores: np.ndarray, among: np.ndarray, n: int) -> np.ndarray:
    """Which of the marked scores are the n best of their row; of equal ones, the first."""
    lowest = np.iinfo(np.int64).min
    if scores.shape[1] <= n:
        return among
    held = np.where(among, scores, lowest)
    nth = np.partition(held, -n, axis=1)[:, -n][:, None]
    above = among & (held > nth)
    ties = among & (held == nth)
    return above | (ties & (ties.cumsum(1) <= n - above.sum(1)[:, None]))


def _found(query: np.ndarray, vector: np.ndarray, score: np.ndarray, positive: np.ndarray | None = None) -> pd.DataFrame:
    out = {"query": query, "vector": vector, "score": score}
    return pd.DataFrame(out if positive is None else {**out, "positive": positive}, dtype="int64")


def best_positives(a: Side, c: Side, keep: int) -> pd.DataFrame:
    """For every anchor, the keep best vectors of its label."""
    parts = []
    for label in np.unique(a.label):
        i, j = np.nonzero(a.label == label)[0], np.nonzero(c.label == label)[0]
        if not len(j):
            continue
        low, high = a.bounds(c, i, j)
        cutoff = np.partition(low, -keep, axis=1)[:, -keep] if len(j) > keep else np.full(len(i), -np.inf)
        wanted = high >= cutoff[:, None]
        scores = a.scores(c, i, j, wanted)
        x, y = np.nonzero(top(scores, wanted, keep))
        parts.append(_found(a.cid[i[x]], c.cid[j[y]], scores[x, y]))
    return pd.concat(parts) if parts else _found(*[np.empty(0)] * 3)


def windows(positive: int, low: int, high: int) -> tuple[int, int]:
    """The scores that are between low and high per cent of a positive's."""
    return -(-low * positive // 100), high * positive // 100


def best_negatives(a: Side, c: Side, asked: list[list[int]], keep: int, low: int, high: int) -> pd.DataFrame:
    """For every anchor and positive score asked for, the keep best vectors of other labels in the window."""
    width = max(map(len, asked))
    spans = [[windows(int(p), low, high) for p in row] + [(1, 0)] * (width - len(row)) for row in asked]
    span = np.array(spans, np.int64).reshape(len(asked), width, 2)
    j = np.arange(len(c.cid))
    parts = []
    for start in range(0, len(asked), 128):
        i = np.arange(start, min(start + 128, len(asked)))
        least, most = a.bounds(c, i, j)
        wanted = np.zeros(least.shape, bool)
        for k in range(width):
            lo, hi = span[i, k, 0][:, None], span[i, k, 1][:, None]
            wanted |= (lo <= hi) & (most >= lo) & (least <= hi)
        wanted &= a.label[i][:, None] != c.label[None, :]
        scores = a.scores(c, i, j, wanted)
        for k in range(width):
            lo, hi = span[i, k, 0][:, None], span[i, k, 1][:, None]
            x, y = np.nonzero(top(scores, wanted & (scores >= lo) & (scores <= hi), keep))
            parts.append(_found(a.cid[i[x]], c.cid[y], scores[x, y], np.array([asked[n][k] for n in i[x]])))
    return pd.concat(parts)


class Blocks:
    """Anchors and vectors dealt into blocks: one for each group of anchors and chunk of vectors."""

    def __init__(self, anchors: DataFrame, vectors: DataFrame, width: int) -> None:
        self.groups = ceil(max(1, anchors.count()) / GROUP_ROWS)
        self.chunks = ceil(max(1, vectors.count()) / CHUNK_ROWS)
        self.vectors, self.width = vectors, width

    def run(self, anchors: DataFrame, find, fields: str) -> DataFrame:
        """find(anchors, their rows, vectors), vectors by ascending first id, in every block."""
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        dealt = lambda n: F.pmod(F.xxhash64("cid"), F.lit(n)).cast("int")
        a = anchors.withColumn("group", dealt(self.groups)).withColumn("chunk", every(self.chunks))
        c = self.vectors.withColumn("chunk", dealt(self.chunks)).withColumn("group", every(self.groups))
        width, names = self.width, [f.split()[0] for f in fields.split(", ")]

        def block(anchors: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
            if anchors.empty or vectors.empty:
                return pd.DataFrame({n: [] for n in names}, dtype="int64")
            return find(Side(anchors, width), anchors, Side(vectors.sort_values(["first", "cid"]), width))[names]

        return a.groupBy("group", "chunk").cogroup(c.groupBy("group", "chunk")).applyInPandas(block, fields)


def mine(
    rows: DataFrame, is_anchor: Column, *, scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES,
    low: int = LOW, high: int = HIGH, n_directions: int = DIRECTIONS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    rows: vec_id, embedding, label. low, high: the window of a negative's score, in per cent of the positive's.
    """
    valid = stored(_valid(rows, scale), "rows")
    width = valid.agg(F.max(F.size("v"))).first()[0] or 1
    same_id = valid.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    keep = positives + same_id
    classes = stored(_best(valid, ["v", "label"], [F.asc("vec_id")], max(keep, negatives)), "classes")
    named = classes.where("rank = 1").select(F.monotonically_increasing_id().alias("cid"), F.col("vec_id").alias("first"), "v", "label")
    named = stored(named, "named")

    sample = named.orderBy(F.xxhash64("first", "v"), "cid").select("v").limit(SAMPLE).toPandas()["v"]
    refs = directions(_matrix(sample, width), n_directions)

    def angled(batches):
        for batch in batches:
            norm, found = angles(_matrix(batch["v"], width), refs)
            yield batch.assign(norm=norm, angles=list(found))

    fields = "cid bigint, first bigint, v array<double>, label bigint, norm double, angles array<double>"
    vectors = stored(named.mapInPandas(angled, fields), "vectors")
    members = stored(classes.join(named.select("cid", "v", "label"), ["v", "label"]).select(F.col("cid").alias("vector"), "vec_id"), "members")
    asked = valid.where(is_anchor).join(named.select("cid", "v", "label"), ["v", "label"])
    asked = stored(asked.select(F.col("vec_id").alias("anchor_id"), F.col("cid").alias("query")), "asked")
    anchors = stored(vectors.join(asked.select(F.col("query").alias("cid")).distinct(), "cid", "left_semi"), "anchors")
    blocks = Blocks(anchors, vectors, width)
    firsts = vectors.select(F.col("cid").alias("vector"), "first")

    def of_rows(found: DataFrame, by: list[str], n: int) -> DataFrame:
        """The n best rows of what was found by class."""
        ranked = _best(found.join(firsts, "vector"), by, [F.desc("score"), F.asc("first"), F.asc("vector")], n)
        return _best(ranked.drop("rank", "first").join(members, "vector"), by, [F.desc("score"), F.asc("vec_id"), F.asc("vector")], n)

    near = blocks.run(anchors, lambda a, _, c: best_positives(a, c, keep), "query bigint, vector bigint, score bigint")
    near = of_rows(near, ["query"], keep).drop("rank").join(asked, "query").where("vec_id <> anchor_id")
    near = _best(near, ["anchor_id", "query"], [F.desc("score"), F.asc("vec_id")], positives)
    near = stored(near.select("anchor_id", "query", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive")), "positives")

    spans = near.where("positive >= 0").groupBy(F.col("query").alias("cid")).agg(F.sort_array(F.collect_set("positive")).alias("asked"))
    found = blocks.run(
        anchors.join(spans, "cid"),
        lambda a, rows, c: best_negatives(a, c, [list(x) for x in rows["asked"]], negatives, low, high),
        "query bigint, vector bigint, score bigint, positive bigint",
    )
    hard = of_rows(found, ["query", "positive"], negatives)
    return near.join(hard, ["query", "positive"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        F.col("positive").alias("positive_score"), F.col("score").alias("negative_score"),
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    wrong = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.select("vec_id", "embedding", wrong.alias("label")), F.col("vec_id") % 100 == 0)


OP12_SQL = """
WITH v AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
           list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
), p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, (row_number() OVER w)::INT AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10
"""
