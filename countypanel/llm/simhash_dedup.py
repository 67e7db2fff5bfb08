"""SimHash near-duplicates (operator 5): pigeonhole blocks, an equi-join on blocks, a Hamming check, components.

A fingerprint has 64 bits, cut into `blocks` blocks. Fingerprints at distance d or less differ in at most d blocks and
so agree in `blocks - d` whole ones. Every fingerprint is therefore listed once for each choice of `blocks - d`
blocks, keyed by the bits of the choice, and joined on that key; the distance is checked in the join. A pair that
agrees in more blocks meets several times and counts only at its first agreeing choice.

More blocks make keys longer, so that fewer unrelated fingerprints meet, at the price of more rows per
fingerprint: 7 blocks and distance 4 give 35 rows with keys of 27 bits or more, 9 blocks 126 rows of 35 bits.

Equal fingerprints are one class, joined once, so copies cost nothing; a key shared by many different
fingerprints is split by Spark's skew join. Links are those between classes; none is left out.

Defined results: a null text counts as empty, and a text without words has fingerprint zero, linked like any other.
Rows without doc_id get a fingerprint but no component and link nothing. Repeated rows come back as often as they
went in. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countypanel.llm.common import stored, table, text_of, tidy
from countypanel.llm.components import components

SHINGLE = 4
MAX_BITS = 4
BLOCKS = 7

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_PART = 60_000


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The bits set in over half of the XXH64 values (seed 42) of the word shingles, as a signed 64-bit number."""
    from xxhash import xxh64_intdigest

    words = text.encode().translate(_LOWER).split()  # bytes split at exactly \x20 and \x09-\x0D
    if not words:
        return 0
    line = b" ".join(words)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    count = max(1, len(words) - shingle + 1)
    ends = [x - 1 for x in starts[len(starts) - count :]]
    ones = np.zeros(64, np.int64)
    for at in range(0, count, _PART):
        part = [xxh64_intdigest(line[a:b], 42) for a, b in zip(starts[at : min(count, at + _PART)], ends[at : at + _PART], strict=True)]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for k in range(0, len(part), 255):  # sums of at most 255 ones fit a byte
            ones += bits[k : k + 255].sum(0, dtype=np.uint8)
    return int(np.packbits(ones * 2 > count, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp (bigint) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = pa.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), fps], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("bigint"), text_of()).mapInArrow(tidy(run), "doc_id bigint, fp bigint")


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def links(classes: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """a, b (ids, a < b) and bits of every two rows of classes (fp, id; fp distinct) at most max_bits apart."""
    if blocks <= max_bits:
        raise ValueError("there must be more blocks than bits may differ")
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [_signed((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:], strict=False)]
    agree = blocks - max_bits
    keys = [reduce(int.__or__, choice) for choice in combinations(masks, agree)]
    listed = classes.select("fp", "id", F.explode(F.array(*map(F.lit, keys))).alias("mask")).withColumn(
        "key", F.col("fp").bitwiseAND(F.col("mask"))
    )
    x, y = listed.alias("x"), listed.alias("y")
    differ = F.col("x.fp").bitwiseXOR(F.col("y.fp"))
    equal = [F.when(differ.bitwiseAND(F.lit(m)) == 0, 1).otherwise(0) for m in masks]
    first, seen = F.lit(0).cast("bigint"), F.lit(0)
    for m, e in zip(masks, equal, strict=True):
        first = first.bitwiseOR(F.when((e == 1) & (seen < agree), F.lit(m)).otherwise(F.lit(0).cast("bigint")))
        seen = seen + e
    meet = (
        (F.col("x.mask") == F.col("y.mask")) & (F.col("x.key") == F.col("y.key")) & (F.col("x.id") < F.col("y.id"))
        & (F.bit_count(differ) <= max_bits) & (first == F.col("x.mask"))
    )
    return x.join(y, meet).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), F.bit_count(differ).alias("bits"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id reachable over links) of every row."""
    fps = stored(fingerprints(docs, shingle), "fingerprints")
    classes = stored(fps.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("id")), "classes")
    found = components(links(classes, max_bits, blocks))
    # Two classes share an id only where rows of one doc_id have different texts; they are one node then.
    of_class = classes.join(found, classes.id == found.node, "left").select(
        F.col("fp").alias("class"), F.coalesce("component", "id").alias("component_id")
    )
    named = fps.join(of_class, fps.fp == of_class["class"], "left")
    return named.select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of docs for each component: the one with the smallest doc_id. Rows without doc_id stay.

    Of several rows with that id the first one by the hash of its text stays, then by its text and its other columns in order.
    """
    found = near_duplicates(docs)
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias("kept_id")).distinct()
    ids = docs.select("doc_id").groupBy("doc_id").agg(F.count("*").alias("n"))
    repeated = ids.where("n > 1 AND doc_id IS NOT NULL").limit(1).count() > 0
    out = docs.join(kept, docs.doc_id == kept.kept_id, "left_semi")
    if repeated:
        rest = [c for c in docs.columns if c != "doc_id"]
        first = F.min(F.struct(F.xxhash64(text_of()).alias("_hash"), text_of().alias("_text"), *rest))
        out = out.groupBy("doc_id").agg(first.alias("_first")).select(*[F.col(c if c == "doc_id" else f"_first.{c}") for c in docs.columns])
    return out.unionByName(docs.where("doc_id IS NULL"))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
