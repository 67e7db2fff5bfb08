"""Benchmark decontamination (operator 1): SimHash over item-sized windows, Hamming blocks, exact verification.

Texts are lower-cased and cut into words of letters and digits; a shingle is five words (the whole text, if it has
fewer; for an item of fewer words, documents are cut into shingles of its own number of words). A window of a document has as many shingles as a benchmark item has (the whole document, if that is
shorter). A document is contaminated by an item if one of its windows of that size has

* a SimHash fingerprint within `radius` bits of the item's, and
* a weighted shingle similarity of at least `threshold`: the sum of the smaller over the sum of the larger
  number of times that each shingle occurs in the two.

Three steps, DataFrame operations only:

1. A window without any shingle of an item of its size has similarity zero, so only windows around a shared shingle are
   fingerprinted. Shingles meet by an equi-join on their 64-bit hash; a running sum along neighbouring windows
   gives their fingerprints, so work and rows grow with the text, not with the text times the item.
2. Fingerprints are cut into 8 blocks of 8 bits. Within `radius` bits, some block differs in at most `radius // 8`
   bits, so each item is listed under every block value that near, and windows join on size, block and
   value: all fingerprints within the radius are found.
3. Candidates are verified on the words themselves, not on hashes.

A radius of 20 of 64 bits lies over three standard deviations above the distance expected at a similarity of 0.8.

The item side is broadcast only after it has been counted; beyond that bound the joins are shuffled.

Defined results: null and empty texts contain nothing and contaminate nothing. Documents or items without an id take no
part. Repeated rows count as one. Very repetitive texts of any length cost what others do: windows of the same shingles are
verified once. Of equally similar windows the first is reported. Other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from countypanel.llm.common import small, stored, table, text_of

SHINGLE = 5
RADIUS = 20
THRESHOLD = 0.8

BLOCK_BITS = 8
#: Rows of at most 32 bytes: the hash table stays under 200 MB.
BROADCAST_ROWS = 2_000_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def shingle_count(words: Column, k: int) -> Column:
    return F.when(F.size(words) == 0, 0).otherwise(F.greatest(F.size(words) - (k - 1), F.lit(1)))


def shingle_hashes(words: Column, k: int) -> Column:
    """One 64-bit hash per shingle of words, in order; missing words at the end of a short text count as nothing.

    words should be a plain column: what it stands for is evaluated again for every shingle.
    """
    count = shingle_count(words, k)
    every = F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))),
                        lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)]))
    return F.slice(every, F.lit(1), count)


def shingle_texts(words: Column, k: int) -> Column:
    count = shingle_count(words, k)
    every = F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))),
                        lambda i: F.array_join(F.slice(words, i, F.lit(k)), " "))
    return F.slice(every, F.lit(1), count)


def _counters(hashed: Column) -> list[Column]:
    """The bits of a hash as 32 pairs of counters of 32 bits, of bit i and bit i + 32, to be summed."""
    return [F.shiftrightunsigned(hashed, i).bitwiseAND(F.lit((1 << 32) + 1)) for i in range(32)]


def _print_of(size: Column, sums: list[Column]) -> Column:
    """The bits set in over half of `size` hashes, from the sums of their counters."""
    # The sign of size - 2 * ones says whether a bit is set.
    fp = F.lit(0).cast("bigint")
    for i, s in enumerate(sums):
        for bit, ones in ((i, s.bitwiseAND(F.lit((1 << 32) - 1))), (i + 32, F.shiftrightunsigned(s, 32))):
            fp = fp.bitwiseOR(F.shiftleft(F.shiftrightunsigned(size - ones * 2, 63), bit))
    return fp


def fingerprints(shingles: DataFrame, keys: list[str], hashed: str) -> DataFrame:
    """keys and fp for rows of one shingle each."""
    sums = [F.sum(c).alias(f"s{i}") for i, c in enumerate(_counters(F.col(hashed)))]
    counted = shingles.groupBy(*keys).agg(F.count("*").alias("size"), *sums)
    return counted.select(*keys, _print_of(F.col("size"), [F.col(f"s{i}") for i in range(32)]).alias("fp"))


def runs(hits: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n, first and last of the hits (keys, n, pos) whose windows of n shingles follow each other without a gap."""
    along = Window.partitionBy(*keys, "n").orderBy("pos")
    new = F.coalesce(F.col("pos") - F.lag("pos").over(along) > F.col("n"), F.lit(True))
    numbered = hits.withColumn("new", new.cast("int")).withColumn("run", F.sum("new").over(along))
    return numbered.groupBy(*keys, "n", "run").agg(F.min("pos").alias("first"), F.max("pos").alias("last")).drop("run")


def window_fingerprints(found: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n, start and fp of the windows of n shingles that hold one of the hits of a run: found has keys, n, first, last, hashes.

    A running sum along a run takes in the counters of a hash and gives back those of the hash n places before, so a
    window costs one row however many shingles it has. Windows of a text with the same shingles as often are one: the first.
    """
    size = F.size("hashes")
    ranged = found.withColumn("width", F.least("n", size)).withColumn("a", F.greatest(F.lit(0), F.col("first") - F.col("n") + 1)).withColumn(
        "b", F.greatest(F.lit(0), F.least("last", size - F.col("n"))))
    steps = ranged.select(*keys, "n", "a", "width", "hashes", F.explode(F.sequence("a", F.col("b") + F.col("width") - 1)).alias("pos")).select(
        *keys, "n", "a", "width", "pos", F.get("hashes", F.col("pos")).alias("hash"),
        F.when(F.col("pos") - F.col("width") >= F.col("a"), F.get("hashes", F.col("pos") - F.col("width"))).alias("gone"))
    along = Window.partitionBy(*keys, "n", "a").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def rolled(of: list[Column], gone: list[Column]) -> list[Column]:
        return [F.sum(x - F.coalesce(y, F.lit(0))).over(along) for x, y in zip(of, gone, strict=True)]

    # Sums of 39 bits of two other hashes tell multisets of shingles apart; they don't overflow below 16 million shingles.
    def marks(column: str) -> list[Column]:
        return [F.shiftrightunsigned(F.xxhash64(F.col(column), F.lit(salt)), 25) for salt in (1, 2)]

    sums = rolled(_counters(F.col("hash")), _counters(F.col("gone")))
    seen = [F.when(F.col("gone").isNotNull(), x) for x in marks("gone")]
    summed = steps.select(*keys, "n", "width", "a", "pos", *[x.alias(f"s{i}") for i, x in enumerate(sums)],
                          *[x.alias(f"mark{i}") for i, x in enumerate(rolled(marks("hash"), seen))])
    whole = summed.where(F.col("pos") - F.col("a") + 1 >= F.col("width")).select(
        *keys, "n", "mark0", "mark1", (F.col("pos") - F.col("width") + 1).alias("start"),
        _print_of(F.col("width"), [F.col(f"s{i}") for i in range(32)]).alias("fp"))
    return whole.groupBy(*keys, "n", "fp", "mark0", "mark1").agg(F.min("start").alias("start")).drop("mark0", "mark1")


def _blocks(rows: DataFrame, near: int) -> DataFrame:
    """rows with fp, once for each block and each block value at most `near` bits away."""
    masks = [sum(1 << b for b in flips) for n in range(near + 1) for flips in combinations(range(BLOCK_BITS), n)]
    out = rows.withColumn("block", F.explode(F.array(*map(F.lit, range(64 // BLOCK_BITS)))))
    if near:
        out = out.withColumn("flip", F.explode(F.array(*map(F.lit, masks))))
    own = F.call_function("shiftrightunsigned", F.col("fp"), F.col("block") * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))
    return out.select(*rows.columns, "block", (own.bitwiseXOR(F.col("flip")) if near else own).cast("int").alias("value"))


def _occurrences(shingles: Column, one: Column) -> Column:
    return F.size(F.filter(shingles, lambda x: x == one))


def similarity(a: Column, b: Column) -> Column:
    """Weighted shingle similarity of two arrays of shingle texts."""
    plain = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))
    general = F.aggregate(F.array_distinct(F.array_intersect(a, b)), F.lit(0),
                          lambda s, x: s + F.least(_occurrences(a, x), _occurrences(b, x)))
    shared = F.when(plain, F.size(F.array_intersect(a, b))).otherwise(general)
    return shared / (F.size(a) + F.size(b) - shared)


def contamination(
    docs: DataFrame, benchmark: DataFrame, *, radius: int = RADIUS, threshold: float = THRESHOLD,
    k: int = SHINGLE, broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """doc_id, item_id, similarity, window_start (words before the best window) and bits (between fingerprints)."""
    length = F.size(words_of(text_of()))
    short = [r[0] for r in benchmark.where("item_id IS NOT NULL").select(length.alias("n")).where(F.col("n").between(1, k - 1)).distinct().collect()]
    found = _contamination(docs, benchmark.where(length >= k) if short else benchmark, radius, threshold, k, broadcast_rows)
    for n in sorted(short):
        found = found.unionByName(_contamination(docs, benchmark.where(length == n), radius, threshold, n, broadcast_rows))
    if not short:
        return found
    best = F.max(F.struct("similarity", (-F.col("window_start")).alias("s"), (-F.col("bits")).alias("b"))).alias("best")  # texts that share an id
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "best.similarity", (-F.col("best.s")).alias("window_start"), (-F.col("best.b")).alias("bits"))


def _contamination(docs: DataFrame, benchmark: DataFrame, radius: int, threshold: float, k: int, broadcast_rows: int) -> DataFrame:
    """contamination by items of k words or more, or by items of fewer words than that as whole documents."""
    words = F.col("words")
    items = stored(
        benchmark.where("item_id IS NOT NULL").select("item_id", words_of(text_of()).alias("words")).distinct()
        .where(F.size(words) > 0)
        .select("item_id", F.xxhash64(words).alias("item_key"), shingle_count(words, k).alias("n"),
                shingle_hashes(words, k).alias("hashes"), shingle_texts(words, k).alias("item_shingles")),
        "items",
    )
    item_hashes = items.select("item_id", "item_key", "n", F.explode("hashes").alias("hash"))
    probes = stored(
        _blocks(fingerprints(item_hashes, ["item_id", "item_key", "n"], "hash"), radius // (64 // BLOCK_BITS))
        .withColumnRenamed("fp", "item_fp"), "probes",
    )
    sizes = stored(item_hashes.select("hash", "n").distinct(), "item_shingles")

    # Step 1: where documents share a shingle with an item of which size.
    named = docs.where("doc_id IS NOT NULL").select("doc_id", text_of().alias("text"))
    of_doc = ["doc_id", "text_key"]
    shingled = named.select("doc_id", F.xxhash64("text").alias("text_key"), words_of(F.col("text")).alias("words")).select(
        *of_doc, F.posexplode(shingle_hashes(words, k)).alias("pos", "hash")
    )
    hits = stored(shingled.join(small(sizes, broadcast_rows), "hash").select(*of_doc, "n", "pos").distinct(), "hits")
    touched = hits.select(*of_doc).distinct()
    split = words_of(F.col("text"))
    # The words of the documents that share one, which is a small part of all unless most are contaminated.
    near = stored(
        named.withColumn("text_key", F.xxhash64("text")).join(small(touched, broadcast_rows), of_doc, "left_semi")
        .distinct().select(*of_doc, split.alias("words")).select(*of_doc, "words", shingle_hashes(words, k).alias("hashes")), "touched",
    )

    # Step 2: fingerprints of the windows around those places, and the items within the radius.
    around = near.select(*of_doc, "hashes").join(runs(hits, of_doc), of_doc)
    printed = _blocks(window_fingerprints(around, of_doc), 0)
    bits = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    candidates = (
        printed.join(small(probes, broadcast_rows), ["n", "block", "value"])
        .withColumn("bits", bits).where(F.col("bits") <= radius)
        .groupBy(*of_doc, "n", "item_id", "item_key", "start").agg(F.first("bits").alias("bits"))
    )

    # Step 3: the words themselves decide.
    window = F.slice("words", F.col("start") + 1, F.col("n") + (k - 1))
    shown = (
        candidates.join(near.select(*of_doc, "words"), of_doc).withColumn("words", window).withColumn("window_shingles", shingle_texts(words, k))
        .join(small(items.select("item_id", "item_key", "item_shingles"), broadcast_rows // 100), ["item_id", "item_key"])
        .withColumn("similarity", similarity(F.col("window_shingles"), F.col("item_shingles")))
        .where(F.col("similarity") >= threshold)
    )
    best = F.max(F.struct("similarity", (-F.col("start")).alias("s"), (-F.col("bits")).alias("b")))
    return shown.groupBy("doc_id", "item_id").agg(best.alias("best")).select(
        "doc_id", "item_id", "best.similarity", (-F.col("best.s")).alias("window_start"), (-F.col("best.b")).alias("bits")
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that no item contaminates; rows without doc_id stay."""
    found = stored(contamination(docs, benchmark).select(F.col("doc_id").alias("leaked")).distinct(), "leaks")
    return docs.join(small(found, BROADCAST_ROWS), docs.doc_id == found.leaked, "left_anti")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "similarity", "window_start")


#: Every window of every size against every item that shares a shingle with it, without fingerprints.
OP1_SQL = """
WITH d AS (
    SELECT DISTINCT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w
    FROM documents WHERE doc_id IS NOT NULL
), i AS (
    SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w
    FROM benchmark WHERE item_id IS NOT NULL
), ds AS (
    SELECT doc_id, w, CASE WHEN len(w) = 0 THEN 0 ELSE greatest(len(w) - 4, 1) END AS m FROM d
), dp AS (
    SELECT doc_id, m, p, array_to_string(w[p + 1 : p + 5], ' ') AS s FROM ds, unnest(range(m)) AS u(p)
), isz AS (
    SELECT item_id, w, CASE WHEN len(w) = 0 THEN 0 ELSE greatest(len(w) - 4, 1) END AS n FROM i
), ip AS (
    SELECT item_id, n, s, count(*) AS c
    FROM (SELECT item_id, n, array_to_string(w[p + 1 : p + 5], ' ') AS s FROM isz, unnest(range(n)) AS u(p)) GROUP BY ALL
), h AS (
    SELECT doc_id, m, p, s, item_id, n, c FROM dp JOIN ip USING (s)
), win AS (
    SELECT DISTINCT doc_id, m, item_id, n, a
    FROM h, unnest(range(greatest(0, p - n + 1), greatest(0, least(p, m - n)) + 1)) AS u(a)
), shared AS (
    SELECT win.doc_id, win.m, win.item_id, win.n, a, least(count(*), any_value(c)) AS k
    FROM win JOIN h ON h.doc_id = win.doc_id AND h.item_id = win.item_id AND h.p BETWEEN a AND a + win.n - 1
    GROUP BY win.doc_id, win.m, win.item_id, win.n, a, s
), sim AS (
    SELECT doc_id, item_id, a, sum(k) / (least(n, m) + n - sum(k)) AS similarity FROM shared GROUP BY doc_id, m, item_id, n, a
)
SELECT doc_id, item_id, max(similarity)::DOUBLE AS similarity, arg_max(a, (similarity, -a))::INT AS window_start
FROM sim WHERE similarity >= 0.8 GROUP BY 1, 2
"""
