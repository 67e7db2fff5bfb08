"""Packing (operator 13): first-fit decreasing with a tournament tree of bin capacities, in randomised groups of documents.

A document is its token ids and one end id. It is cut into full pieces of `size` ids, each a sequence of its own, and a
remainder. Remainders are dealt into groups at random (by a hash, so a repeated task deals them alike). A group packs its remainders
longest first, each into the first sequence with room: the leaves of a tree are the free places of the sequences, a node is the
most free places below it, and the leftmost leaf with room is found by one descent. What first-fit leaves free is then filled from
the emptiest sequences, whose ids move over piece by piece, cut where a sequence is full. All sequences of a group but the last
are full by then; the last is cut into sequences whose lengths are powers of two. So no sequence needs padding.

Defined results: a null text counts as empty, and an empty text is its end id alone. Repeated rows are packed each for itself; rows
equal in id and text are dealt apart by counting them within their task, so that no group grows with them. A null doc_id stays
null. Ties in length go by doc_id, then by ids. Very long texts are encoded where they lie; only their cut pieces, of `size` ids
at most, are shuffled. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countypanel.llm.common import table, text_of, tidy

VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
SIZE = 2048
END = 1
GROUP_DOCS = 2048

Piece = tuple[int, int, int]  # remainder, first id in it, ids


@lru_cache(maxsize=2)
def encoder(vocabulary: str, ranks: str) -> Callable[[str], np.ndarray]:
    """Ids of a text as the library for the vocabulary file gives them, special strings included.

    The rank file holds the same vocabulary for a library that is several times faster. That both agree is checked in the tests, and
    on the special strings, which are read from the vocabulary file, here.
    """
    import json

    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    with open(vocabulary, encoding="utf-8") as f:
        special = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    library = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens=special)
    return lambda text: library.encode_to_numpy(text, allowed_special="all")


def first_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Which of the lengths, longest first, lie in each bin: each goes to the first bin with room."""
    leaves = 1 << max(len(lengths) - 1, 0).bit_length()
    free = [size] * (2 * leaves)  # a tournament tree: a node holds the largest capacity below it
    bins: list[list[int]] = []
    for at, length in enumerate(lengths):
        node = 1
        while node < leaves:
            node *= 2
            node += free[node] < length
        if node - leaves == len(bins):
            bins.append([])
        bins[node - leaves].append(at)
        free[node] -= length
        while node > 1:
            node //= 2
            best = max(free[2 * node], free[2 * node + 1])
            if free[node] == best:
                break
            free[node] = best
    return bins


def filled(bins: list[list[Piece]], size: int) -> list[list[Piece]]:
    """The same ids in full bins: the fullest take what they lack from the emptiest, and the last is cut at powers of two."""
    used = sorted(([sum(n for _, _, n in b), at] for at, b in enumerate(bins)), key=lambda x: (-x[0], x[1]))
    bins = [list(bins[at]) for _, at in used]
    room = [size - n for n, _ in used]
    last = len(bins) - 1
    for at in range(len(bins)):
        while room[at] and at < last:
            piece, start, n = bins[last].pop()
            part = min(n, room[at])
            bins[at].append((piece, start + n - part, part))
            if n > part:
                bins[last].append((piece, start, n - part))
            room[at] -= part
            room[last] += part
            if not bins[last]:
                last -= 1
    bins = bins[: last + 1]
    if bins and room[last]:
        pieces, left = bins.pop(), size - room[last]
        while left:
            take = 1 << left.bit_length() - 1
            left -= take
            out = []
            while take:
                piece, start, n = pieces.pop()
                part = min(n, take)
                out.append((piece, start, part))
                if n > part:
                    pieces.append((piece, start + part, n - part))
                take -= part
            bins.append(out)
    return bins


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


_PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
_DEALT = _PIECES + ", ids binary, group int"
_PACKED = _PIECES + ", sequence_id bigint, offset bigint"


#: Rows that are taken out of a batch at a time, and bytes of ids that a task holds before it passes them on.
ROWS, HELD_BYTES = 256, 2_000_000


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    for at in range(0, batch.num_rows, ROWS):
        yield from zip(*[c.to_pylist() for c in batch.slice(at, ROWS).columns], strict=True)


def _narrow(ids: np.ndarray) -> bytes:
    """ids, two bytes each where they fit, else four; as little-endian numbers they sort alike."""
    return ids.astype("<u2" if ids.max() < 1 << 16 else "<u4").tobytes()


def _wide(packed: bytes, length: int) -> np.ndarray:
    return np.frombuffer(packed, f"<u{len(packed) // length}")


def _dealt(docs: DataFrame, encode: Callable[[], Callable[[str], np.ndarray]], size: int, end: int, groups: int) -> DataFrame:
    """Full pieces, and remainders with their ids, each with its group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, same = encode(), Counter()
        rows, held = [], 0
        for batch in batches:
            for doc, text in _rows(batch):
                ids = np.append(ids_of(text), end).astype("<u4")
                n, whole = len(ids), len(ids) // size * size
                key = doc, n, _crc(ids)
                same[key] += 1
                digest = hashlib.blake2b(repr((key, same[key])).encode(), digest_size=8).digest()
                group = int.from_bytes(digest) % groups
                rows += [(doc, at, size, _crc(ids[at : at + size]), n, None, group) for at in range(0, whole, size)]
                if whole < n:
                    rows.append((doc, whole, n - whole, None, n, _narrow(ids[whole:]), group))
                    held += len(rows[-1][5])
                if len(rows) >= 4096 or held >= HELD_BYTES:
                    yield _batch(rows, _DEALT)
                    rows, held = [], 0
        if rows:
            yield _batch(rows, _DEALT)

    return docs.select(F.col("doc_id").cast("bigint"), text_of()).mapInArrow(tidy(run), _DEALT)


_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _batch(rows: list[tuple], fields: str) -> pa.RecordBatch:
    names, types = zip(*(f.split() for f in fields.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def pack_group(remainders: list[tuple], size: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces of remainders, which come longest first and hold their length at place 2."""
    lengths = [r[2] for r in remainders]
    return filled([[(at, 0, lengths[at]) for at in b] for b in first_fit(lengths, size)], size)


def _sequences(remainders: list[tuple], group: int, size: int) -> tuple[list[tuple], int]:
    """Rows of the packed pieces, and how many sequences there are."""
    rows, packed = [], pack_group(remainders, size)
    whole = [_wide(r[5], r[2]) for r in remainders]
    for number, pieces in enumerate(packed):
        offset = 0
        for at, first, n in pieces:
            doc, start, _, _, total, _, _ = remainders[at]
            rows.append((doc, start + first, n, _crc(whole[at][first : first + n]), total, group << 32 | number, offset))
            offset += n
    return rows, len(packed)


def pack(
    docs: DataFrame, encode: Callable[[], Callable[[str], np.ndarray]], *, size: int = SIZE, end: int = END, group_docs: int = GROUP_DOCS
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    encode: gives, in a worker, a function from a text to its ids. size: a power of two. group_docs: how many documents a group has on average, which bounds the
    ids that a task holds.
    """
    groups = max(1, ceil(docs.count() / group_docs))
    open_first = [F.col("group"), F.col("ids").isNull(), F.desc("length"), F.asc_nulls_first("doc_id"), F.col("doc_tokens"), F.col("start"), F.col("ids")]
    dealt = _dealt(docs, encode, size, end, groups).repartition("group").sortWithinPartitions(*open_first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, remainders, sequences, out = None, [], 0, []
        for batch in batches:
            for row in _rows(batch):
                if remainders and (row[6] != group or row[5] is None):
                    rows, sequences = _sequences(remainders, group, size)
                    out += rows
                    remainders = []
                if row[6] != group:
                    group = row[6]
                    if row[5] is None:
                        sequences = 0
                if row[5] is not None:
                    remainders.append(row)
                else:
                    out.append((*row[:5], group << 32 | sequences, 0))
                    sequences += 1
                if len(out) >= 8192:
                    yield _batch(out, _PACKED)
                    out = []
        if remainders:
            out += _sequences(remainders, group, size)[0]
        if out:
            yield _batch(out, _PACKED)

    return dealt.mapInArrow(tidy(run), _PACKED)


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary, ranks = public_tokenizers.path(VOCABULARY), public_tokenizers.path(RANKS)
    return pack(table(spark, sf_dir, "documents"), lambda: encoder(vocabulary, ranks))
