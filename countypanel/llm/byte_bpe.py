"""Byte-level BPE encoding and decoding (operator 8): DuckDB recursive queries inside each Spark partition.

A text is cut into the matches of the split pattern. The distinct matches of a batch become token-position
rows in DuckDB; a recursive query joins neighbouring rows with the merge table and contracts, in every word at
once, the leftmost pair of the lowest rank, until no pair is left. An ordered aggregation turns the tokens of
a word into its ids. A document's ids are those of its words in order, and decoding puts the bytes of its ids in order.

Defined results: a null text counts as empty, and an empty text has no tokens. Repeated rows are encoded each for
itself. Other columns of the input are ignored.

Bounded memory: a query holds at most `batch_words` new distinct words, and fewer if their rows of all rounds, which it
keeps, could pass BATCH_ROWS. A task remembers the packed ids of words and forgets those it hasn't met for longest once they
take `known_bytes`; it holds twice as much at most, and what was forgotten is encoded again. All of it is given back when the task ends. A
recursive query contracts one pair of a word per round, so a word's rows and time grow with the square of its length; words of more than SQL_BYTES bytes (in practice lines without any
space) are contracted by the same rule with a heap instead.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import heapq
import re
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countypanel.llm.common import table, text_of, tidy

RANKS = "byte_bpe_multi_50k.tiktoken"
SQL_BYTES = 200
#: Rows of all rounds of a query, each of some 24 bytes; grouping and joining them takes several times as much, within DuckDB's limit.
BATCH_ROWS = 1_000_000
#: Characters of texts whose pieces are looked up at a time, and ids that are put in order at a time, but for longer texts.
TEXT_CHARS, IDS = 2_000_000, 200_000
#: What a remembered word takes besides its characters and ids: two objects and its share of a table that is up to two thirds empty.
ENTRY_BYTES = 49 + 33 + 160

#: Bytes of remembered words in a task of the query, whose workers do nothing else; with less, words that a task has forgotten come again.
KNOWN_BYTES = 150_000_000

#: Position bits in a row's key and in the packed minimum.
_BITS = 9
#: The white space of the split pattern, which is not quite Python's.
_SPACES = "".join(map(chr, [*range(9, 14), 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]))
_OTHER_SPACES = _SPACES.replace(" ", "")
#: Between the pieces of a text; no byte of UTF-8.
CUT = b"\xff"

# A row is one token: k = word << 9 | first byte, e = end byte, t = token id. Lower id means lower rank.
_MERGE_ALL = f"""
WITH RECURSIVE step(n, k, e, t) AS (
    SELECT 0, k, e, t FROM seed
    UNION ALL
    (
        WITH best AS (
            SELECT a.k >> {_BITS} AS w,
                   min((CAST(m.merged AS BIGINT) << {2 * _BITS}) | ((a.k & {(1 << _BITS) - 1}) << {_BITS}) | b.e) AS packed
            FROM step a
            JOIN step b ON b.k = (a.k >> {_BITS} << {_BITS} | a.e)
            JOIN merges m ON m.pair = (CAST(a.t AS BIGINT) << 32 | b.t)
            GROUP BY 1
        ), cut AS (
            SELECT w, packed >> {2 * _BITS} AS merged,
                   w << {_BITS} | (packed >> {_BITS} & {(1 << _BITS) - 1}) AS first,
                   packed & {(1 << _BITS) - 1} AS ending
            FROM best
        )
        SELECT n + 1, k, CASE WHEN k = first THEN ending ELSE e END,
               CASE WHEN k = first THEN merged ELSE t END
        FROM step JOIN cut ON step.k >> {_BITS} = cut.w
        WHERE k <= first OR k >= (w << {_BITS} | ending)
    )
), final AS (
    SELECT k >> {_BITS} AS w, max(n) AS n FROM step GROUP BY 1
)
SELECT final.w, list(step.t ORDER BY step.k) AS ids
FROM step JOIN final ON step.k >> {_BITS} = final.w AND step.n = final.n
GROUP BY 1 ORDER BY 1
"""


class Codec:
    """Encodes words by the ranks of one vocabulary; keeps the ids of what it has encoded, up to a bound."""

    def __init__(self, path: str, pattern: str, batch_words: int, known_bytes: int) -> None:
        import duckdb
        import regex

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        size = max(self.ranks.values()) + 1
        self.tokens, self.names = [b""] * size, list(map(str, range(size)))
        for b, i in self.ranks.items():
            self.tokens[i] = b
        self.any_text = regex.compile(pattern.replace(r"[^\s", f"[^{_SPACES}").replace(r"\S", f"[^{_SPACES}]").replace(r"\s", f"[{_SPACES}]"))
        #: Python's own expressions are several times faster; they agree on texts of plain characters.
        self.plain_text = re.compile(pattern.replace(r"[^\s\p{L}\p{N}]", r"(?:[^\s\w]|_)").replace(r"\p{L}", r"[^\W\d_]").replace(r"\p{N}", r"\d"))
        self.plain: set[str] = set()
        self.batch_words, self.known_bytes = batch_words, known_bytes
        self.packed = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0
        self.bytes = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        every = np.arange(size).astype(self.packed).tobytes()
        self.single = [every[i : i + self.packed.itemsize] for i in range(0, len(every), self.packed.itemsize)]
        pairs: dict[int, int] = {}
        for b, i in self.ranks.items():
            for cut in range(1, len(b)):
                left, right = self.ranks.get(b[:cut]), self.ranks.get(b[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = i
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "128MB", "temp_directory": ""})
        merges = pa.table({"pair": pa.array(pairs.keys(), pa.int64()), "merged": pa.array(pairs.values(), pa.int32())})  # noqa: F841
        self.db.execute("CREATE TABLE merges AS SELECT * FROM merges")

    def split(self, text: str) -> list[str]:
        """The matches of the pattern."""
        new = set(text) - self.plain
        for c in new:
            if unicodedata.category(c) in ("Nl", "No") or c.isspace() != (c in _SPACES):
                return self.any_text.findall(text)
        self.plain |= new
        return self.plain_text.findall(text)

    def cut(self, text: str) -> bytes:
        """text in UTF-8 with CUT before each single space that stands between two other characters; no match crosses such a place."""
        raw = text.encode()
        if not _loose(text):
            return raw.replace(b" ", CUT + b" ")
        parts = text.split(" ")
        out = parts[:1]
        for x in parts[1:]:
            if x and x[0] not in _SPACES and out[-1] and out[-1][-1] not in _SPACES:
                out.append(" " + x)
            else:
                out[-1] += " " + x
        return CUT.join([x.encode() for x in out])

    def learn(self, pieces: Iterable[str]) -> None:
        """Makes self.known hold the packed ids of every one of pieces."""
        if self.held > self.known_bytes:  # what was used since the last time stays
            self.known, self.older, self.held = {}, self.known, 0
        known, older = self.known, self.older
        fresh = set(filterfalse(known.__contains__, pieces))
        if older:
            again = fresh.intersection(older)
            fresh -= again
            for x in again:
                self._keep(x, older[x])
        found, batch, held = {}, [], 0
        ranks, single, split = self.ranks, self.single, self.split

        def word(w: str) -> int:
            """Keeps w if it is one token or long, else puts it into the batch; what it takes."""
            b = w.encode()
            if (token := ranks.get(b)) is not None:
                known[w] = single[token]
            elif len(b) > SQL_BYTES:
                known[w] = np.array(self.by_heap(b), self.packed).tobytes()
            else:
                batch.append((w, b))
                return ENTRY_BYTES + 2 * len(b)
            return ENTRY_BYTES + len(w) + len(known[w])

        plain: set[str] = set()
        parts: set[str] = set()
        for x in fresh:
            if x[1:].isalpha() and x[0] == " ":  # one word for sure
                held += word(x)
                plain.add(x)
            else:
                found[x] = words = split(x)
                parts.update(words)
        for w in parts.difference(known, plain):
            if (ids := older.get(w)) is None:
                held += word(w)
            else:
                self._keep(w, ids)
        for part in self.batches(batch):
            for (w, _), ids in zip(part, self._merge([b for _, b in part]), strict=True):
                known[w] = ids
        self.held += held
        for x, words in found.items():
            if len(words) != 1:
                self._keep(x, b"".join([known[w] for w in words]))

    def _keep(self, piece: str, ids: bytes) -> None:
        self.known[piece] = ids
        self.held += ENTRY_BYTES + len(piece) + len(ids)

    def batches(self, words: list[tuple[str, bytes]]) -> Iterator[list[tuple[str, bytes]]]:
        """words in parts of at most batch_words words and, by n (n + 1) / 2 for n bytes, BATCH_ROWS rows; a word has fewer."""
        start = rows = 0
        for at, (_, b) in enumerate(words):
            more = len(b) * (len(b) + 1) // 2
            if at > start and (at - start >= self.batch_words or rows + more > BATCH_ROWS):
                yield words[start:at]
                start, rows = at, 0
            rows += more
        if words:
            yield words[start:]

    def _merge(self, words: list[bytes]) -> list[bytes]:
        lengths = np.array(list(map(len, words)))
        start = np.repeat(np.cumsum(lengths) - lengths, lengths)
        at = np.arange(lengths.sum()) - start
        seed = pa.table({  # noqa: F841
            "k": np.repeat(np.arange(len(words), dtype=np.int64), lengths) << _BITS | at, "e": at + 1,
            "t": self.bytes[np.frombuffer(b"".join(words), np.uint8)],
        })
        found = self.db.sql(_MERGE_ALL).to_arrow_table()
        ids = found.column("ids").combine_chunks()
        flat, ends = ids.flatten().to_numpy().astype(self.packed).tobytes(), (np.cumsum(ids.value_lengths().to_numpy()) * self.packed.itemsize).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def by_heap(self, word: bytes) -> list[int]:
        """The ids of one long word: lowest rank first, leftmost among equals."""
        ends = list(range(1, len(word) + 1))
        before = list(range(-1, len(word) - 1))
        alive = [True] * len(word)

        def rank(at: int) -> int | None:
            end = ends[at]
            return self.ranks.get(word[at : ends[end]]) if end < len(word) else None

        heap = [(r, at, ends[ends[at]]) for at in range(len(word)) if (r := rank(at)) is not None]
        heapq.heapify(heap)
        while heap:
            r, at, end = heapq.heappop(heap)
            if not alive[at] or ends[at] >= len(word) or ends[ends[at]] != end:
                continue
            gone = ends[at]
            alive[gone], ends[at] = False, end
            if end < len(word):
                before[end] = at
            for x in (before[at], at):
                if x >= 0 and (r := rank(x)) is not None:
                    heapq.heappush(heap, (r, x, ends[ends[x]]))
        return [self.ranks[word[at : ends[at]]] for at in range(len(word)) if alive[at]]

    def chunks(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of texts one after the other, and where those of each begin and end; some TEXT_CHARS characters of texts at a time.

        Different pieces alone become Python objects; what is done for every piece and every id is done by arrays.
        """
        sizes = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < len(texts):
            end = int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + TEXT_CHARS, "right"))
            end = max(start + 1, end)
            flat, first, counts, offsets = self._looked_up(texts[start:end])
            ends = np.concatenate([[0], np.cumsum(counts)])[offsets]
            done, last = 0, end - start
            while done < last:
                to = max(done + 1, int(np.searchsorted(ends, ends[done] + IDS, "right")) - 1)
                some = slice(offsets[done], offsets[to])
                n = counts[some]
                yield flat[np.repeat(first[some] - (np.cumsum(n) - n), n) + np.arange(n.sum())], ends[done : to + 1] - ends[done]
                done = to
            start = end

    def _looked_up(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The ids of the different pieces; for every piece of texts, where its ids begin among those and how many they are; where each text's pieces begin and end."""
        held = pc.split_pattern(pa.array([self.cut(text) if text else b"" for text in texts.to_pylist()], pa.large_binary()), CUT)
        offsets, coded = held.offsets.to_numpy(), held.values.dictionary_encode()
        del held
        pieces = coded.dictionary.cast(pa.large_string()).to_pylist()
        at = coded.indices.to_numpy()
        del coded
        pa.default_memory_pool().release_unused()
        self.learn(pieces)
        packed = [self.known[x] for x in pieces]
        counts = np.array(list(map(len, packed))) // self.packed.itemsize
        return np.frombuffer(b"".join(packed), self.packed), (np.cumsum(counts) - counts)[at], counts[at], offsets

    def encode(self, texts: pa.Array) -> Iterator[list[int]]:
        """The ids of each text."""
        for ids, ends in self.chunks(texts):
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                yield ids[a:b].tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def _loose(text: str) -> bool:
    """Whether a space stands at an end of the text or next to white space."""
    if text[0] == " " or text[-1] == " " or "  " in text:
        return True
    return any(c in text and (" " + c in text or c + " " in text) for c in _OTHER_SPACES)


def _joined(words: pa.Array, ids: np.ndarray, ends: np.ndarray, between: str) -> pa.Array:
    """The words of the ids of each text, joined."""
    lists = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), words.take(pa.array(ids)))
    return pc.binary_join(lists, pa.scalar(between.encode(), words.type))


def _sha256(texts: pa.Array) -> list[str]:
    return [hashlib.sha256(x.as_buffer()).hexdigest() for x in texts]


def encode(
    docs: DataFrame, path: str, pattern: str, *, keep_ids: bool = False, batch_words: int = 12_000, known_bytes: int = 36_000_000
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row; with keep_ids also ids, array of int.

    path: a rank file, readable on every executor. pattern: what cuts a text into words.
    """
    # Encoding and decoding is all that happens here; hashes are taken in the same pass so that ids needn't travel.
    fields = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # nothing here makes reference cycles, and looking for them among the words takes a quarter of the time
        own = Codec(path, pattern, batch_words, known_bytes)
        names, tokens = pa.array([x.encode() for x in own.names], pa.large_binary()), pa.array(own.tokens, pa.large_binary())
        for batch in batches:
            done = 0
            for ids, ends in own.chunks(batch.column(1)):
                counts = np.diff(ends)
                cols = [batch.column(0).slice(done, len(counts)), pa.array(counts, pa.int64()),
                        pa.array(_sha256(_joined(names, ids, ends, ",")), pa.string()), pa.array(_sha256(_joined(tokens, ids, ends, "")), pa.string())]
                if keep_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * keep_ids])
                done += len(counts)

    return docs.select(F.col("doc_id").cast("bigint"), text_of()).mapInArrow(tidy(run), fields)


def decode(ids: DataFrame, path: str) -> DataFrame:
    """doc_id and text (binary) of rows with doc_id and ids (array of int), by the same vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with open(path, "rb") as lines:
            tokens = {int(b): base64.b64decode(a) for a, b in map(bytes.split, lines)}
        for batch in batches:
            raw = [b"".join([tokens[i] for i in row or ()]) for row in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], ["doc_id", "text"])

    return ids.select(F.col("doc_id").cast("bigint"), "ids").mapInArrow(run, "doc_id bigint, text binary")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN, known_bytes=KNOWN_BYTES)
