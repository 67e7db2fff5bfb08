"""Token counts (operator 6): vocabulary strings that encode alone as one token are counted without merging.

Before any text is read, every end-of-word string of the vocabulary is encoded by itself; those that give exactly one
token form the whole-token set. A text is normalised and cut into pre-tokens as the vocabulary file says (composed,
white space to one space, lower case). A pre-token in the set counts one; only the others go through the merges.

Defined results: a null text counts as empty, which has no bytes and no tokens. Special strings of the vocabulary
count one token each where they stand. Repeated rows are counted each. Other columns are ignored.

A worker remembers the counts of at most twice `known_words` words; a word it forgot is merged again.
"""

from __future__ import annotations

import gc
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countypanel.llm.common import table, text_of

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048

_SPACES = "".join(map(chr, [*range(9, 14), 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]))
_SPACE = re.compile(f"[{_SPACES}]+")
_ODD_SPACE = re.compile("[\x1c-\x1f]")  # white space to Python alone
_BATCH = 4_000_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Counter:
    """Counts tokens of texts by one vocabulary file."""

    def __init__(self, path: str, known_words: int) -> None:
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.end = model["end_of_word_suffix"]
        self.ranks = {tuple(m.split(" ") if isinstance(m, str) else m): i for i, m in enumerate(model["merges"])}
        self.letters = byte_letters()
        specials = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, specials)))
        self.any_text = regex.compile(split.replace(r"[^\s", f"[^{_SPACES}"))
        self.plain_text = re.compile(
            split.replace(r"[^\s\p{L}\p{N}]", r"(?:[^\s\w]|_)").replace(r"[\p{L}]", r"[^\W\d_]").replace(r"[\p{N}]", r"\d")
        )
        self.plain: set[str] = set()
        self.known_words = known_words
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}
        self.whole = self.prove(Tokenizer.from_file(path), [v for v in model["vocab"] if v.endswith(self.end)])

    def prove(self, tokenizer, strings: list[str]) -> set[str]:
        """The texts of those strings that the library itself encodes as that one token."""
        byte_of = {c: b for b, c in enumerate(self.letters)}
        texts = []
        for s in strings:
            raw = bytes(byte_of[c] for c in s[: len(s) - len(self.end)])
            try:
                texts.append((s, raw.decode()))
            except UnicodeDecodeError:
                continue
        found = tokenizer.encode_batch([t for _, t in texts], add_special_tokens=False)
        return {t for (s, t), e in zip(texts, found, strict=True) if e.tokens == [s] and self.split(t) == [t]}

    def split(self, text: str) -> list[str]:
        new = set(text) - self.plain
        for c in new:
            if unicodedata.category(c) in ("Nl", "No") or c.isspace() != (c in _SPACES):
                return self.any_text.findall(text)
        self.plain |= new
        return self.plain_text.findall(text)

    def merged(self, word: str) -> int:
        """How many tokens the merges leave of one pre-token: lowest rank first, leftmost among equals."""
        parts: list[str | None] = [self.letters[b] for b in word.encode()]
        parts[-1] += self.end
        size = len(parts)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = [(r, i, i + 1) for i in range(size - 1) if (r := self.ranks.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        left = size
        while heap:
            r, i, j = heapq.heappop(heap)
            if parts[i] is None or after[i] != j or j >= size or self.ranks.get((parts[i], parts[j])) != r:
                continue
            parts[i] += parts[j]
            parts[j] = None
            left -= 1
            after[i] = after[j]
            if after[i] < size:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < size and (r := self.ranks.get((parts[x], parts[y]))) is not None:
                    heapq.heappush(heap, (r, x, y))
        return left

    def learn(self, pieces: set[str]) -> None:
        if len(self.known) > self.known_words:
            self.known, self.older = {}, self.known
        for x in pieces:
            if x not in self.known:
                n = self.older.get(x)
                if n is None:
                    n = sum(1 if w in self.whole else self.merged(w) for w in self.split(x))
                self.known[x] = n

    def pieces(self, text: str) -> list[str]:
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return text.split() if _ODD_SPACE.search(text) is None else [x for x in _SPACE.split(text) if x]

    def count(self, texts: list[str]) -> Iterator[int]:
        held, size = [], 0
        for at, text in enumerate(texts):
            parts = self.special.split(text) if "<" in text else [text]
            held.append((len(parts) - 1, [x for p in parts for x in self.pieces(p)]))
            size += len(text)
            if size < _BATCH and at + 1 < len(texts):
                continue
            self.learn(set().union(*[pieces for _, pieces in held]))
            for special, pieces in held:
                yield special + sum(map(self.known.__getitem__, pieces))
            held, size = [], 0


@lru_cache(maxsize=2)
def counter(path: str, known_words: int) -> Counter:
    """One per Python worker. Nothing here makes reference cycles, so they needn't be looked for."""
    gc.disable()
    return Counter(path, known_words)


def token_counts(docs: DataFrame, path: str, *, limit: int = LIMIT, known_words: int = 400_000) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row. path: a vocabulary file, readable on every executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path, known_words)
        for batch in batches:
            counts = pa.array(list(own.count(batch.column(1).to_pylist())), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), counts], ["doc_id", "n_bytes", "n_tokens"])

    texts = docs.select(F.col("doc_id").cast("bigint"), text_of(), F.octet_length(text_of()).cast("bigint"))
    return texts.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint").withColumn("over_limit", F.col("n_tokens") > limit)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
