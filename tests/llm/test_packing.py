"""Packing: first-fit against a plain search, every id in one piece, no padding, and the ids of the library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from countypanel.llm import packing
from countypanel.llm.packing import encoder, filled, first_fit, op13_packing, pack

PATHS = public_tokenizers.path(packing.VOCABULARY), public_tokenizers.path(packing.RANKS)


@pytest.mark.parametrize("seed", range(30))
def test_first_fit_is_the_plain_search(seed):
    rng = random.Random(seed)
    size = rng.choice([8, 64, 2048])
    lengths = sorted((rng.randint(1, size) for _ in range(rng.randint(0, 200))), reverse=True)
    bins, free = [], []
    for at, n in enumerate(lengths):
        place = next((b for b, room in enumerate(free) if room >= n), len(free))
        if place == len(free):
            bins.append([])
            free.append(size)
        bins[place].append(at)
        free[place] -= n
    assert first_fit(lengths, size) == bins
    packed = filled([[(at, 0, lengths[at]) for at in b] for b in bins], size)
    used = [sum(n for _, _, n in b) for b in packed]
    assert sum(used) == sum(lengths) and all(n == size or n & (n - 1) == 0 for n in used)
    held = sorted(p for b in packed for p in b)
    whole = {}
    for at, start, n in held:  # pieces of a remainder follow each other without a gap
        assert start == whole.get(at, 0) and n > 0
        whole[at] = start + n
    assert whole == dict(enumerate(lengths))


def check(rows, ids_of, size):
    """rows hold every id of every text once, in gapless sequences that need no padding."""
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length, r.ids_crc32))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in sequences.values():
        held.sort()
        assert [o for o, _ in held] == list(np.cumsum([0] + [n for _, n in held])[:-1])
        total = sum(n for _, n in held)
        assert total <= size and (total == size or total & (total - 1) == 0)
    want = {}
    for doc, ids in ids_of:
        want.setdefault((doc, len(ids)), []).append(ids)
    assert set(pieces) == set(want)
    for key, texts in want.items():
        for start, length, crc in pieces[key]:
            assert any(zlib.crc32(np.asarray(ids[start : start + length], "<u4").tobytes()) == crc for ids in texts)
        assert sum(n for _, n, _ in pieces[key]) == key[1] * len(texts)
        if len(texts) == 1:
            at = 0
            for start, length, _ in sorted(pieces[key]):
                assert start == at and length > 0
                at += length


def test_odd_rows(spark, documents):
    rng = random.Random(5)
    texts = ["", None, "a", "word " * 30_000, "x" * 50_000, " " * 20_000, "a <|endoftext|> b", "Ünï çødé \U0001f600\n\n\t end", "퟿\x00"]
    texts += [" ".join(rng.choice(["lo", "rem", "ip"]) for _ in range(rng.randint(1, 900))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "same"), (5, None)] + [(900, "copy of a row")] * 300
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATHS[0])
    ids = [(i, [*library.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in rows]
    data = documents(rows).repartition(3)
    for size, group in ((2048, 2048), (64, 20)):
        got = pack(data, lambda: encoder(*PATHS), size=size, group_docs=group).collect()
        check(got, ids, size)
    assert len({r.sequence_id >> 32 for r in got if r.doc_id == 900}) > 5  # equal rows are dealt apart
    again = pack(data, lambda: encoder(*PATHS), size=64, group_docs=20).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert pack(data.limit(0), lambda: encoder(*PATHS)).count() == 0


def test_the_query_holds_the_ids_of_the_library(spark):
    from tokenizers import Tokenizer

    folder = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    library = Tokenizer.from_file(PATHS[0])
    ids = [(r.doc_id, [*e.ids, 1]) for r, e in zip(rows, library.encode_batch([r.text or "" for r in rows], add_special_tokens=False), strict=True)]
    check(op13_packing(spark, folder).collect(), ids, 2048)


def test_ids_travel_in_two_bytes_where_they_fit(spark, documents):
    data = documents([(i, "x" * (i % 3000)) for i in range(3000)]).coalesce(1)

    def wide():  # every third text has ids beyond 16 bits
        return lambda text: np.arange(len(text), dtype=np.uint32) + (70_000 if len(text) % 3 == 0 else 3)

    dealt = packing._dealt(data, wide, 2048, 1, 2).filter("ids IS NOT NULL").selectExpr("length(ids) / length AS w", "doc_tokens", "length").collect()
    assert {(r.doc_tokens - 1) % 3 == 0 and r.doc_tokens > 1 and r.length > 1 for r in dealt if r.w == 4} == {True}
    assert {(r.doc_tokens - 1) % 3 == 0 and r.doc_tokens > 1 and r.length > 1 for r in dealt if r.w == 2} == {False}
    check(pack(data, wide, group_docs=1500).collect(), [(i, [*wide()("x" * (i % 3000)).tolist(), 1]) for i in range(3000)], 2048)
    (batch,) = data.select("doc_id", "text").toArrow().combine_chunks().to_batches()
    assert list(packing._rows(batch)) == [(i, "x" * (i % 3000)) for i in range(3000)]
