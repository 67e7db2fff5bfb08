"""Operators on whole texts, against the libraries themselves, brute force and round trips."""

import base64
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from countypanel.llm import byte_bpe, decontaminate, html_text, licenses, simhash_dedup, token_counts

ODD = [
    "", " ", "a", "  two  spaces\n\n end ", "x \n y\t\tz  ", "it's we'll  don't 12345 ²½ 中文字 ñandú\x1c\x1d a\x1cb", "a" * 700, " " * 90,
    "é" * 150, "ab cd　 e", "<|endoftext|>", "x<|startoftext|>Y <|endoftext|>z", "\U0001f600\U0001f601 ok", " lead", "trail ",
    "ΟΔΥΣΣΕΥΣ İstanbul", "tab\tand\r\nlines", "don't can't I'LL", "The quick brown fox. " * 200, "_under_score __ x_1", "é é ﬁ",
]


@pytest.fixture(scope="module")
def odd_documents(documents):
    return documents([*enumerate(ODD), (100, None), (3, ODD[3]), (None, "no id")])


def test_byte_bpe_agrees_with_the_library(odd_documents):
    import tiktoken

    path = public_tokenizers.path(byte_bpe.RANKS)
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = byte_bpe.encode(odd_documents, path, public_tokenizers.PATTERN, keep_ids=True)
    rows = got.collect()
    assert len(rows) == len(ODD) + 3
    texts = {r.doc_id: r.text or "" for r in odd_documents.collect()}
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert all(bytes(r.text).decode() == texts[r.doc_id] for r in byte_bpe.decode(got, path).collect())


def test_byte_bpe_of_the_test_table(spark, sf_dir):
    import tiktoken

    path = public_tokenizers.path(byte_bpe.RANKS)
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in byte_bpe.op8_byte_bpe(spark, sf_dir).collect():
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def _ids(own, packed):
    return np.frombuffer(packed, own.packed).tolist()


def test_long_words_are_contracted_by_the_same_rule():
    own = byte_bpe.Codec(public_tokenizers.path(byte_bpe.RANKS), public_tokenizers.PATTERN, 1000, 1000)
    for word in (b"the" * 40, "straße".encode() * 20, b"aaaabaaab" * 15):
        (ids,) = own._merge([word])
        assert _ids(own, ids) == own.by_heap(word) and own.decode(_ids(own, ids)) == word


def test_many_long_words_fit_into_memory():
    import random

    rng = random.Random(5)
    words = ["".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(60)) for _ in range(6000)]
    own = byte_bpe.Codec(public_tokenizers.path(byte_bpe.RANKS), public_tokenizers.PATTERN, 10_000, 48_000_000)
    own.learn(set(words))
    for w in words:
        assert own.decode(_ids(own, own.known[w])) == w.encode()
    for w in words[::100]:
        assert _ids(own, own.known[w]) == own.by_heap(w.encode())


def test_what_is_remembered_is_bounded():
    import random

    rng = random.Random(6)
    own = byte_bpe.Codec(public_tokenizers.path(byte_bpe.RANKS), public_tokenizers.PATTERN, 2000, 300_000)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=7)) for _ in range(800)) + " the same words" for _ in range(20)]
    assert [own.decode(i) for i in own.encode(pa.array(texts * 2))] == [t.encode() for t in texts * 2]
    for t in texts:
        assert [own.decode(i) for i in own.encode(pa.array([t]))] == [t.encode()]
        assert own.held <= 300_000 + 800 * 400
    assert len(own.known) + len(own.older) < 6000  # of 16,000 words


def test_the_query_encodes_no_word_of_a_usual_task_twice(monkeypatch):
    met = []
    monkeypatch.setattr(byte_bpe.Codec, "_merge", lambda self, words: met.extend(words) or [b"\0\0"] * len(words))
    own = byte_bpe.Codec(public_tokenizers.path(byte_bpe.RANKS), public_tokenizers.PATTERN, 12_000, byte_bpe.KNOWN_BYTES)
    words = [" " + "".join(chr(97 + i // 26**k % 26) for k in range(4)) + "qxzjkv" for i in range(200_000)]
    for _ in range(3):
        for at in range(0, len(words), 20_000):
            own.learn(set(words[at : at + 20_000]))
    assert len(met) == len(set(met)) == len(words)


def test_a_piece_that_comes_often_is_looked_up_once():
    class Counted(dict):
        asked = 0

        def __getitem__(self, piece):
            Counted.asked += 1
            return super().__getitem__(piece)

    own = byte_bpe.Codec(public_tokenizers.path(byte_bpe.RANKS), public_tokenizers.PATTERN, 1000, 1_000_000)
    own.known = Counted()
    texts = ["the same words again, " * 2000, None, "", "the same words"]
    assert [own.decode(i).decode() for i in own.encode(pa.array(texts))] == [t or "" for t in texts]
    assert Counted.asked < 100


def test_texts_of_all_kinds_of_spaces_are_cut_where_the_pattern_cuts():
    import random

    rng = random.Random(8)
    own = byte_bpe.Codec(public_tokenizers.path(byte_bpe.RANKS), public_tokenizers.PATTERN, 1000, 1_000_000)
    texts = ["".join(rng.choices(" \n\t\0\r\x85\xa0\u2003\u3000\x1cab7'.é字", [9, *[1] * 16], k=rng.randrange(1, 30))) for _ in range(2000)]
    for text, ids in zip(texts, own.encode(pa.array(texts)), strict=True):
        assert ids == [i for w in own.any_text.findall(text) for i in own.by_heap(w.encode())], repr(text)


def test_byte_bpe_of_an_empty_table_and_a_very_long_text(spark, documents):
    path = public_tokenizers.path(byte_bpe.RANKS)
    assert byte_bpe.encode(documents([(1, "a")]).limit(0), path, public_tokenizers.PATTERN).count() == 0
    text = "some words, " * 400_000
    (row,) = byte_bpe.encode(documents([(1, text)]), path, public_tokenizers.PATTERN).collect()
    assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_token_counts_agree_with_the_library(spark, odd_documents, sf_dir):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(token_counts.VOCABULARY)
    library = Tokenizer.from_file(path)
    for docs in (odd_documents, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        texts = {r.doc_id: r.text or "" for r in docs.collect()}
        rows = token_counts.token_counts(docs, path, known_words=500).collect()
        assert len(rows) == docs.count()
        for r in rows:
            assert r.n_tokens == len(library.encode(texts[r.doc_id], add_special_tokens=False).ids), texts[r.doc_id]
            assert r.n_bytes == len(texts[r.doc_id].encode()) and r.over_limit == (r.n_tokens > 2048)


def brute_fingerprint(text):
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates_are_those_of_brute_force(documents):
    base = " ".join(f"word{i} of text{i % 7}" for i in range(400))
    near = [base.replace(f"word{i} ", f"other{i} ") for i in range(12)]
    rows = [*enumerate([*ODD, base, *near, base.upper()]), (200, None), (3, ODD[3]), (201, base), (None, base)]
    docs = documents(rows)
    got = simhash_dedup.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    prints = {i: brute_fingerprint(t) for i, t in rows if i is not None}
    parent = {i: i for i in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sorted(prints):
        for j in sorted(prints):
            if i < j and (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert r.fp % (1 << 64) == prints[r.doc_id] and r.component_id == find(r.doc_id)
    kept = simhash_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()) == sorted({find(i) for i in prints})
    assert kept.where("doc_id IS NULL").count() == 1


def test_links_are_found_at_every_distance_up_to_the_bound(spark):
    import random

    rng = random.Random(3)
    prints = {rng.getrandbits(64) for _ in range(40)}
    prints |= {p ^ sum(1 << b for b in rng.sample(range(64), k)) for p in prints for k in (1, 3, 4, 5)}
    signed = [p - (1 << 64) if p >> 63 else p for p in sorted(prints)]
    rows = list(enumerate(signed))
    got = simhash_dedup.links(spark.createDataFrame(rows, "id bigint, fp bigint"))
    want = {(a, b) for a, x in rows for b, y in rows if a < b and ((x ^ y) % (1 << 64)).bit_count() <= 4}
    found = [(r.a, r.b) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == want


def test_a_long_chain_is_one_component(spark):
    from countypanel.llm.components import components

    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 200), (300, 100)] + [(500, 500 + i) for i in range(1, 30)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[i] == 1 for i in range(1, 61)) and got[300] == got[200] == 100 and all(got[500 + i] == 500 for i in range(30))


ITEM = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega"


def test_contamination_is_that_of_brute_force(spark, documents):
    filler = " ".join(f"w{i}" for i in range(60))
    item_2 = "one two three one two three one two three one two three four"
    rows = [
        (1, f"{filler} {ITEM} {filler}"), (2, f"{filler} {ITEM.upper().replace(' ', ', ')}!"), (3, filler), (4, None), (5, ""),
        (6, ITEM.replace("omega", "end")), (7, " ".join(ITEM.split()[:12]) + " " + filler), (8, f"{item_2} {item_2}"),
        (9, f"{ITEM} {filler} {ITEM}"), (9, f"{ITEM} {filler} {ITEM}"), (None, ITEM), (10, "short text"), (11, ITEM.replace("mu", "XX")),
    ]
    bench = spark.createDataFrame([(1, ITEM), (1, ITEM), (2, item_2), (3, None), (4, ""), (5, "Short text"), (None, ITEM)], "item_id bigint, text string")
    docs = documents(rows)
    got = {(r.doc_id, r.item_id): (r.similarity, r.window_start) for r in decontaminate.contamination(docs, bench).collect()}
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    shingles = lambda w: [" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []
    want = {}
    for d, t in rows:
        for i, b in [(1, ITEM), (2, item_2), (5, "Short text")]:
            item, doc = shingles(words(b)), shingles(words(t))
            best = (0, 0)
            for s in range(max(1, len(doc) - len(item) + 1)):
                window = doc[s : s + len(item)]
                shared = sum(min(window.count(x), item.count(x)) for x in set(item))
                if shared:
                    best = max(best, (shared / (len(window) + len(item) - shared), -s))
            if d is not None and best[0] >= 0.8:
                want[d, i] = (best[0], -best[1])
    assert got == want and {(1, 1), (2, 1), (8, 2), (9, 1), (10, 5)} <= want.keys()
    kept = decontaminate.keep_clean(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 3, 4, 5, 7, 11]
    assert decontaminate.contamination(docs, bench, broadcast_rows=0).count() == len(want)
    assert decontaminate.contamination(docs, bench.limit(0)).count() == decontaminate.contamination(docs.limit(0), bench).count() == 0


def test_windows_of_repetitive_texts_have_their_fingerprints(spark):
    """Every window around a hit, up to windows of equal shingles, against fingerprints taken one by one."""
    from pyspark.sql import functions as F

    rng = random.Random(5)
    texts = {1: [7] * 50, 2: [1, 2, 3] * 20, 3: [rng.randrange(3) for _ in range(80)], 4: [5, 6], 5: list(range(90))}
    signed = {x: rng.getrandbits(64) - (1 << 63) for x in range(90)}
    hits = [(d, n, p) for d, t in texts.items() for n in (1, 4, 25) for p in range(len(t)) if rng.random() < 0.1 or p == 0]
    found = decontaminate.runs(spark.createDataFrame(hits, "doc bigint, n int, pos int"), ["doc"]).join(
        spark.createDataFrame([(d, [signed[x] for x in t]) for d, t in texts.items()], "doc bigint, hashes array<bigint>"), "doc")
    rows = decontaminate.window_fingerprints(found, ["doc"]).withColumn("fp", F.col("fp").cast("bigint")).collect()
    want = {}
    for d, n, p in sorted(hits):
        hashes = [signed[x] for x in texts[d]]
        for s in range(max(0, p - n + 1), max(0, min(p, len(hashes) - n)) + 1):
            window = hashes[s : s + n]
            fp = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in window) > len(window))
            key = (d, n, tuple(sorted(window)))
            want[key] = min(want.get(key, (s, fp)), (s, fp))
    assert sorted((r.doc, r.n, r.start, r.fp % (1 << 64)) for r in rows) == sorted((d, n, s, fp) for (d, n, _), (s, fp) in want.items())
    assert sum(n == 25 and d == 1 for d, n, _ in want) == 1


def test_a_very_repetitive_text_is_searched_in_proportion_to_its_length(spark, documents):
    docs = documents([(1, "same " * 20_000), (2, "one two three four " * 5_000), (3, "same " * 900), (4, "same " * 700)])
    bench = spark.createDataFrame([(1, "same " * 1_000), (2, "one two three four " * 250)], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): (r.similarity, r.window_start) for r in decontaminate.contamination(docs, bench).collect()}
    assert got.pop((3, 1)) == (pytest.approx(896 / 996), 0)
    assert got == {(1, 1): (1, 0), (2, 2): (1, 0)}


def test_short_items_are_found_within_longer_texts(spark, documents):
    bench = spark.createDataFrame([(1, "Short text"), (2, "four words of it"), (3, ITEM), (3, "Gone"), (4, "Gone")], "item_id bigint, text string")
    docs = documents([(1, f"before a SHORT, text {ITEM}"), (2, "text short"), (3, "Now four words of it."), (4, "short"), (5, "it is gone"), (6, f"gone {ITEM}"), (None, "gone")])
    rows = decontaminate.contamination(docs, bench).collect()
    got = {(r.doc_id, r.item_id): (r.similarity, r.window_start) for r in rows}
    assert len(rows) == len(got) and got == {(1, 1): (1, 2), (1, 3): (1, 4), (3, 2): (1, 1), (5, 3): (1, 2), (5, 4): (1, 2), (6, 3): (1, 0), (6, 4): (1, 0)}


PAGE = """<!DOCTYPE html><html><head><title>T {n}</title><style>p{{}}</style><script>var t="</p>";</script></head><body class="nav-open"><nav><ul><li>
<a href="/a">Menu {n}</a></li></ul></nav><!-- x --><div class="ad">Buy {n}</div><article><h1>Head {n}</h1><p><b>Bold&nbsp;start {n}.<br><p>Fish &amp;
chips {n} &lt;ok&gt; <i>in</i>line</p><div class="comments"><p>Reader {n}</p></div><form><input>Send</form></article><aside>Side {n}</aside><footer>&copy; {n}"""
PLAIN = """<html><body><div id="top"><p>Site name</p></div><div id="content"><p>Story {n} has a good many words of its own, {n} of them.</p><p>More {n}</p>
</div><div id="cookie-notice">We use cookies</div><div id="end"><p>Made here</p></div></body></html>"""


def test_main_text_is_the_article(spark):
    rows = [(n, f"http://one.example/{n}", PAGE.format(n=n)) for n in range(5)]
    rows += [(10 + n, f"http://two.example/{n}", PLAIN.format(n=n)) for n in range(5)]
    rows += [(20, "http://alone.example/", PAGE.format(n=20)), (21, None, None), (22, "not a url", ""), (0, "http://one.example/0", PAGE.format(n=0)),
             (23, "http://one.example/x", "<article><p>cut &am"), (24, "http://one.example/y", "<article>long " + "word " * 50_000 + "</article>")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id bigint, url string, html string, host int")
    got = html_text.main_text(pages).collect()
    assert len(got) == len(rows)
    text = {r.page_id: r.text for r in got}
    for n in (*range(5), 20):
        assert text[n] == f"Head {n} Bold start {n}. Fish & chips {n} <ok> inline"
    for n in range(5):
        assert text[10 + n] == f"Story {n} has a good many words of its own, {n} of them. More {n}"
    assert text[21] == text[22] == "" and text[23] == "cut &am" and len(text[24]) == 5 * 50_001 - 1
    assert html_text.main_text(pages.limit(0)).count() == 0


BOXED = """<html><body><article><h1>Head {n}</h1><div class="toc"><p>Contents</p><p>On this page</p></div><p>Story {n} of its own.</p>{list}
<div class="tags"><span>Tagged</span> as news</div><p>{copied}</p></article></body></html>"""


def test_template_text_within_the_article_is_dropped(spark):
    items = lambda n: "".join(f"<div class='step'><p>Read on</p><p>Step {n}.{i}</p></div>" for i in range(2 + n % 3))
    rows = [(n, f"http://boxed.example/{n}", BOXED.format(n=n, list=items(n), copied="Copied to some." if n < 6 else f"Own {n}")) for n in range(10)]
    rows += [(20 + n, f"http://same.example/{n}", "<html><body><article><h1>One</h1><p>text for all</p></article></body></html>") for n in range(5)]
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    for n in range(10):
        steps = " ".join(f"Step {n}.{i}" for i in range(2 + n % 3))
        assert got[n] == f"Head {n} Story {n} of its own. {steps} {'Copied to some.' if n < 6 else f'Own {n}'}"
    assert all(got[20 + n] == "One text for all" for n in range(5))


NAMED = """<html><body class="no-sidebar"><div class="wrapper has-sidebar ad-free"><div class="sidebar-left"><p>Aside {n}</p></div><div class="search-results">
<article class="post"><header class="entry-header post-header"><h1>Head {n}</h1></header><div class="header"><p>Lead {n}</p></div>
<div class="elementor-widget-container"><p>Story {n}</p></div><div class="ad-3">Buy {n}</div><div class="related"><article>Other {n}</article></div></article>
</div></div><div id="site_footer">Foot {n}</div></body></html>"""
UNDER = '<html><body><div class="widget"><main><p>Story {n}</p></main></div><aside><article>Teaser {n}</article></aside></body></html>'
BARE = """<html><body><div class="with-sidebar"><div class="entry-header"><p>Head {n}</p></div><p>Story {n} in some words</p></div>
<div class="sidebar">Side {n}</div></body></html>"""


def test_only_whole_names_mark_asides(spark):
    rows = [(i * 10 + n, f"http://names{i}.example/{n}", page.format(n=n)) for i, page in enumerate((NAMED, UNDER, BARE)) for n in range(5)]
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    for n in range(5):
        assert got[n] == f"Head {n} Lead {n} Story {n}"
        assert got[10 + n] == f"Story {n}" and got[20 + n] == f"Head {n} Story {n} in some words"


def test_classes_are_ordered_and_nested():
    classes = {1: (0, 0), 2: (0, 1), 3: (0, 2), 7: (1, 0), 8: (1, 1)}
    fixed, loose, places = html_text.arrange([1, 7, 8, 5, 7, 8, 2, 3], classes)
    assert fixed == {0, 1, 2, 4, 5, 6, 7} and not loose and places[0] == 0 and places[1] not in (0, None)
    assert html_text.arrange([1, 2, 7, 8, 3], classes)[2][1] not in (places[1], None)  # another gap
    assert html_text.arrange([1, 7, 2, 8, 3], classes)[2][1] is None  # crosses
    assert html_text.arrange([1, 7, 8, 2, 7, 8, 3], classes)[2][1] is None  # two gaps
    assert html_text.arrange([2, 1, 5, 3], classes)[1] in ({1}, {2})  # out of order


def test_main_text_of_the_test_pages(spark, sf_dir):
    import html

    got = {r.page_id: r for r in html_text.op3_html_text(spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"</?(?:p|h1|br)>", " ", re.sub(r"</?b>", "", inner))).split())
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want)


def test_licenses_are_found_in_any_spelling(spark, documents):
    mit = next(t for i, t in licenses.KNOWN_TEXTS if t.startswith("The MIT"))
    rows = [
        (1, mit.replace("\n", "  \n")), (2, "Copyright (c) 2020 A\n" + mit.upper()), (3, f"Text.\n{'Licenced under CC BY-NC 4.0 !!'}\nmore"),
        (4, "Released under the MIT Licence"), (5, None), (6, ""), (7, "Released under the MIT License. And more."), (None, mit),
        (8, "Copyright 2020 A"), (9, mit), (9, mit), (10, "MIT\n" + "word " * 100_000),
    ]
    docs = documents(rows)
    got = {(r.doc_id, r.license_id): (r.whole_text, r.in_lines) for r in licenses.licenses(docs).collect()}
    assert got == {(1, "MIT"): (True, False), (2, "MIT"): (True, False), (3, "CC-BY-NC-4.0"): (False, True), (4, "MIT"): (True, True), (9, "MIT"): (True, False)}
    assert licenses.licenses(docs.limit(0)).count() == 0


def test_notices_of_any_length_and_number_are_dropped(spark, documents):
    mit = next(t for i, t in licenses.KNOWN_TEXTS if t.startswith("Perm"))
    holders = "".join(f"Copyright (c) Maker Number {i} and Company\n" for i in range(30))
    rows = [
        (1, "Copyright (c) " + "A. Rele and B. Rele and " * 10 + "Sons\n\n" + mit), (2, holders + "\n" + mit),
        (3, holders + "All rights reserved.\n" + mit), (4, "Copyright 2020 " + "x" * 2000 + "\n" + mit),
        (5, "MIT License   Copyright 2020 " + "y " * 400 + " ".join(mit.split())),
        (6, "Copyright law is long.\n\n" + mit), (7, "Copyright Somebody\n" + mit), (8, "Copyright (c) <year> Somebody\n\n" + mit),
        (9, "Copyright (c) 2020 A\nCopyright B\nCopyright C\n\n" + mit),
    ]
    got = {r.doc_id for r in licenses.licenses(documents(rows)).where("whole_text").collect()}
    assert got == {1, 2, 3, 4, 5, 9}


def test_licenses_of_planted_texts_agree_with_their_sql(spark, documents):
    import duckdb

    full = sorted({t for _, t in licenses.known_texts()})
    notices = ["", "Copyright (c) 2020 A\n", "Copyright A\n\n", "© by B\nAll rights reserved\n", "# (c) 1999 C permission is hereby granted\n", "Copyright notice is here\n\n"]
    rows = [(i, n + t.replace("icense", "icence" if i % 2 else "icense") + "\n\nCopyright D\n" * (i % 3)) for i, (t, n) in enumerate((t, n) for t in full for n in notices)]
    docs = documents([*rows, (900, None), (901, ""), (None, full[0])])
    db = duckdb.connect()
    db.register("documents", docs.toArrow())
    got = sorted(map(str, map(tuple, licenses.licenses(docs).select("doc_id", "license_id", "whole_text", "in_lines").collect())))
    assert got == sorted(map(str, db.sql(licenses.OP7_SQL).select("doc_id, license_id, whole_text, in_lines").fetchall())) and len(got) > 150


def rewrapped(text, width):
    import textwrap

    return "\n\n".join(textwrap.fill(" ".join(x.split()), width, break_long_words=False, break_on_hyphens=False) for x in re.split(r"\n\s*\n", text))


def test_licenses_are_found_however_wrapped(spark, documents):
    full = sorted({(i, t) for i, t in licenses.known_texts() if len(t) > 300})
    assert {i for i, _ in full} >= {
        "Apache-2.0", "Artistic-1.0-Perl", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GFDL-1.2-only", "GFDL-1.3-only", "GPL-1.0-only", "GPL-2.0-only",
        "GPL-3.0-only", "ISC", "LGPL-2.0-only", "LGPL-2.1-only", "LGPL-3.0-only", "MIT", "MPL-1.1", "MPL-2.0"}
    widths = (30, 44, 60, 72, 79, 100, 100_000)
    rows = [(i, rewrapped(t, w)) for i, t in full for w in widths]
    notices = ("Copyright (c) 2020 A. Rele\n", "(c) 2020-2021 by A. Rele\nCopyright 2019 B\nAll rights reserved.\n\n", "Copyright (c) A. Rele\n\n", "# Copyright by A\r\n", "Copyright (c) 2020 A. Rele ")
    bare = [x for x in full if x[1].startswith(("Perm", "Redis"))]
    rows += [(i, n + rewrapped(t, w)) for i, t in bare for n in notices for w in (60, 100_000)]
    rows += [(i, f"{i} License Copyright (c) 2020 A. Rele " + " ".join(t.split())) for i, t in bare if i[:3] != "BSD"]
    rows.append(("Apache-2.0", (licenses.TEXTS / "Apache-2.0.txt").read_text().replace("[yyyy] [name of copyright owner]", "2020 A. Rele")))
    rows.append((None, full[0][1].replace("COPYRIGHT", "") + " but not quite"))
    got = {(r.doc_id, r.license_id) for r in licenses.licenses(documents([(n, t) for n, (_, t) in enumerate(rows)])).where("whole_text").collect()}
    assert got == {(n, i) for n, (i, _) in enumerate(rows) if i}
