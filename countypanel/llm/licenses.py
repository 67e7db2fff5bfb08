"""License scans (operator 7): canonical texts looked up by digest.

A text is made canonical: lower case, copyright notices dropped, equivalent spellings made one, punctuation and runs of white
space to single spaces. Notices are found line by line, whatever their length and number. A line that begins with a holder's sign and a year or 'by' is one, up to where a licence text
begins in it, as is a line that reserves all rights. Undated lines are notices where they open a paragraph that holds nothing else, or
stand before the rights; one with a word of running text, such as a verb, never is. The SHA-256 of the canonical text is joined with the digests of known texts, made canonical by the
same rule. What is looked up is always a whole text: the whole document, and each of its lines by itself (for one-line
notices). Nothing is matched in part.

Equal texts have equal first words, so only texts and lines whose first word is that of a known text are made canonical in full;
that is exact. The known texts are KNOWN_TEXTS and the files of license_texts, named by their SPDX id; licenses() takes any other list. They
are few, so their digests are broadcast. A document that repeats
a line is reduced to distinct digests in its own task, before any shuffle.

Defined results: null and empty texts match nothing, as do known texts without any word. Rows without doc_id take no
part; repeated rows, and rows that share a doc_id, count as one document. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countypanel.llm.common import table, text_of, tidy

# Fixed values: spellings that count as equal, as whole words, after lower-casing and before punctuation goes.
SPELLINGS = [
    ("licence", "license"), ("licenced", "licensed"), ("licences", "licenses"), ("sublicence", "sublicense"),
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"),
    ("capitalisations", "capitalizations"), ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"),
    ("emphasised", "emphasized"), ("favour", "favor"), ("favourite", "favorite"), ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"), ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"),
    ("labour", "labor"), ("maximise", "maximize"), ("modelled", "modeled"), ("noncommercial", "non commercial"),
    ("offence", "offense"), ("optimise", "optimize"), ("organisation", "organization"), ("organise", "organize"),
    ("practise", "practice"), ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"),
    ("signalling", "signaling"), ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"),
    ("per cent", "percent"), ("copyright owner", "copyright holder"), ("https", "http"),
]

# Fixed values: known texts.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use,
copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE
FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION
WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR
ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS
ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in
the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
KNOWN_TEXTS = [
    ("MIT", _MIT), ("MIT", "MIT License\n\n" + _MIT), ("MIT", "The MIT License\n\n" + _MIT), ("ISC", _ISC), ("ISC", "ISC License\n\n" + _ISC),
    ("BSD-2-Clause", _BSD_2), ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_2),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."), ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC0-1.0", "Licensed under CC0 1.0."), ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
]

TEXTS = Path(__file__).parent / "license_texts"
_BSD_3 = _BSD_2.replace("\n\nTHIS SOFTWARE", """

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from
this software without specific prior written permission.

THIS SOFTWARE""")
_END = "END OF TERMS AND CONDITIONS"
#: Lines that users of a text fill in.
_FILLED = re.compile(r"^[ \t]*Copyright \[yyyy\] \[name of copyright owner\][ \t]*\n", re.M)


@lru_cache(maxsize=1)
def known_texts() -> list[tuple[str, str]]:
    """KNOWN_TEXTS and the full common texts: as published, without what follows their terms, and without lines to fill in."""
    out = [*KNOWN_TEXTS, ("BSD-3-Clause", _BSD_3), ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_3)]
    for path in sorted(TEXTS.glob("*.txt")):
        text = path.read_text(encoding="utf-8")
        ends = text[: text.index(_END)] if _END in text else text
        out += [(path.stem, t) for t in dict.fromkeys([text, ends, ends + _END, _FILLED.sub("", text)])]
    return out


# Copyright notices, in lower case.
_OWN = r"copyright\s+\(c\)[\s\d,-]+free\s+software\s+foundation,\s+inc\.?(?:\s+<https?://fsf\.org/?>)?"  # the licence's own, wherever it is wrapped
_HOLDS = r"(?:copyright\b\s*(?:\(c\)|©)?|(?:\(c\)|©)\s*(?:copyright\b)?)[\s:,]*"
_DATED = rf"(?:{_HOLDS}(?:19|20)\d\d\b|(?:copyright\b\s*(?:\(c\)|©)?|©)\s*by\b)"
_MARKED = r"[ \t]*(?:[#*/;-]+[ \t]*)?"
_ALONE = r"[ \t]*(?:copyright\b|©)"
#: What users of a text fill in.
_TEMPLATE = r"[ \t]*(?:copyright\b|©)\s*(?:\(c\)\s*)?(?:[<\[_]|year\b|19[xy]{2})"
#: Words of running text; the name of a holder has none.
_RUNNING = (
    r"\b(?:is|are|was|were|be|been|means|shall|may|must|can|will|has|have|does|do|applies|protects|permits|grants|requires|notices?|laws?|holders?|owners?"
    r"|statements?|licen[cs]es?|licen[cs]ed|treaty|interest|disclaimer)\b"
)
_RIGHTS = r"[ \t]*all rights reserved\.?[ \t]*"
_BEGINS = r"permission\s+is\s+hereby\s+granted|permission\s+to\s+use|redistribution\s+and\s+use"
_TITLED = rf"(licen[cs]e[ \t]+){_DATED}.*?({_BEGINS})"  # a notice after a title in the same line
_SIGNS = ("copyright", "(c)", "©", "all rights reserved")


class Canonical:
    """The canonical form of texts."""

    def __init__(self) -> None:
        every = {name: re.compile(x) for name, x in (
            ("own", _OWN), ("dated", _MARKED + _DATED), ("alone", _ALONE), ("template", _TEMPLATE), ("running", _RUNNING), ("rights", _RIGHTS),
            ("begins", _BEGINS), ("titled", _TITLED), ("breaks", r"\r\n|\r|\n"), ("first", r"[^\W_]+"), ("gaps", r"[\W_]+"))}
        self.__dict__.update(every)
        self.usual = {" ".join(a.split()): b for a, b in SPELLINGS}
        self.spelled = re.compile(r"\b(?:" + "|".join(r"\s+".join(a.split()) for a, _ in sorted(SPELLINGS, key=lambda x: -len(x[0]))) + r")\b")

    def kind(self, line: str) -> str:
        if self.rights.fullmatch(line):
            return "rights"
        if self.dated.match(line):
            return "dated"
        return "alone" if self.alone.match(line) and not self.template.match(line) and not self.running.search(line) else ""

    def without_notices(self, low: str) -> list[str]:
        """The lines of a text in lower case, without its copyright notices."""
        if not any(sign in low for sign in _SIGNS):
            return self.breaks.split(low)
        lines = self.breaks.split(self.own.sub("\n", low))
        kinds = [self.kind(line) for line in lines]
        at = 0
        while at < len(lines):
            end = at
            while end < len(lines) and kinds[end]:
                end += 1
            # Undated lines go that open a paragraph of nothing else, or stand before the rights.
            whole = end == len(lines) or not lines[end].strip()
            opens = at == 0 or not lines[at - 1].strip()
            last = end if whole else max((n + 1 for n in range(at, end) if kinds[n] == "rights"), default=at)
            for n in range(at, end):
                if kinds[n] == "dated":
                    begins = self.begins.search(lines[n])
                    lines[n] = lines[n][begins.start() :] if begins else ""
                elif kinds[n] == "rights" or opens and n < last:
                    lines[n] = ""
            if end < len(lines):
                lines[end] = self.titled.sub(r"\1\2", lines[end])
            at = end + 1
        return lines

    def first_word(self, lines: list[str]) -> str:
        return next((m.group() for line in lines if (m := self.first.search(line))), "")

    def form(self, lines: list[str]) -> str:
        spelled = self.spelled.sub(lambda m: self.usual[" ".join(m.group().split())], "\n".join(lines))
        return self.gaps.sub(" ", spelled).strip()

    def digest(self, text: str) -> str | None:
        """The SHA-256 of the canonical form, None if no word is left."""
        form = self.form(self.without_notices(text.lower()))
        return hashlib.sha256(form.encode()).hexdigest() if form else None

    def possible_firsts(self, texts: Iterable[str]) -> frozenset[str]:
        """First words, before their spelling is made usual, of all texts with the canonical form of one of texts."""
        firsts = {self.form(self.without_notices(t.lower())).partition(" ")[0] for t in texts} - {""}
        return frozenset(firsts | {a.split()[0] for a, b in SPELLINGS if b.split()[0] in firsts})


def known_digests(spark: SparkSession, texts: list[tuple[str, str]]) -> DataFrame:
    own = Canonical()
    rows = {(i, d) for i, t in texts if (d := own.digest(t)) is not None}
    return spark.createDataFrame(sorted(rows), "license_id string, digest string")


def digests(docs: DataFrame, texts: list[tuple[str, str]]) -> DataFrame:
    """doc_id, whole and digest of the texts and lines of docs that begin with the first word of a known text, as all equal ones do."""
    firsts = Canonical().possible_firsts(t for _, t in texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Canonical()
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                low = text.lower()
                lines = own.without_notices(low)
                found = {(True, own.form(lines))} if own.first_word(lines) in firsts else set()
                for line in set(own.breaks.split(low)):
                    kept = own.without_notices(line) if any(sign in line for sign in _SIGNS) else [line]
                    if own.first_word(kept) in firsts:
                        found.add((False, own.form(kept)))
                rows += [(doc, whole, hashlib.sha256(form.encode()).hexdigest()) for whole, form in found]
            if rows:
                kinds = (pa.int64(), pa.bool_(), pa.string())
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "whole", "digest"])

    named = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("bigint"), text_of())
    return named.mapInArrow(tidy(run), "doc_id bigint, whole boolean, digest string")


def licenses(docs: DataFrame, texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """doc_id, license_id, whole_text, in_lines of every document and license (of texts, or known_texts()) found as its whole text
    or a whole line."""
    texts = known_texts() if texts is None else texts
    known = known_digests(docs.sparkSession, texts)
    found = digests(docs, texts).join(F.broadcast(known), "digest")  # as many rows as the list of known texts has
    return found.groupBy("doc_id", "license_id").agg(F.max("whole").alias("whole_text"), F.max(~F.col("whole")).alias("in_lines"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses(table(spark, sf_dir, "documents"))


def _sql_form(text: str) -> str:
    for spelling, usual in SPELLINGS:
        text = rf"regexp_replace({text}, '\b{spelling.replace(' ', chr(92) + 's+')}\b', '{usual}', 'g')"
    return rf"trim(regexp_replace({text}, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"


def _op7_sql() -> str:
    """The same rule on lines as rows: their kinds, the paragraphs and runs that they stand in, and the digests of what is left."""
    own = Canonical()
    known = sorted({(i, d) for i, t in known_texts() if (d := own.digest(t)) is not None})
    dated = rf"^{_MARKED}{_DATED}"
    cut = lambda x: f"regexp_extract({x}, '({_BEGINS}).*$')"  # noqa: E731
    return rf"""
WITH known(license_id, digest) AS (VALUES {", ".join(f"('{i}', '{d}')" for i, d in known)}),
doc AS (
    SELECT row_number() OVER () AS unit, doc_id, true AS whole, regexp_replace(lower(coalesce(text, '')), '{_OWN}', chr(10), 'g') AS t
    FROM documents WHERE doc_id IS NOT NULL
), unit AS (
    SELECT * FROM doc UNION ALL
    SELECT -row_number() OVER (), doc_id, false, t FROM (
        SELECT DISTINCT doc_id, unnest(regexp_split_to_array(lower(coalesce(text, '')), '
||
')) AS t FROM documents WHERE doc_id IS NOT NULL)
), line AS (
    SELECT unit, doc_id, whole, unnest(lines) AS x, generate_subscripts(lines, 1) AS n
    FROM (SELECT unit, doc_id, whole, regexp_split_to_array(t, '
||
') AS lines FROM unit)
), kind AS (
    SELECT *, CASE WHEN regexp_full_match(x, '{_RIGHTS}') THEN 'rights' WHEN regexp_matches(x, '{dated}') THEN 'dated'
        WHEN regexp_matches(x, '^{_ALONE}') AND NOT regexp_matches(x, '^{_TEMPLATE}') AND NOT regexp_matches(x, '{_RUNNING}') THEN 'alone'
        ELSE '' END AS kind, trim(x, ' ' || chr(9)) = '' AS blank
    FROM line
), run AS (
    SELECT *, sum((kind = '')::INT) OVER (PARTITION BY unit ORDER BY n) AS run FROM kind
), place AS (
    SELECT *, lead(blank) OVER (PARTITION BY unit ORDER BY n) AS before_blank, lag(blank) OVER (PARTITION BY unit ORDER BY n) AS after_blank FROM run
), state AS (
    SELECT *, min_by(coalesce(after_blank, true), n) FILTER (WHERE kind <> '') OVER r AS opens,
           max_by(coalesce(before_blank, true), n) FILTER (WHERE kind <> '') OVER r AS whole_run,
           max(n) FILTER (WHERE kind = 'rights') OVER r AS last_rights
    FROM place WINDOW r AS (PARTITION BY unit, run)
), form AS (
    SELECT unit, doc_id, whole, string_agg(CASE WHEN kind = 'dated' THEN {cut("x")}
            WHEN kind = 'rights' OR kind = 'alone' AND opens AND (whole_run OR n < last_rights) THEN ''
            WHEN kind = '' THEN regexp_replace(x, '{_TITLED}', '') ELSE x END, chr(10) ORDER BY n) AS t
    FROM state GROUP BY ALL
), digest AS (
    SELECT doc_id, whole, sha256({_sql_form("t")}) AS digest FROM form
)
SELECT doc_id, license_id, bool_or(whole) AS whole_text, bool_or(NOT whole) AS in_lines
FROM digest JOIN known USING (digest) GROUP BY ALL
"""


OP7_SQL = _op7_sql()
