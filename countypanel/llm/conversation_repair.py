"""Conversation structure repair (operator 11): cost DP, then prefix-doubling ranks that select the least of the cheapest audits.

A repaired conversation has the roles of `(s?(ua)+)?`. Where a repair stands is a node: a number of rows and one of four states (nothing
yet, after s, after u, after a). Edits are arcs with a letter and a cost: Delete, Insert, Keep, Rerole. A cost DP gives every node the least cost to
the end, and the arcs on cheapest ways. Nodes are then ranked by the first 1, 2, 4, ... letters of their least audit: a rank of 2n letters is that of the
pair of the ranks of n letters, here and at the node that n letters lead to, which a doubled pointer holds. By the ranks every node picks its arc
(least letter, then least rank of what follows), and the audit is read off the doubled pointers, all letters at once.

Rows are sorted by range of (conversation, turn, role, text), so tasks hold consecutive rows, however many a conversation has. A
conversation inside one task is repaired there. One that may go on in another task, or has over CHUNK_ROWS rows, is cut into
chunks of bounded size, one row each. Chunks look up in each other what they repeat, and each becomes a 4 x 4 matrix of least costs. The matrices are combined
backwards to the costs at every chunk's end; with these a chunk does the same DP and ranking by itself, and tells where its least way leaves it. Combined
forwards, that gives every chunk its state of entry. What goes through one task per conversation is a few numbers per chunk, and at the
end the pieces of the audit and of the hashed text, as a stream.

Defined results: a null role, text or, in the damage, key counts as one space; rows without conv_id are one conversation. Rows of one turn are
taken by role, then text. A role is known by its first letter; rows with none of s, u, a can't be kept. Equal rows are collapsed to one with a count before they are shuffled
by range, and count each. A conversation that the damage empties has zeros, an empty audit and the hash of nothing. An empty table gives no
rows. Other columns are ignored. Gaps beyond a long count as its greatest value.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from countypanel.llm.common import stored, table

KEEP, REROLE, DELETE, INSERT, TRUNCATED_KEPT = 0, 3, 4, 3, 3
LETTERS = np.frombuffer(b"DIKR", np.uint8)  # in the order of ties
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)

CHUNK_ROWS, CHUNK_BYTES = 4096, 4_000_000
#: Rows of whole conversations that a task repairs at a time.
BATCH_ROWS = 20_000

#: States: nothing yet, after s, after u, after a. What keeping a role (s, u, a, other) leads to; -1 where it can't be kept.
_KEPT = np.array([[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]])
#: What an inserted or changed role, the one that has to follow, leads to.
_NEXT = np.array([2, 2, 3, 2])
_NEVER = 1 << 50
#: Least cost when no row is left.
_AT_END = np.array([0, 2 * INSERT, INSERT, 0])
_SPACE = " \t\n\x0b\x0c\r"
_LEGAL = {"su", "ua", "au"}
#: Counts that add up over chunks.
ADDED = ("blank", "duplicate", "truncated", "illegal")


# --- the damage ------------------------------------------------------------------------------------------


def _damaged(rows: DataFrame) -> DataFrame:
    """conv ('' for null), turn, role, text and how often the row occurs; dropped rows stay with count 0."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    gone = F.col("kind") == 0
    plain = rows.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"), F.col("turn").cast("bigint").alias("turn"),
        spaced("role").alias("role"), spaced("text").alias("text"), kind.alias("kind"),
    )
    return plain.select(
        "conv", "turn",
        F.when(gone, "").when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(gone, "").otherwise(text).alias("text"),
        F.when(gone, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("copies"),
    ).groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))


# --- one conversation, or chunk of one -------------------------------------------------------------------


class Chunk:
    """Consecutive rows of a conversation."""

    def __init__(self, conv: str) -> None:
        self.conv, self.size = conv, 0
        self.turns: list[int | None] = []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.faults: list[int] = []
        self.digests: list[bytes] = []  # of rows that are neither blank nor repeat an earlier one of the task

    def add(self, turn: int | None, role: str, text: str, seen: set[bytes]) -> None:
        body = text.rstrip(_SPACE)
        digest = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest() if body else b""
        if not body:
            fault = BLANK
        elif digest in seen:
            fault, digest = DUPLICATE, b""
        else:
            seen.add(digest)
            fault = SOUND if body[-1] in ".!?" else TRUNCATED
        text = text if digest else ""  # others are deleted
        self.size += len(text) + len(role)
        for held, x in zip((self.turns, self.roles, self.texts, self.faults, self.digests), (turn, role, text, fault, digest), strict=True):
            held.append(x)

    @property
    def full(self) -> bool:
        return len(self.roles) >= CHUNK_ROWS or self.size >= CHUNK_BYTES


def initials(roles: list[str]) -> list[int]:
    return ["sua".find(r[0]) % 4 if r else 3 for r in roles]


def _counts(turns: list, roles: list[str], faults: list[int]) -> dict:
    """What adds up over chunks, and what is needed where they meet."""
    dated = [t for t in turns if t is not None]  # ascending
    first = [r[:1] for r in roles]
    return {
        "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(TRUNCATED),
        "illegal": sum(a + b not in _LEGAL for a, b in zip(first, first[1:], strict=False)),
        "first": first[0] if first else None, "last": first[-1] if first else None,
        "first_turn": dated[0] if dated else None, "last_turn": dated[-1] if dated else None,
        "turns": sum(a != b for a, b in zip(dated, dated[1:], strict=False)) + bool(dated),
    }


def _gaps(first: int | None, last: int | None, turns: int) -> int:
    return 0 if first is None else min(last - first + 1 - turns, 2**63 - 1)


# --- cost DP and ranks over many chains at once ----------------------------------------------------------


class Chains:
    """Rows of several chains one after the other, each with the costs at its end: what is left to pay there, by state.

    Nodes: chain c has one position more than rows, and four states at each.
    """

    def __init__(self, chains: list[tuple[list[int], list[int]]], ends: np.ndarray, final: bool) -> None:
        self.length = np.array([len(codes) for codes, _ in chains], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.place = self.start + np.arange(len(chains))
        codes = np.array([x for c, _ in chains for x in c], np.int64)
        faults = np.array([x for _, f in chains for x in f], np.int64)
        self.ends, self.final = ends, final
        drop = ((faults == BLANK) | (faults == DUPLICATE))[:, None]
        more = np.where(faults == TRUNCATED, TRUNCATED_KEPT, 0)[:, None]
        self.kept = _KEPT[:, codes].T.reshape(-1, 4)
        self.keep_cost = np.where(drop | (self.kept < 0), _NEVER, KEEP + more)
        self.rerole_cost = np.where(drop, _NEVER, REROLE + more) + np.zeros(4, np.int64)
        self.kept = np.maximum(self.kept, 0)
        self.cost = self._least()

    def _least(self) -> np.ndarray:
        """The least cost from every node to its chain's end."""
        cost = np.full((self.length.sum() + len(self.length), 4), _NEVER)
        cost[self.place + self.length] = self.ends
        longest = np.argsort(-self.length, kind="stable")
        lengths = self.length[longest]
        for back in range(1, int(lengths[0] if len(lengths) else 0) + 1):
            now = longest[: np.searchsorted(-lengths, -back, side="right")]
            row, at = self.start[now] + self.length[now] - back, self.place[now] + self.length[now] - back
            after = cost[at + 1]
            best = np.minimum(after + DELETE, after[:, _NEXT] + self.rerole_cost[row])
            best = np.minimum(best, np.take_along_axis(after, self.kept[row], 1) + self.keep_cost[row])
            u, a = best[:, 2].copy(), best[:, 3].copy()
            best[:, 2], best[:, 3] = np.minimum(u, a + INSERT), np.minimum(a, u + INSERT)
            best[:, :2] = np.minimum(best[:, :2], best[:, 2:3] + INSERT)
            cost[at] = np.minimum(best, _NEVER)
        return cost

    def _arcs(self) -> tuple[np.ndarray, np.ndarray]:
        """For every node and letter: the node that the arc leads to, and whether it is on a cheapest way."""
        n, cost = len(self.cost), self.cost
        node = np.arange(4 * n).reshape(n, 4)
        to = np.repeat(node[:, :, None], 4, 2)
        price = np.full((n, 4, 4), _NEVER)
        inner = np.ones(n, bool)
        inner[self.place + self.length] = False
        at = np.nonzero(inner)[0]
        after = 4 * (at[:, None] + 1)
        to[at, :, 0], price[at, :, 0] = after + np.arange(4), DELETE
        to[:, :, 1], price[:, :, 1] = node[:, :1] + _NEXT, INSERT
        to[at, :, 2], price[at, :, 2] = after + self.kept, self.keep_cost
        to[at, :, 3], price[at, :, 3] = after + _NEXT, self.rerole_cost
        if not self.final:
            price[~inner, :, 1] = _NEVER
        best = (price < _NEVER) & (price + cost.reshape(-1)[to] == cost[:, :, None]) & (cost < _NEVER)[:, :, None]
        return to.reshape(-1, 4), best.reshape(-1, 4)

    def least_paths(self, states: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """For every chain, entered in the given state: letters, the nodes they stand at, and the state it is left in."""
        to, best = self._arcs()
        ends = ~best.any(1)
        nodes = np.arange(len(to))
        letter = np.where(ends, 0, best.argmax(1) + 1)
        pointer = np.where(ends, nodes, to[nodes, np.maximum(letter - 1, 0)])
        rank = letter
        while not ends[pointer].all():  # rank: of the first n letters; pointer: where they lead
            rank = np.unique(rank * (rank.max() + 1) + rank[pointer], return_inverse=True)[1]
            pointer = pointer[pointer]
        key = np.where(best, np.arange(4) * (rank.max(initial=0) + 1) + rank[to], np.iinfo(np.int64).max)
        chosen = key.argmin(1)
        jumps = [np.where(ends, nodes, to[nodes, chosen])]
        steps = [np.where(ends, 0, 1)]
        while not ends[jumps[-1]].all():
            steps.append(steps[-1] + steps[-1][jumps[-1]])
            jumps.append(jumps[-1][jumps[-1]])
        first = 4 * self.place + states
        total = steps[-1][first]
        chain = np.repeat(np.arange(len(first)), total)
        number = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
        at = first[chain]
        for k, jump in enumerate(jumps):
            at = np.where(number >> k & 1, jump[at], at)
        cuts = np.cumsum(total)[:-1]
        return np.split(LETTERS[chosen[at]], cuts), np.split(at, cuts), jumps[-1][first] % 4

    def start_cost(self, states: np.ndarray) -> np.ndarray:
        return self.cost[self.place, states]


def _written(letters: np.ndarray, nodes: np.ndarray, place: int, roles: list[str], texts: list[str]) -> list[str]:
    """The lines of a repaired chain."""
    lines = []
    for letter, node in zip(letters.tobytes().decode(), nodes.tolist(), strict=True):
        if letter == "K":
            row = node // 4 - place
            lines.append(f"{roles[row]}:{texts[row]}")
        elif letter != "D":
            role = "assistant" if node % 4 == 2 else "user"
            lines.append(f"{role}:{texts[node // 4 - place] if letter == 'R' else ''}")
    return lines


_RESULT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
_CHUNK = "chunk bigint, turns array<bigint>, roles array<string>, texts array<string>, faults array<int>, digests array<binary>"
_TYPES = {
    "string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "array<bigint>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string()), "array<binary>": pa.list_(pa.binary()),
}


def _batch(rows: list[dict], fields: str) -> pa.RecordBatch:
    pairs = [f.split() for f in fields.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], _TYPES[t]) for n, t in pairs], [n for n, _ in pairs])


def _repaired(chunks: list[Chunk]) -> list[dict]:
    """Whole conversations."""
    none = np.zeros(len(chunks), np.int64)
    chains = Chains([(initials(c.roles), c.faults) for c in chunks], np.tile(_AT_END, (len(chunks), 1)), True)
    letters, nodes, _ = chains.least_paths(none)
    out = []
    for k, (c, cost) in enumerate(zip(chunks, chains.start_cost(none).tolist(), strict=True)):
        counts = _counts(c.turns, c.roles, c.faults)
        body = "\n".join(_written(letters[k], nodes[k], int(chains.place[k]), c.roles, c.texts))
        out.append({
            **{n: counts[n] for n in ADDED}, "conv": c.conv, "cost": cost, "audit": letters[k].tobytes().decode(),
            "gaps": _gaps(counts["first_turn"], counts["last_turn"], counts["turns"]), "repaired_sha256": hashlib.sha256(body.encode()).hexdigest(),
        })
    return out


def _first_pass(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of the conversations that lie whole in this task, and the chunks of others."""
    fields = f"conv string, {_RESULT}, {_CHUNK}"
    number = TaskContext.get().partitionId() << 32
    whole: list[Chunk] = []
    held = chunk = None
    first, cut, seen, size = True, False, set(), 0

    def chunked(c: Chunk) -> pa.RecordBatch:
        nonlocal number
        number += 1
        row = {k: getattr(c, k) for k in ("conv", "turns", "roles", "texts", "faults", "digests")}
        return _batch([{**row, "chunk": number}], fields)

    for batch in batches:
        for conv, turn, role, text, copies in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if conv != held:
                if chunk is not None:
                    if first or cut:  # the first one of a task may have begun in the task before
                        yield chunked(chunk)
                    else:
                        whole.append(chunk)
                        size += len(chunk.roles) + 1
                        if size >= BATCH_ROWS:
                            yield _batch(_repaired(whole), fields)
                            whole, size = [], 0
                    first = False
                held, chunk, cut, seen = conv, Chunk(conv), False, set()
            for _ in range(copies):
                chunk.add(turn, role, text, seen)
                if chunk.full:
                    yield chunked(chunk)
                    chunk, cut = Chunk(conv), True
    if chunk is not None:
        yield chunked(chunk)
    if whole:
        yield _batch(_repaired(whole), fields)


# --- conversations in chunks -----------------------------------------------------------------------------


def _with_repeats(chunks: DataFrame) -> DataFrame:
    """Chunks with the places of what earlier chunks of the conversation hold already."""
    listed = chunks.select("conv", "chunk", F.posexplode("digests").alias("at", "digest")).where(F.length("digest") > 0)
    first = listed.groupBy("conv", "digest").agg(F.min("chunk").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = listed.join(first, ["conv", "digest"]).where("chunk > first").groupBy("conv", "chunk").agg(F.collect_list("at").alias("again"))
    return chunks.join(again, ["conv", "chunk"], "left").drop("digests")


def _faults(row: dict) -> list[int]:
    faults = row["faults"]
    for at in row["again"] or ():
        faults[at] = DUPLICATE
    return faults


_SUMMARY = (
    "conv string, chunk bigint, costs array<bigint>, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, last string, "
    "first_turn bigint, last_turn bigint, turns bigint"
)


def _summaries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            codes = initials(r["roles"])
            ends = np.where(np.eye(4, dtype=bool), 0, _NEVER)
            faults = _faults(r)
            chains = Chains([(codes, faults)] * 4, ends, False)
            rows.append({
                **_counts(r["turns"], r["roles"], faults), "conv": r["conv"], "chunk": r["chunk"],
                "costs": chains.cost[chains.place].T.ravel().tolist(),  # from state, to state
            })
        yield _batch(rows, _SUMMARY)


_ENDS = "conv string, chunk bigint, ends array<bigint>, final boolean, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"


def _ends(rows: pa.Table) -> pa.Table:
    """Costs at the end of every chunk, and the counts of the conversation in the row of its first one."""
    chunks = sorted(rows.to_pylist(), key=lambda r: r["chunk"])
    out, ends = [], _AT_END
    for r in reversed(chunks):
        out.append({"conv": r["conv"], "chunk": r["chunk"], "ends": ends.tolist(), "final": not out})
        ends = np.minimum((np.array(r["costs"]).reshape(4, 4) + ends).min(1), _NEVER)
    totals = {k: sum(r[k] for r in chunks) for k in ADDED}
    edges = [(r["first"], r["last"]) for r in chunks if r["first"] is not None]
    totals["illegal"] += sum(a[1] + b[0] not in _LEGAL for a, b in zip(edges, edges[1:], strict=False))
    spans = [(r["first_turn"], r["last_turn"]) for r in chunks if r["first_turn"] is not None]
    turns = sum(r["turns"] for r in chunks) - sum(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    totals["gaps"] = _gaps(spans[0][0], spans[-1][1], turns) if spans else 0
    out[-1] |= {**totals, "cost": int(ends[0])}
    return pa.Table.from_batches([_batch(out, _ENDS)])


def _exits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state that a chunk's least way leaves it in, for each state of entry."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            chains = Chains([(initials(r["roles"]), _faults(r))] * 4, np.tile(r["ends"], (4, 1)), r["final"])
            rows.append({"conv": r["conv"], "chunk": r["chunk"], "exits": chains.least_paths(np.arange(4))[2].tolist()})
        yield _batch(rows, "conv string, chunk bigint, exits array<bigint>")


_ENTRIES = "conv string, chunk bigint, entry bigint"


def _entries(rows: pa.Table) -> pa.Table:
    """The state that the least way enters every chunk in."""
    out, state = [], 0
    for r in sorted(rows.to_pylist(), key=lambda r: r["chunk"]):
        out.append({"conv": r["conv"], "chunk": r["chunk"], "entry": state})
        state = r["exits"][state]
    return pa.Table.from_batches([_batch(out, _ENTRIES)])


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            chains = Chains([(initials(r["roles"]), _faults(r))], np.array([r["ends"]]), r["final"])
            letters, nodes, _ = chains.least_paths(np.array([r["entry"]]))
            lines = _written(letters[0], nodes[0], 0, r["roles"], r["texts"])
            row = {"conv": r["conv"], "chunk": r["chunk"], "audit": letters[0].tobytes().decode(), "body": "\n".join(lines) if lines else None}
            yield _batch([row], "conv string, chunk bigint, audit string, body string")


def _joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and hash of each conversation, from its pieces in order."""
    fields = "conv string, audit string, repaired_sha256 string"
    held, audit, digest, begun = None, [], hashlib.sha256(), False
    for batch in batches:
        done = []
        for conv, piece, body in zip(*[batch.column(n).to_pylist() for n in ("conv", "audit", "body")], strict=True):
            if conv != held:
                if held is not None:
                    done.append({"conv": held, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()})
                held, audit, digest, begun = conv, [], hashlib.sha256(), False
            audit.append(piece)
            if body is not None:
                digest.update(("\n" + body if begun else body).encode())
                begun = True
        if done:
            yield _batch(done, fields)
    if held is not None:
        yield _batch([{"conv": held, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}], fields)


def repair(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation of damaged rows.

    rows: conv_id, turn, role, text. The damage is part of the task: it plants the faults that are then mended.
    """
    prefix = lambda c, n: F.substring(c, 1, n)
    order = [F.asc("conv"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]
    keys: list[Column] = [F.asc("conv"), F.asc_nulls_first("turn"), prefix("role", 64).asc(), prefix("text", 200).asc()]
    damaged = _damaged(rows).select("conv", "turn", "role", "text", "copies")
    lying = damaged.repartitionByRange(*keys).sortWithinPartitions(*order)
    found = stored(lying.mapInArrow(_first_pass, f"conv string, {_RESULT}, {_CHUNK}"), "conversations")
    names = lambda fields: ["conv", *[f.split()[0] for f in fields.split(", ")]]
    whole = found.where("chunk IS NULL").select(*names(_RESULT))

    key, solved = ["conv", "chunk"], ["conv", "chunk", "roles", "faults", "again"]
    chunks = stored(_with_repeats(found.where("chunk IS NOT NULL").select(*names(_CHUNK))), "chunks")
    summaries = chunks.select(*solved, "turns").mapInArrow(_summaries, _SUMMARY)
    ends = stored(summaries.groupBy("conv").applyInArrow(_ends, _ENDS), "ends")
    after = ends.select(*key, "ends", "final")
    exits = chunks.select(*solved).join(after, key).mapInArrow(_exits, "conv string, chunk bigint, exits array<bigint>")
    entries = exits.groupBy("conv").applyInArrow(_entries, _ENTRIES)
    placed = chunks.select(*solved, "texts").join(after, key).join(entries, key)
    pieces = placed.mapInArrow(_pieces, "conv string, chunk bigint, audit string, body string")
    joined = pieces.repartition("conv").sortWithinPartitions(*key).mapInArrow(_joined, "conv string, audit string, repaired_sha256 string")
    cut = ends.where("cost IS NOT NULL").join(joined, "conv").select(*names(_RESULT))

    named = F.when(F.col("conv") != "", F.col("conv")).cast("bigint").alias("conv_id")
    return whole.unionByName(cut).select(named, *names(_RESULT)[1:])


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(table(spark, sf_dir, "conversations"))
