"""Repair of conversations at least cost: bidirectional Dijkstra over the edit lattice.

A conversation is repaired when the initials of its roles read ``(s?(ua)+)?``. A node of the lattice
is (rows read, state of that pattern). Edges keep a row, give it another role, delete it or insert an
empty row. One heap grows from the start, one from the goals; they stop when no cheaper and no equally
cheap crossing is left. Nodes that lead to a crossing are marked backwards, and the audit is read off
from the start: of the edges that stay on a cheapest path always the one with the least initial. Two
cheapest ways to a node are never prefixes of each other, so this is the least of all concatenated
audits.

A conversation of any length is cut into pieces of ``PIECE`` rows. Tasks solve a piece for each state
it may start and end in; a piece passes on 16 costs and the order of its audits, not the audits. Per
conversation the costs are summed from the end, and states are then chosen from the start. Inserts
before a row belong to its piece, those after the last row are a fixed tail, so pieces never tie by
a prefix. Rows are numbered over range partitions, without their texts. Only the digest of the
repaired text, one value over the whole conversation, reads a conversation in one stream, holding one
letter per row.

Rows are ordered by turn (NULL first), then role and digest of the text. A NULL conv_id is a
conversation of its own, extra columns are not read, an empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..operators.windows import running_totals
from .common import prepare, stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
PIECE = 2048
SPACE = " \t\n\x0b\x0c\r"
# States of the pattern: nothing yet, after s, after u, after a; what a role's initial leads to.
STEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
# The one role that may be given or inserted in a state, and the state after it.
NEXT = (("u", 2), ("u", 2), ("a", 3), ("u", 2))
ROLE = {"u": "user", "a": "assistant"}
# Cost and audit of the inserts that complete the pattern after the last row.
TAIL = (0, 2 * INSERT, INSERT, 0)
TAIL_AUDIT = ("", "II", "I", "")
LEGAL = ("su", "ua", "au")
NONE = 1 << 40


def edges_from(node: int, initials: str, faults: str) -> list[tuple[str, int, int]]:
    """(letter, cost, node) by letter; node is 4 x rows read + state. No insert after the last row."""
    p, q = divmod(node, 4)
    if p == len(initials):
        return []
    given = 4 * (p + 1) + NEXT[q][1]
    out = [("D", DELETE, 4 * (p + 1) + q), ("I", INSERT, 4 * p + NEXT[q][1])]
    if faults[p] != "x":
        extra = TRUNCATED if faults[p] == "t" else 0
        if initials[p] in STEP[q]:
            out.append(("K", KEEP + extra, 4 * (p + 1) + STEP[q][initials[p]]))
        out.append(("R", REROLE + extra, given))
    return out


def edges_to(node: int, initials: str, faults: str) -> list[tuple[int, int]]:
    """(cost, node) of the edges that end in a node."""
    p, q = divmod(node, 4)
    out = []
    if p < len(initials):
        out += [(INSERT, 4 * p + r) for r in range(4) if NEXT[r][1] == q]
    if p:
        out.append((DELETE, node - 4))
        if faults[p - 1] != "x":
            extra = TRUNCATED if faults[p - 1] == "t" else 0
            out += [(KEEP + extra, 4 * (p - 1) + r) for r in range(4) if STEP[r].get(initials[p - 1]) == q]
            out += [(REROLE + extra, 4 * (p - 1) + r) for r in range(4) if NEXT[r][1] == q]
    return out


def solve(initials: str, faults: str, state: int, goals: dict[int, int]) -> tuple[int, str, int] | None:
    """Least cost (with the goal's), least audit and last state, from ``state`` over all rows to one of the goals."""
    size = 4 * len(initials)
    start, ends = state, {size + q: c for q, c in goals.items()}
    ahead, back = {start: 0}, dict(ends)
    known, done = set(), set()
    front, rear = [(0, start)], sorted((c, v) for v, c in ends.items())
    best = ahead[start] + back[start] if start in back else NONE
    while front and rear and front[0][0] + rear[0][0] <= best:
        if front[0][0] <= rear[0][0]:
            cost, u = heappop(front)
            if u in known:
                continue
            known.add(u)
            for _, w, v in edges_from(u, initials, faults):
                if cost + w < ahead.get(v, NONE):
                    ahead[v] = cost + w
                    heappush(front, (cost + w, v))
                    best = min(best, cost + w + back.get(v, NONE))
        else:
            cost, v = heappop(rear)
            if v in done:
                continue
            done.add(v)
            for w, u in edges_to(v, initials, faults):
                if cost + w < back.get(u, NONE):
                    back[u] = cost + w
                    heappush(rear, (cost + w, u))
                    best = min(best, cost + w + ahead.get(u, NONE))
    if best >= NONE:
        return None
    # crossings of least cost, and the settled nodes that lead to one without loss
    crossing = [u for u in known if (u in done or u in ends) and ahead[u] + back[u] == best]
    crossing += [u for u in known if any(v in done and ahead[u] + w + back[v] == best for _, w, v in edges_from(u, initials, faults))]
    good = set()
    while crossing:
        v = crossing.pop()
        if v not in good:
            good.add(v)
            crossing += [u for w, u in edges_to(v, initials, faults) if u in known and ahead[u] + w == ahead[v]]
    node, cost, audit = start, 0, []
    while not (node in ends and cost + ends[node] == best):
        for letter, w, v in edges_from(node, initials, faults):
            if v in done and cost + w + back[v] == best or v in good and ahead[v] == cost + w:
                node, cost = v, cost + w
                audit.append(letter)
                break
    return best, "".join(audit), node % 4


def solve_piece(initials: str, faults: str, first: bool, last: bool) -> tuple[list[int], list[int], list[str]]:
    """Cost, rank and audit for every (start, end) state; 4 x start + end. The last piece has one end, 0."""
    costs, audits = [NONE] * 16, [""] * 16
    for q in (0,) if first else range(4):
        if last:
            found = solve(initials, faults, q, dict(enumerate(TAIL)))
            costs[4 * q], audits[4 * q] = found[0], found[1] + TAIL_AUDIT[found[2]]
        else:
            for e in range(4):
                found = solve(initials, faults, q, {e: 0})
                if found:
                    costs[4 * q + e], audits[4 * q + e] = found[0], found[1]
    ranks = [0] * 16
    for q in range(4):
        for r, e in enumerate(sorted(range(4), key=lambda e: audits[4 * q + e])):
            ranks[4 * q + e] = r
    return costs, ranks, audits


def chosen_states(pieces: list[tuple[list[int], list[int]]]) -> tuple[int, list[int]]:
    """Least cost of a conversation and the index each of its pieces takes: cheapest, then least audit."""
    after = [[NONE] * 4 for _ in range(len(pieces) + 1)]
    after[-1][0] = 0
    for k in range(len(pieces) - 1, -1, -1):
        costs = pieces[k][0]
        after[k] = [min(costs[4 * q + e] + after[k + 1][e] for e in range(4)) for q in range(4)]
    state, picks = 0, []
    for k, (costs, ranks) in enumerate(pieces):
        ends = [e for e in range(4) if costs[4 * state + e] + after[k + 1][e] == after[k][state]]
        end = min(ends, key=lambda e: ranks[4 * state + e])
        picks.append(4 * state + end)
        state = end
    return after[0][0], picks


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the made-up faults; NULL roles and texts are one space."""
    def said(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), fault.alias("f")).where("f != 0")
    text = F.when(F.col("f") == 1, "").when(F.col("f") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("f") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.sequence(F.lit(1), F.when(F.col("f") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def _said() -> Column:
    return F.struct("role", "sha")


def faulty_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, pos, initial, fault) of (conv_id, turn, role, text): pos counts from 1, fault is
    b(lank), d(uplicate), t(runcated) or -. No text is shuffled."""
    end = F.right(F.rtrim(F.col("text"), F.lit(SPACE)), F.lit(1))
    initial = F.when(F.substr("role", F.lit(1), F.lit(1)).isin("s", "u", "a"), F.substr("role", F.lit(1), F.lit(1))).otherwise("-")
    light = rows.select("conv_id", "turn", "role", F.unhex(F.sha2("text", 256)).alias("sha"), initial.alias("initial"),
                        (end == "").alias("blank"), (~end.isin(".", "!", "?")).alias("cut"))
    numbered = stored(running_totals(light, order=[F.col("turn"), F.col("role"), F.col("sha")], sums={"pos": F.lit(1).cast("long")}, keys=["conv_id"]), "repair-rows")
    first = numbered.groupBy(F.struct("conv_id", "role", "sha").alias("key")).agg(F.min("pos").alias("first"), F.count("*").alias("c")).where("c > 1").select("key", "first")
    marked = numbered.withColumn("key", F.struct("conv_id", "role", "sha")).join(first, "key", "left")
    fault = F.when(F.col("blank"), "b").when(F.col("pos") > F.col("first"), "d").when(F.col("cut"), "t").otherwise("-")
    return marked.select("conv_id", "turn", "pos", "initial", fault.alias("fault"))


SOLVED = "struct<costs: array<long>, ranks: array<int>, audits: array<string>, illegal: long>"
CHOSEN = "struct<cost: long, picks: array<int>, illegal: long>"


def _solved(initials: pd.Series, faults: pd.Series, first: pd.Series, last: pd.Series) -> pd.DataFrame:
    out = []
    for i, f, a, z in zip(initials, faults, first, last):
        f = f.replace("b", "x").replace("d", "x")
        out.append((*solve_piece(i, f, a, z), sum(i[k:k + 2] not in LEGAL for k in range(len(i) - 1))))
    return pd.DataFrame(out, columns=["costs", "ranks", "audits", "illegal"])


def _chosen(pieces: pd.Series) -> pd.DataFrame:
    out = []
    for row in pieces:
        cost, picks = chosen_states([(list(p["costs"]), list(p["ranks"])) for p in row])
        seams = sum(a["final"] + b["initial"] not in LEGAL for a, b in zip(row, row[1:]))
        out.append((cost, picks, sum(p["illegal"] for p in row) + seams))
    return pd.DataFrame(out, columns=["cost", "picks", "illegal"])


def repairs(rows: DataFrame, piece: int = PIECE) -> tuple[DataFrame, DataFrame]:
    """For rows (conv_id, turn, role, text): one row per conversation with its faults and cost, and
    (conv_id, piece, audit), the cheapest edits piece by piece."""
    prepare(rows.sparkSession)
    faults = stored(faulty_rows(rows), "repair-faults")
    turns = faults.where("turn IS NOT NULL").groupBy("conv_id", "turn").agg(F.lit(1)).groupBy(F.struct("conv_id").alias("key")).agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))
    count = {"b": "blank", "d": "duplicate", "t": "truncated"}
    totals = faults.groupBy(F.struct("conv_id").alias("key")).agg(F.max("pos").alias("size"), *[F.count_if(F.col("fault") == k).alias(n) for k, n in count.items()])
    totals = totals.join(turns, "key", "left").withColumn("gaps", F.coalesce("gaps", F.lit(0).cast("long")))

    def letters(name: str) -> Column:
        return F.array_join(F.transform(F.array_sort("rows"), lambda r: r[name]), "")

    cut = faults.groupBy(F.struct("conv_id").alias("key"), F.floor((F.col("pos") - 1) / piece).alias("piece")).agg(
        F.collect_list(F.struct("pos", "initial", "fault")).alias("rows"))  # ``piece`` rows at most
    cut = cut.select("key", "piece", letters("initial").alias("initials"), letters("fault").alias("faults"))
    last = F.col("piece") == F.floor((F.col("size") - 1) / piece)
    pieces = cut.join(totals.select("key", "size"), "key").select("key", "piece", "initials", pandas_udf(_solved, SOLVED)("initials", "faults", F.col("piece") == 0, last).alias("s"))
    pieces = stored(pieces.select("key", "piece", F.left("initials", F.lit(1)).alias("initial"), F.right("initials", F.lit(1)).alias("final"), "s.*"), "repair-pieces")
    costs = pieces.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("piece", "costs", "ranks", "illegal", "initial", "final"))).alias("p"))
    chosen = stored(costs.select("key", pandas_udf(_chosen, CHOSEN)("p").alias("c")).select("key", "c.*"), "repair-chosen")
    picked = chosen.select("key", F.posexplode("picks").alias("piece", "pick"))
    audits = pieces.select("key", "piece", "audits").join(picked, ["key", "piece"]).select("key.conv_id", "piece", F.get("audits", F.col("pick")).alias("audit"))
    summary = totals.join(chosen.drop("picks"), "key").select("key.conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return summary, audits


def replay(audit: Iterator[str], rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """Repaired (role, text) rows."""
    state, rows = 0, iter(rows)
    for letter in audit:
        if letter == "I":
            initial, state = NEXT[state]
            yield ROLE[initial], ""
            continue
        role, text = next(rows)
        if letter == "K":
            state = STEP[state][role[0]]
            yield role, text
        elif letter == "R":
            initial, state = NEXT[state]
            yield ROLE[initial], text


def _streamed(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Audits and rows of each conversation together and in order: audits first."""
    plain = rows.select("conv_id", F.lit(1).alias("tag"), "turn", "role", F.unhex(F.sha2("text", 256)).alias("sha"), F.lit(0).cast("long").alias("piece"), "text")
    edits = audits.select("conv_id", F.lit(0).alias("tag"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), F.lit("").alias("role"), F.lit(None).cast("binary").alias("sha"), "piece", F.col("audit").alias("text"))
    both = plain.unionByName(edits).repartition("conv_id").sortWithinPartitions("conv_id", "tag", "piece", "turn", "role", "sha")
    return both.select("conv_id", "tag", "role", "text")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[tuple[str, str]]]]:
    """(conv_id, its repaired rows) from a sorted stream; the rows must be read before the next one."""
    stream = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    row = next(stream, None)
    while row is not None:
        conv, audit = row[0], []
        while row is not None and row[0] == conv and row[1] == 0:
            audit.append(row[3])
            row = next(stream, None)

        def mine():
            nonlocal row
            while row is not None and row[0] == conv:
                now = row[2:]
                row = next(stream, None)
                yield now

        left = mine()
        yield conv, replay((letter for part in audit for letter in part), left)
        for _ in left:
            pass


def repaired_rows(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, position, role, text) after the edits, positions from 1."""
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}["conv_id"]

    def emit(batches):
        schema = pa.schema([("conv_id", arrow), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string())])
        out, held = [], 0
        for conv, lines in _conversations(batches):
            for k, (role, text) in enumerate(lines, 1):
                out.append({"conv_id": conv, "position": k, "role": role, "text": text})
                held += len(text)
                if len(out) >= 1000 or held > 1 << 24:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, held = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    arrow = _arrow(rows)
    return _streamed(rows, audits).mapInArrow(emit, f"conv_id {kind}, position long, role string, text string")


def _arrow(rows: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema["conv_id"].dataType)


def repaired_digests(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256): the whole audit and the digest of the repaired ``role:text`` lines."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    arrow = _arrow(rows)

    def emit(batches):
        schema = pa.schema([("conv_id", arrow), ("repaired_sha256", pa.string())])
        out = []
        for conv, lines in _conversations(batches):
            digest = hashlib.sha256()
            for k, (role, text) in enumerate(lines):
                digest.update(f"{chr(10) if k else ''}{role}:{text}".encode())
            out.append({"conv_id": conv, "repaired_sha256": digest.hexdigest()})
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    digests = _streamed(rows, audits).mapInArrow(emit, f"conv_id {kind}, repaired_sha256 string")
    whole = audits.groupBy(F.struct("conv_id").alias("key")).agg(F.array_sort(F.collect_list(F.struct("piece", "audit"))).alias("a"))
    whole = whole.select("key", F.array_join(F.transform("a", lambda x: x["audit"]), "").alias("audit"))
    return whole.join(digests.select(F.struct("conv_id").alias("key"), "repaired_sha256"), "key").select("key.conv_id", "audit", "repaired_sha256")


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """One row per conversation of the undamaged table, as the query asks; without rows after the
    damage it has zeros, an empty audit and the digest of an empty text."""
    rows = damaged(conversations)
    summary, audits = repairs(rows)
    audits = stored(audits, "repair-audits")
    digests = repaired_digests(rows, audits)
    key = F.struct("conv_id").alias("key")
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    found = summary.select(key, *names).join(digests.select(key, "audit", "repaired_sha256"), "key")
    every = conversations.select(key).distinct().join(found, "key", "left")
    return every.select("key.conv_id", *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in names], F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
