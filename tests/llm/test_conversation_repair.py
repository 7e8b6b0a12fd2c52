import hashlib
import itertools
import random
import re
import zlib

from fascicle.llm import conversation_repair as cr
from fascicle.session import load

GOOD = re.compile(r"(s?(ua)+)?")
START = re.compile(r"s?(ua)*u?")


def brute(rows):
    """Cheapest (cost, audit, repaired lines) of (role, text, fault) rows, by trying every edit with up to two inserts a gap."""
    best = None

    def go(k, cost, audit, out):
        nonlocal best
        if best is not None and cost > best[0] or not START.fullmatch("".join(r[:1] for r, _ in out)):
            return
        for gap in range(3):
            for kinds in itertools.product(("user", "assistant"), repeat=gap):
                step(k, cost + 5 * gap, audit + "I" * gap, out + [(r, "") for r in kinds])

    def step(k, cost, audit, out):
        nonlocal best
        if k == len(rows):
            if GOOD.fullmatch("".join(r[:1] for r, _ in out)) and (best is None or (cost, audit) < best[:2]):
                best = cost, audit, out
            return
        role, text, fault = rows[k]
        go(k + 1, cost + 2, audit + "D", out)
        if fault not in "bd":
            extra = 5 if fault == "t" else 0
            if role[:1] in ("s", "u", "a"):
                go(k + 1, cost + extra, audit + "K", out + [(role, text)])
            for given in ("user", "assistant"):
                go(k + 1, cost + 1 + extra, audit + "R", out + [(given, text)])

    go(0, 0, "", [])
    return best


def plain(conversation):
    """The query's row of one conversation, from (conv_id, turn, role, text) rows."""
    rows = []
    for conv, turn, role, text in conversation:
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if h == 1:
            text = ""
        if h == 2:
            text = re.sub("[.!?]", "", text)
        rows += [] if h == 0 else [(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    marked, seen = [], set()
    for _, role, text in rows:
        last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        marked.append((role, text, "b" if not last else "d" if (role, text) in seen else "t" if last not in ".!?" else "-"))
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    faults = [f for *_, f in marked]
    initials = "".join((r[:1] or "-") if r[:1] in ("s", "u", "a") else "-" for r, *_ in marked)
    cost, audit, out = brute(marked)
    illegal = sum(initials[k:k + 2] not in ("su", "ua", "au") for k in range(len(initials) - 1))
    return (conversation[0][0], gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


def test_search_against_all_edits():
    random.seed(13)
    for _ in range(400):
        rows = [(random.choice(["system", "user", "assistant", "user", "assistant", "tool", " "]), str(k), random.choice("---tbd")) for k in range(random.randint(1, 6))]
        initials = "".join(r[0] if r[0] in "sua" else "-" for r, *_ in rows)
        faults = "".join("x" if f in "bd" else f for *_, f in rows)
        cost, audit, out = brute(rows)
        for piece in (1, 2, 3, 10):
            cuts = list(range(0, len(rows), piece))
            solved = [cr.solve_piece(initials[c:c + piece], faults[c:c + piece], c == 0, c == cuts[-1]) for c in cuts]
            total, picks = cr.chosen_states([(costs, ranks) for costs, ranks, _ in solved])
            found = "".join(audits[p] for (_, _, audits), p in zip(solved, picks))
            assert (total, found) == (cost, audit), (rows, piece)
        assert list(cr.replay(iter(audit), iter([(r, t) for r, t, _ in rows]))) == out


def test_long_conversation_in_pieces():
    random.seed(3)
    initials = "".join(random.choice("sua-") for _ in range(3000))
    faults = "".join(random.choice("---tx") for _ in range(3000))
    whole = cr.solve_piece(initials, faults, True, True)
    cuts = range(0, 3000, 700)
    solved = [cr.solve_piece(initials[c:c + 700], faults[c:c + 700], c == 0, c == 2800) for c in cuts]
    total, picks = cr.chosen_states([(c, r) for c, r, _ in solved])
    assert total == whole[0][0] and "".join(a[p] for (_, _, a), p in zip(solved, picks)) == whole[2][0]


def test_query_on_odd_rows(spark):
    random.seed(7)
    texts = ["a.", "b!", "c", "", " \t", None, "What?  ", "x" * 70_000 + ".", "é。", "hm."]
    roles = ["user", "assistant", "system", "user", "assistant", None, "tool", ""]
    rows = []
    for conv in [*range(60), None]:
        for turn in random.sample(range(-2, 9), random.randint(1, 6)):
            rows.append((conv, random.choice([turn, turn, turn, None]), random.choice(roles), random.choice(texts)))
    rows += random.sample(rows, 25) + [(1, 3, "user", "hm."), (1, 3, "user", "hm.")]
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    groups = {c: g for c, g in groups.items() if len(g) <= 7}
    rows = [r for g in groups.values() for r in g]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, audit string, pos long")
    found = cr.repair_damaged(df).collect()
    assert sorted(map(tuple, found), key=repr) == sorted((plain(g) for g in groups.values()), key=repr)


def test_repaired_rows(spark):
    df = spark.createDataFrame([(1, 0, "assistant", "a."), (1, 1, "user", "b."), (1, 2, "user", "c."), (1, 3, "assistant", "d."), (2, 0, "x", "")], "conv_id long, turn long, role string, text string")
    summary, audits = cr.repairs(df, piece=2)
    rows = cr.repaired_rows(df, audits).collect()
    assert sorted(map(tuple, rows)) == [(1, 1, "user", "a."), (1, 2, "assistant", "b."), (1, 3, "user", "c."), (1, 4, "assistant", "d.")]
    assert sorted((r.conv_id, r.cost) for r in summary.collect()) == [(1, 2), (2, 2)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cr.repair_damaged(df).collect() == []


def test_query_on_table(spark, small):
    groups = {}
    for r in load(spark, small, "conversations").collect():
        groups.setdefault(r.conv_id, []).append(tuple(r))
    found = cr.repair_damaged(load(spark, small, "conversations")).collect()
    wanted = {c: g for c, g in groups.items() if len(g) <= 6}
    assert sorted(tuple(r) for r in found if r.conv_id in wanted) == sorted(plain(g) for g in wanted.values()) and len(found) == len(groups)
