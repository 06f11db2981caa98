"""Repairs against a plain search over edits, a full chart over all spans, and plain bookkeeping of whole conversations."""
import hashlib
import itertools
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from tickloom.llm import conversation_repair as c
from tickloom.llm.queries import damaged_turns

SOUND = re.compile(r"(s?(ua)+)?")
SCHEMA = "turn bigint, conv_id bigint, role string, text string, audit string, cell int, `a.turn` int"


def searched(letters):
    """Least (cost, audit) over every way to edit, insertions of up to three turns in each gap."""
    best = None
    choices = [[("D", "", 3)] if x == "x" else [("D", "", 3), ("K", x.lower(), int(x.isupper())), ("R", "u", 2 + x.isupper()), ("R", "a", 2 + x.isupper())] for x in letters]
    gaps = ["".join(g) for n in range(4) for g in itertools.product("ua", repeat=n)]
    for edits in itertools.product(*choices):
        for filled in itertools.product(gaps, repeat=len(letters) + 1):
            if sum(map(len, filled)) > 4:
                continue
            roles = filled[0] + "".join(e[1] + f for e, f in zip(edits, filled[1:], strict=True))
            if SOUND.fullmatch(roles):
                audit = "I" * len(filled[0]) + "".join(e[0] + "I" * len(f) for e, f in zip(edits, filled[1:], strict=True))
                cost = sum(e[2] for e in edits) + 2 * sum(map(len, filled))
                best = min(best, (cost, audit)) if best else (cost, audit)
    return best


def charted(letters):
    """All spans by all splits."""
    n = len(letters)
    chart = {(i, i + 1): [c._leaf(x)] for i, x in enumerate(letters)}
    for size in range(2, n + 1):
        for i in range(n - size + 1):
            chart[i, i + size] = [c._product(chart[i, k][0], chart[k, i + size][0]) for k in range(i + 1, i + size)]
            assert all(cell == chart[i, i + size][0] for cell in chart[i, i + size])
    return chart[0, n][0]


def plain(letters):
    """Shortest way through the states, one row after the other."""
    best = {0: (0, "")}

    def insert(best):
        for _ in range(3):
            for (p, x), q in c.STEPS.items():
                if x != "s" and p in best:
                    best[q] = min(best.get(q, (1 << 40, "")), (best[p][0] + 2, best[p][1] + "I"))
        return best

    insert(best)
    for x in letters:
        after = {}
        for p, (cost, audit) in best.items():
            ways = [(p, 3, "D")]
            if x != "x":
                ways += [(q, int(x.isupper()), "K") for (s, y), q in c.STEPS.items() if s == p and y == x.lower()]
                ways += [(q, 2 + x.isupper(), "R") for (s, y), q in c.STEPS.items() if s == p and y != "s"]
            for q, more, edit in ways:
                after[q] = min(after.get(q, (1 << 40, "")), (cost + more, audit + edit))
        best = insert(after)
    return min(best[q] for q in (0, 3) if q in best)


def test_every_short_conversation():
    for n in range(3):
        for letters in itertools.product("suaoxSUAO", repeat=n):
            assert c.cheapest(c.parsed("".join(letters))) == searched(letters) == plain(letters)


@settings(max_examples=300, deadline=None)
@given(st.text("suaoxSUAO", max_size=60))
def test_long_conversations(letters):
    assert c.cheapest(c.parsed(letters)) == plain(letters)


@settings(max_examples=60, deadline=None)
@given(st.text("suaoxSUAO", min_size=1, max_size=10), st.integers(0, 10))
def test_any_division_gives_the_same_cell(letters, at):
    whole = c.parsed(letters)
    assert charted(letters) == whole
    assert c._product(c.parsed(letters[:at]), c.parsed(letters[at:])) == whole


def expected(rows):
    """Plain bookkeeping of one conversation's (turn, role, text)."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    seen, letters, faults = set(), [], [0, 0, 0]
    for _, role, text in rows:
        words = text.strip(" \t\n\x0b\x0c\r")
        initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
        if not words:
            faults[0] += 1
            letters.append("x")
        elif (role, text) in seen:
            faults[1] += 1
            letters.append("x")
        elif words[-1] not in ".!?":
            faults[2] += 1
            letters.append(initial.upper())
        else:
            letters.append(initial)
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    cost, audit = plain(letters)
    lines, left, state = [], iter(rows), 0
    for edit in audit:
        _, role, text = (None, None, "") if edit == "I" else next(left)
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if state == 2 else "user"
        state = c.STEPS[state, role[0]]
        lines.append(f"{role}:{text}")
    return (gaps, *faults, illegal, cost, audit), lines


def held(spark, rows):
    """Both results of the operator against plain bookkeeping."""
    whole = {}
    for conv, turn, role, text in rows:
        whole.setdefault(conv, []).append((turn, role, text))
    table = spark.createDataFrame([(t, k, r, x, "extra", 7, 8) for k, t, r, x in rows], SCHEMA).repartition(3)
    planned = c.plans(table)
    found = {r.conv_id: r for r in c.digests(table, planned).collect()}
    turns = {}
    for r in c.repaired(table, planned).orderBy("place").collect():
        turns.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert set(found) == set(whole)
    for conv, own in whole.items():
        want, lines = expected(own)
        got = tuple(found[conv])[1:]
        assert got[:-1] == want
        assert got[-1] == hashlib.sha256("\n".join(lines).encode()).hexdigest()
        assert turns.get(conv, []) == lines


def test_odd_rows(spark):
    long_text = "word and " * 40_000
    held(spark, [
        (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (2, 0, "assistant", "Yes."), (2, 3, "assistant", "cut off"),
        (3, None, "user", None), (3, None, None, "x."), (3, 4, "user", "a."), (3, 9, "assistant", "b!"),
        (None, 1, "system", "s."), (None, 2, "user", long_text), (None, None, None, None), (4, 5, "", ""),
        (5, 0, "user", "same."), (5, 0, "user", "same."), (5, 0, "user", "same."), (5, 1, "assistant", "é́ \U0001f600?"),
        (5, 2, "user", "same."), (5, 2, "assistant", "same."), (5, 2, "User", "same."), (5, 2, "tool", "t."),
        (6, 1, "user", "a.\x1c"), (6, 2, "assistant", "b. \t\n"), (7, -3, "system", "x."), (7, 2, "system", "y."), (7, 2, "system", "y."),
    ])


def test_one_conversation_in_many_tasks(spark):
    rows = [(1, i // 2, ("user", "assistant", "system", "tool")[(i * i) % 4], f"text {i % 37}" + ".?x "[i % 4]) for i in range(900)]
    rows += [(1, 70, "user", "again.")] * 300 + [(k, 0, "user", "only.") for k in range(2, 9)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        table = spark.createDataFrame([(t, k, r, x, "", 0, 0) for k, t, r, x in rows], SCHEMA)
        assert c.spans(c.judged(table)).filter("conv_id = 1").count() > 1
        held(spark, rows)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert c.plans(none).count() == 0 and c.digests(none, c.plans(none)).count() == 0 and c.repaired(none, c.plans(none)).count() == 0


def test_conversations_without_rows(spark):
    table = spark.createDataFrame([(0, 1, "user", "Hi.", "", 0, 0)], SCHEMA)
    ids = spark.createDataFrame([(1,), (2,), (None,)], "conv_id bigint")
    found = {r.conv_id: r for r in c.for_all(ids, c.digests(table, c.plans(table))).collect()}
    assert set(found) == {1, 2, None} and found[1].audit == "KI" and found[1].cost == 2
    for conv in (2, None):
        assert tuple(found[conv])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_damage(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    odd = spark.createDataFrame([(None, 1, None, None, "", 0, 0), (3, None, "user", None, "", 0, 0)], SCHEMA).select("conv_id", "turn", "role", "text")
    want = []
    for conv, turn, role, text in (tuple(r) for r in table.unionByName(odd).select("conv_id", "turn", "role", "text").collect()):
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        fate = zlib.crc32(key.encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fate, text)
        want += [(conv, turn, "user" if fate == 4 else role, text)] * {0: 0, 3: 2}.get(fate, 1)
    found = [tuple(r) for r in damaged_turns(table.unionByName(odd)).collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr)
