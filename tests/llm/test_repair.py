import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import conversation_repair as R
from tidemark.llm.queries import op11_conversation_repair

from .conftest import SF

LABELS = [("s", "fine"), ("u", "fine"), ("a", "fine"), ("", "fine"), ("u", "truncated"), ("a", "truncated"),
          ("s", "truncated"), ("u", "gone"), ("", "gone")]
NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def decode(rows):
    s, out, peak = R.Survivors(), b"", 0
    for r in rows:
        out += s.take(*r)
        peak = max(peak, s.unresolved())
    cost, rest = s.finish()
    return (cost, (out + rest).decode()), peak


def by_strings(rows):
    """Dynamic programming over whole edit strings; inserts are tried everywhere."""
    def inserts(cur):
        cur = dict(cur)
        for _ in range(4):
            for s, (c, t) in list(cur.items()):
                for r in "ua":
                    n = NEXT[s].get(r)
                    if n is not None and (n not in cur or (c + 5, t + "I") < cur[n]):
                        cur[n] = (c + 5, t + "I")
        return cur

    cur = {0: (0, "")}
    for ini, fault in rows:
        new = {}
        for s, (c, t) in inserts(cur).items():
            ways = [(s, (c + 2, t + "D"))]
            if fault != "gone":
                x = 5 if fault == "truncated" else 0
                ways += [(NEXT[s][ini], (c + x, t + "K"))] if ini in NEXT[s] else []
                ways += [(NEXT[s][r], (c + 1 + x, t + "R")) for r in "ua" if r in NEXT[s]]
            for n, v in ways:
                new[n] = min(v, new.get(n, v))
        cur = new
    return min(v for s, v in inserts(cur).items() if s in (0, 3))


def by_trying_all(rows):
    """Every edit string with at most two inserts at a place, judged by the pattern itself."""
    best = (10**9, "")

    def go(i, cost, audit, roles):
        nonlocal best
        if cost > best[0]:
            return
        for k in range(3):
            for extra in itertools.product("ua", repeat=k):
                c, a, r = cost + 5 * k, audit + "I" * k, roles + "".join(extra)
                if i == len(rows):
                    if re.fullmatch(r"(s?(ua)+)?", r):
                        best = min(best, (c, a))
                    continue
                ini, fault = rows[i]
                go(i + 1, c + 2, a + "D", r)
                if fault != "gone":
                    x = 5 if fault == "truncated" else 0
                    go(i + 1, c + x, a + "K", r + (ini or "?"))
                    for t in "ua":
                        go(i + 1, c + 1 + x, a + "R", r + t)

    go(0, 0, "", "")
    return best


def test_cheapest_edits_equal_trying_all():
    rnd = random.Random(1)
    for n in range(5):
        for _ in range(60):
            rows = [rnd.choice(LABELS) for _ in range(n)]
            assert decode(rows)[0] == by_trying_all(rows) == by_strings(rows)


def test_long_conversations_equal_whole_string_decoding():
    rnd = random.Random(2)
    for _ in range(400):
        rows = [rnd.choice(LABELS) for _ in range(rnd.randint(5, 80))]
        assert decode(rows)[0] == by_strings(rows)


def test_ties_that_stay_open_to_the_end():
    """All rows the same: the survivors differ from the first row on."""
    for n in (1, 2, 3, 40, 41):
        rows = [("u", "fine")] * n
        assert decode(rows)[0] == by_strings(rows)


def test_resolved_edits_leave_memory():
    rnd = random.Random(3)
    assert decode([("ua"[i % 2], "fine") for i in range(5000)])[1] <= 16
    assert decode([(rnd.choice("ua"), "fine") for i in range(5000)])[1] <= 1000


def by_hand(rows, ids):
    """The contract over plain rows (conv_id, turn, role, text), already damaged."""
    conv = {i: [] for i in ids}
    for c, t, role, text in rows:
        conv[c].append((t is not None, t or 0, role, text))
    out = {}
    for c, found in conv.items():
        # rows of equal turn: any fixed order will do if their texts differ, so the tests avoid that
        found.sort()
        seen, labels, n = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in found:
            body = text.strip(" \t\n\x0b\x0c\r")
            fault = ("blank" if not body else "duplicate" if (role, text) in seen
                     else "truncated" if body[-1] not in ".!?" else None)
            seen.add((role, text))
            if fault:
                n[fault] += 1
            labels.append((role[:1], "gone" if fault in ("blank", "duplicate") else fault or "fine"))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(labels, labels[1:]))
        cost, audit = by_strings([(i if i in ("s", "u", "a") else "", f) for i, f in labels])
        done, last, left = [], "", iter(found)
        for e in audit:
            row = None if e == "I" else next(left)
            if e == "D":
                continue
            last = row[2] if e == "K" else "assistant" if last[:1] == "u" else "user"
            done.append((last, "" if row is None else row[3]))
        turns = {t for known, t, _, _ in found if known}
        out[c] = ((max(turns) - min(turns) + 1 - len(turns)) if turns else 0, *n.values(), illegal, cost, audit, done)
    return out


def report(df):
    cols = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r["conv_id"]: tuple(r[c] for c in cols) for r in df.collect()}


def digest(done):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in done).encode()).hexdigest()


def damage(rows):
    for c, t, role, text in rows:
        code = zlib.crc32(f"{c}:{t}".encode()) % 20
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        yield from [(c, t, "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    want = by_hand(damage(rows), {r[0] for r in rows})
    assert report(op11_conversation_repair(spark, SF)) == {k: (*v[:-1], digest(v[-1])) for k, v in want.items()}


def test_one_conversation_holds_most_rows(spark):
    rnd = random.Random(5)
    rows = [(7, i, rnd.choice(["user", "assistant"]), f"Row {i % 700}.") for i in range(3000)]
    rows += [(i, t, "user", "Hello?") for i in range(100, 130) for t in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = by_hand(rows, {r[0] for r in rows})
    found = R.repair_report(df)
    assert report(R.repaired_digests(df, found)) == {k: (*v[:-1], digest(v[-1])) for k, v in want.items()}
    done = defaultdict(list)
    for r in sorted(R.repaired_rows(df, found).collect(), key=lambda r: (r["conv_id"], r["place"])):
        if r["edit"] != "D":
            done[r["conv_id"]].append((r["role"], r["text"]))
    assert {k: done[k] for k in want} == {k: v[-1] for k, v in want.items()}  # some keep no row


@pytest.fixture(scope="module")
def odd_rows(spark):
    long = "word " * 60_000 + "end."
    rows = [(1, None, "user", "First."), (1, 2, "user", "Hi."), (1, 2, "user", "Hi."), (1, 5, None, None),
            (1, 6, "assistant", long), (2, None, None, None), (3, 1, "", "x!"), (3, 2, "system", "Be kind."),
            (None, 4, "system", "S."), (None, 5, "user", " \t\n"), (None, 6, "user", "Ünï?  "), (4, 9, "assistant", "no end")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return rows, df.selectExpr("*", *[f"'x' AS `{c}`" for c in ("c", "kind", "digest", "audit", "blank", "code", "copy")])


def test_edge_rows(spark, odd_rows):
    rows, df = odd_rows
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    want = by_hand(plain, {r[0] for r in rows})
    found = R.repair_report(df)
    assert report(R.repaired_digests(df, found)) == {k: (*v[:-1], digest(v[-1])) for k, v in want.items()}
    assert report(R.damage_and_repair(df)).keys() == want.keys()


def test_conversations_without_rows_and_empty_tables(spark, odd_rows):
    _, df = odd_rows
    none = df.filter("1 = 0")
    assert R.damage_and_repair(none).collect() == []
    found = R.repair_report(none, df)
    got = report(R.repaired_digests(none, found))
    assert got == {c: (0, 0, 0, 0, 0, 0, "", digest([])) for c in (1, 2, 3, 4, None)}
    assert R.repaired_rows(none, found).collect() == []


def test_damage(spark):
    rows = [(c, t, "assistant", f"One. Two! {c}?") for c in range(40) for t in range(6)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted(map(tuple, R.damaged(df).collect())) == sorted(damage(rows))
    assert R.damaged(df).filter(F.col("text") == "").count() > 0
