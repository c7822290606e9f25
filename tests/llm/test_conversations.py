"""Conversation repair against a plain dynamic program over all edits, on rows that are null, equal, blank or many."""

import hashlib
import random
import re
import zlib

from hourloom.llm import conversations as cv

SCHEMA = "conv_id long, turn long, role string, text string, copies string, part int"
KEEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def hurt(rows):
    for conv, turn, role, text in rows:
        word = lambda v: " " if v is None else str(v)
        how = zlib.crc32(f"{word(conv)}:{word(turn)}".encode()) % 20
        role, text = "user" if how == 4 else word(role), "" if how == 1 else re.sub("[.!?]", "", word(text)) if how == 2 else word(text)
        for _ in range({0: 0, 3: 2}.get(how, 1)):
            yield turn, role, text


def brute(rows):
    digest = lambda role, text: hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
    rows = sorted(hurt(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), digest(*r[1:])))
    seen, kinds = set(), []
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        kinds.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    # best derivation by (last initial, lines): every edit of every row, up to two insertions between
    best = {"": (0, "", ())}

    def insertions(now):
        for _ in range(2):
            for q, (cost, audit, lines) in list(now.items()):
                for x, name in (("u", "user"), ("a", "assistant")):
                    if (q, x) in KEEP:
                        made = (cost + 3, audit + "I", (*lines, f"{name}:"))
                        if x not in now or made[:2] < now[x][:2]:
                            now[x] = made
        return now

    for (_, role, text), kind in zip(rows, kinds):
        new = {}
        for q, (cost, audit, lines) in insertions(best).items():
            ways = [(q, cost + 4, "D", ())]
            if kind in ("", "truncated"):
                more = 3 * (kind == "truncated")
                if (q, role[:1]) in KEEP:
                    ways.append((role[:1], cost + more, "K", (f"{role}:{text}",)))
                ways += [(x, cost + more + 3, "R", (f"{name}:{text}",)) for x, name in (("u", "user"), ("a", "assistant")) if (q, x) in KEEP]
            for to, c, e, line in ways:
                made = (c, audit + e, lines + line)
                if to not in new or made[:2] < new[to][:2]:
                    new[to] = made
        best = new
    cost, audit, lines = min(v for q, v in insertions(best).items() if q in ("", "a"))
    turns = {t for t, *_ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def some_rows():
    rnd, rows = random.Random(5), []
    roles, texts = ["system", "user", "assistant", "user", "assistant", "tool", "", None], ["Yes.", "No!", "Well", "", " \t", "Why? ", "Ein Satz.", "x" * 40_000 + ".", None]
    for c in range(120):
        for t in range(rnd.choice([1, 2, 4, 7])):
            rows.append((c, t + rnd.choice([0, 0, 0, 5]), rnd.choice(roles), rnd.choice(texts)))
    for t in range(700):  # one conversation of many segments
        rows.append((500, t, rnd.choice(roles), f"{t} {rnd.choice(texts[:7])}" if rnd.random() < 0.8 else rnd.choice(texts[:7])))
    rows += [(600, None, "user", "Hi.")] * 5 + [(600, None, "assistant", "Ho."), (None, 1, "user", "A."), (None, None, None, None), (None, 2, "assistant", "B.")]
    return rows + [(7, 3, "user", "Same.")] * 40


def test_against_brute_force(spark):
    rows = some_rows()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        got = {r[0]: tuple(r)[1:] for r in cv.repair(df, segment=16).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    assert got.keys() == groups.keys()
    for c, g in groups.items():
        assert got[c] == brute(g), c


def test_a_long_conversation_is_many_tasks_work(spark):
    df = spark.createDataFrame([(1, t, "user" if t % 2 == 0 else "assistant", f"{t}.") for t in range(900)], "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cut = cv.segments(cv.faults(cv.damaged(df)), 64).select("part", "number").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len({r.part for r in cut}) >= 3 and len(cut) >= 13


def test_nothing_left_and_empty(spark):
    dropped = [(c, 0, "user", "Hi.") for c in range(100) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    got = cv.repair(spark.createDataFrame(dropped, "conv_id long, turn long, role string, text string")).collect()
    assert len(got) == len(dropped) > 0 and {tuple(r)[1:] for r in got} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}
    assert cv.repair(spark.createDataFrame([], SCHEMA)).collect() == []


def test_agenda_pops_lightest_first():
    assert cv.lightest((), cv.BEGIN)[cv.A] == (6, "II")
    assert cv.lightest(("uo", "ao"), cv.BEGIN)[cv.A] == (0, "KK")
    assert cv.lightest(("ub",), cv.BEGIN)[cv.BEGIN] == (4, "D")
    assert cv.lightest(("ao", "uo"), cv.BEGIN)[cv.A] == (6, "IKKI")  # lighter audits first among equal costs: "IKKI" < "RR"
