"""op11: exhaustive search, segments and pieces, the defined results."""

import hashlib
import random
import re
import zlib

import pytest

from tidecast.llm import conversations as C

ENDS = re.compile(r"(s?(ua)+)?")
SPACE = "\x20\t\n\x0b\x0c\r"


def exhaustive(rows):
    """(cost, audit, repaired) of (role, text, fault) rows by trying every edit sequence of at
    most a cost, for growing costs."""
    def grow(i, initials, cost, audit, out, limit):
        if cost > limit:
            return
        if i == len(rows) and ENDS.fullmatch(initials):
            yield cost, audit, out
        for r in ("user", "assistant"):
            yield from grow(i, initials + r[0], cost + 5, audit + "I", [*out, (r, "")], limit)
        if i == len(rows):
            return
        role, text, fault = rows[i]
        yield from grow(i + 1, initials, cost + 2, audit + "D", out, limit)
        if fault not in ("blank", "duplicate"):
            more = 5 if fault == "truncated" else 0
            yield from grow(i + 1, initials + (role[:1] or "?"), cost + more, audit + "K", [*out, (role, text)], limit)
            for r in ("user", "assistant"):
                yield from grow(i + 1, initials + r[0], cost + more + 1, audit + "R", [*out, (r, text)], limit)

    for limit in range(2 * len(rows) + 1):
        if found := list(grow(0, "", 0, "", [], limit)):
            return min(found)
    raise AssertionError


def by_rows(rows):
    """The same by a table over (row, state), for longer conversations."""
    steps = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {"0": (0, "", [])}

    def inserted(best):
        for _ in range(3):
            for st, (c, a, out) in list(best.items()):
                for r in ("user", "assistant"):
                    if (to := steps.get((st, r[0]))) and (to not in best or (c + 5, a + "I") < best[to][:2]):
                        best[to] = (c + 5, a + "I", [*out, (r, "")])
        return best

    for role, text, fault in rows:
        after = {}
        for st, (c, a, out) in inserted(best).items():
            ways = [(st, (c + 2, a + "D", out))]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                if to := steps.get((st, role[:1])):
                    ways.append((to, (c + more, a + "K", [*out, (role, text)])))
                ways += [(to, (c + more + 1, a + "R", [*out, (r, text)])) for r in ("user", "assistant") if (to := steps.get((st, r[0])))]
            for to, way in ways:
                if to not in after or way[:2] < after[to][:2]:
                    after[to] = way
        best = after
    return min((w for st, w in inserted(best).items() if st in "0a"), key=lambda w: w[:2])


def expected(rows, solve):
    """{conv_id: result} of (conv_id, turn, role, text) rows, damaged as the contract says."""
    convs = {}
    for conv, turn, role, text in rows:
        out = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    for conv, out in convs.items():
        out.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marked = set(), []
        for _, role, text in out:
            end = text.rstrip(SPACE)
            marked.append((role, text, "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else ""))
            seen.add((role, text))
        turns = [t for t, _, _ in out if t is not None]
        count = lambda f: sum(m[2] == f for m in marked)  # noqa: E731, B023
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit, fixed = solve(marked)
        yield (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, count("blank"), count("duplicate"), count("truncated"), illegal,
               cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest())


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, n long, digest string, part int, place string, kind string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 7, "x", 1, "p", "done") for r in rows], SCHEMA).repartition(parts)


def results(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def talk(rnd, conv, n):
    texts = ["Ja.", "No!", "cut", "", " \n", "Why?  ", "end.\t", "été."]
    return [(conv, t, rnd.choice(["user", "assistant", "system", "user", "assistant", "tool", "", "u", "Assistant"]), rnd.choice(texts) if rnd.random() < .5 else f"t{rnd.random()}.") for t in range(n)]


def test_search_equals_every_edit_sequence():
    rnd = random.Random(5)
    for _ in range(150):
        rows = [(rnd.choice(["user", "assistant", "system", "x"]), "t.", rnd.choice(["", "", "", "truncated", "blank"])) for _ in range(rnd.randrange(6))]
        cost, audit, fixed = exhaustive(rows)
        codes = [(r[:1], f == "blank", f == "truncated") for r, _, f in rows]
        got = C.search(codes, C.NOTHING, C.Costs().tails(), C.Costs())
        assert (cost, audit) == got[:2] and by_rows(rows)[:2] == got[:2]
        assert C.apply_audit(audit, [(r, t) for r, t, _ in rows], C.NOTHING) == fixed


def test_bounds_never_exceed_the_cost():
    rnd = random.Random(6)
    for _ in range(200):
        codes = [(rnd.choice("suax"), rnd.random() < .2, rnd.random() < .2) for _ in range(rnd.randrange(12))]
        bounds = C.suffix_bounds(codes, C.Costs())
        for entry in C.STATES:
            cost = C.search(codes, entry, C.Costs().tails(), C.Costs())[0]
            assert bounds[0][entry == C.USER] <= cost


def test_whole_query_on_damaged_rows(spark):
    rnd = random.Random(7)
    rows = [r for c in range(80) for r in talk(rnd, c, rnd.randrange(1, 9))]
    rows += [r for c in (901, None) for r in talk(rnd, c, 6)]
    rows += [(902, None, None, None), (902, 4, "user", "A?"), (902, None, "user", "B."), (903, 3, "user", "same."), (903, 3, "user", "same."), (903, 3, "assistant", "z."), (903, 9, "assistant", "z.")]
    got = results(C.repair(C.damaged(frame(spark, rows))))
    assert got == sorted(expected(rows, by_rows), key=str)


@pytest.mark.parametrize("segment_rows,parts", [(3, 1), (4, 12), (256, 12)])
def test_long_conversations_are_cut_and_joined(spark, segment_rows, parts):
    """Segments inside a task, pieces of one conversation in many tasks: the same result."""
    rnd = random.Random(segment_rows + parts)
    rows = talk(rnd, 1, 400) + talk(rnd, 2, 3) + talk(rnd, 3, 90) + talk(rnd, None, 40) + talk(rnd, 4, 1)
    rows += [(5, 0, "system", "only."), *((6, t, "user", f"alone {t}.") for t in range(31)), *((7, t, "user", "again.") for t in range(50))]
    n = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = results(C.repair(C.damaged(frame(spark, rows)), segment_rows=segment_rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", n)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == sorted(expected(rows, by_rows), key=str)


def test_repaired_turns_are_the_hashed_text(spark):
    rnd = random.Random(9)
    rows = talk(rnd, 1, 60) + talk(rnd, 2, 5) + [(3, 0, "system", "only."), (4, 0, "system", "s."), (4, 1, "user", "why?"), (4, 2, "assistant", "cut")]
    df = C.turns(frame(spark, rows))
    text = {}
    for r in sorted(C.repaired_turns(df, segment_rows=16).collect(), key=lambda r: (r["part"], r["seg"], r["at"])):
        text.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    hashes = {r["conv_id"]: r["repaired_sha256"] for r in C.repair(df).collect()}
    assert {c: hashlib.sha256("\n".join(text.get(c, [])).encode()).hexdigest() for c in hashes} == hashes
    for turns in text.values():
        assert ENDS.fullmatch("".join(t[0] for t in turns))


def test_empty_table_and_lost_conversation(spark):
    assert results(C.repair(C.damaged(frame(spark, [])))) == []
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert results(C.repair(C.damaged(frame(spark, [(lost, 0, "user", "gone.")])))) == [(lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_very_long_text(spark):
    rows = [(1, 0, "user", "a" * 5_000_000 + "."), (1, 1, "assistant", "b" * 5_000_000 + "."), (1, 2, "user", "c.")]
    assert results(C.repair(C.damaged(frame(spark, rows)))) == sorted(expected(rows, by_rows), key=str)
