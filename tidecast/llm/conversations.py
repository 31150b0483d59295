"""Conversation structure repair by depth-first branch and bound.

Rows of a conversation, ordered by turn, are kept, given another role, deleted, or joined by
inserted empty turns, at the least cost that makes the role initials read ``(s?(ua)+)?``; of
equal costs the ASCII-least audit (one letter an edit: D, I, K, R) wins.

Spark tells duplicates by an aggregate over digests and sorts the rows by range partitions of
(conversation, turn, role, text), so that a conversation of any length is dealt over many tasks.
A task cuts its rows into segments of at most ``SEGMENT_ROWS`` and searches each one: an explicit
stack, lower bounds of every suffix from a wider language (``s`` may stand anywhere, the end is
free), an incumbent (cost, audit), and a table of the best prefix of every node (row, state) that
eliminates worse ones; the search ends when the stack is empty, which proves the optimum.  A
conversation that is one segment is done there.  Of the others, every segment is solved from each
state before it to each state after it; the small (cost, order) tables are folded first over a
task's piece, then over the pieces, and the chosen way is handed down again.

Why order is enough for ties: an insert belongs to the row behind it, so two prefixes over the same
rows end in a letter that uses up a row and neither is a prefix of the other; the order of two
audits is that of their first pieces that differ.

Defined results: a null role or text is one space; a null conversation id is a conversation; null
turns come first; rows of one turn are ordered by role, then text; repeated rows are duplicates
after the first; a conversation that lost all rows has zeros, an empty audit and the hash of the
empty string; a role's initial is its first character (none for an empty role, which can not be
kept); very long texts travel once and are hashed as a stream; an empty table gives no rows;
further columns, of whatever name, are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import _shared as S, _sql

#: Most rows and code points of a segment.
SEGMENT_ROWS = 256
SEGMENT_CHARS = 4_000_000

# states: what has been emitted last
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
_NEXT = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
_TURN = (USER, USER, ASSISTANT, USER)       # the state after the one role of u and a that may come next
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


@dataclass(frozen=True)
class Costs:
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5

    def tails(self) -> dict[int, tuple[int, str]]:
        """What the end of a conversation still costs in each state, and its letters."""
        return {NOTHING: (0, ""), ASSISTANT: (0, ""), USER: (self.insert, "I"), SYSTEM: (2 * self.insert, "II")}


# ---------------------------------------------------------------- the search

def suffix_bounds(rows: list[tuple[str, bool, bool]], costs: Costs) -> list[tuple[int, int]]:
    """Per row, the least cost of it and all behind it in the wider language, if a user turn
    (0) or an assistant turn (1) may come next."""
    out = [(0, 0)]
    for initial, forced, truncated in reversed(rows):
        below = out[-1]
        base = []
        for c in (0, 1):
            cost = costs.delete + below[c]
            if not forced:
                extra = costs.truncated if truncated else 0
                cost = min(cost, costs.rerole + extra + below[1 - c])
                if initial == "s":
                    cost = min(cost, extra + below[c])
                elif initial == "ua"[c]:
                    cost = min(cost, extra + below[1 - c])
            base.append(cost)
        out.append((min(base[0], costs.insert + base[1]), min(base[1], costs.insert + base[0])))
    return out[::-1]


def search(rows: list[tuple[str, bool, bool]], entry: int, tails: dict[int, tuple[int, str]],
           costs: Costs, bounds: list[tuple[int, int]] | None = None) -> tuple[int, str, int] | None:
    """The least (cost, audit) over ``rows`` (initial, must go, truncated) from state ``entry`` to
    a state of ``tails``, with that state before its tail; None if there is no way."""
    bounds = bounds or suffix_bounds(rows, costs)
    n = len(rows)
    best: tuple[int, str, int] | None = None
    table: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, "", 0, entry)]
    while stack:
        cost, audit, i, state = stack.pop()
        if best is not None:
            low = cost + bounds[i][state == USER]
            if low > best[0] or (low == best[0] and audit > best[1][:len(audit)]):
                continue
        prefix, node = (cost, audit), (i, state)
        seen = table.get(node)
        if seen is not None and seen <= prefix:
            continue
        table[node] = prefix
        if i == n:
            if state in tails:
                more, letters = tails[state]
                whole = (cost + more, audit + letters, state)
                if best is None or whole[:2] < best[:2]:
                    best = whole
            continue
        initial, forced, truncated = rows[i]
        turn = _TURN[state]
        children = [(cost + costs.delete, "D", i + 1, state), (cost + costs.insert, "I", i, turn)]
        if not forced:
            extra = cost + (costs.truncated if truncated else 0)
            kept = _NEXT.get(initial, {}).get(state)
            if kept is not None:
                children.append((extra, "K", i + 1, kept))
            children.append((extra + costs.rerole, "R", i + 1, turn))
        # the most promising child is taken up first: it goes on the stack last
        children.sort(key=lambda c: (c[0] + bounds[c[2]][c[3] == USER], c[1]), reverse=True)
        stack += [(c, audit + letter, at, to) for c, letter, at, to in children]
    return best


def transfers(rows: list[tuple[str, bool, bool]], costs: Costs) -> list[tuple[int, int, int, int, str]]:
    """(entry, exit, cost, order, audit) of every way through a segment; order ranks the audits
    of one entry."""
    bounds, out = suffix_bounds(rows, costs), []
    for entry in STATES:
        ways = []
        for leave in STATES:
            if (way := search(rows, entry, {leave: (0, "")}, costs, bounds)) is not None:
                ways.append((way[1], leave, way[0]))
        out += [(entry, leave, cost, order, audit) for order, (audit, leave, cost) in enumerate(sorted(ways))]
    return out


Table = dict[tuple[int, int], tuple[int, int]]      # (entry, exit) -> (cost, order)


def route(tables: list[Table], entry: int) -> dict[int, tuple[int, int, list[int]]]:
    """For each state after the last table: (cost, order among them, states passed) of the least
    way from ``entry``."""
    live = {entry: (0, 0)}
    back: list[dict[int, int]] = []
    for table in tables:
        found: dict[int, tuple[int, int, int, int]] = {}
        for (a, b), (cost, order) in table.items():
            if a in live:
                way = (live[a][0] + cost, live[a][1], order, a)
                if b not in found or way < found[b]:
                    found[b] = way
        ranked = sorted(found, key=lambda b: found[b][1:3])
        live = {b: (found[b][0], ranked.index(b)) for b in found}
        back.append({b: found[b][3] for b in found})
    out = {}
    for b, (cost, order) in live.items():
        states, at = [b], b
        for step in reversed(back):
            at = step[at]
            states.append(at)
        out[b] = (cost, order, states[::-1])
    return out


def folded(tables: list[Table]) -> Table:
    """The table of several segments in a row."""
    return {(a, b): (cost, order) for a in STATES for b, (cost, order, _) in route(tables, a).items()}


def apply_audit(audit: str, rows: list[tuple[str, str]], entry: int) -> list[tuple[str, str]]:
    """The repaired (role, text) turns."""
    out, at, state = [], 0, entry
    for letter in audit:
        if letter == "D":
            at += 1
            continue
        if letter == "K":
            role, text = rows[at]
            state = _NEXT[role[0]][state]
        else:
            state = _TURN[state]
            role, text = _ROLE[state], "" if letter == "I" else rows[at][1]
        at += letter != "I"
        out.append((role, text))
    return out


# ---------------------------------------------------------------- rows in order

def turns(df: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n): distinct rows and how often each occurs, nulls filled."""
    return _distinct(df.select("conv_id", "turn", _filled("role"), _filled("text"), F.lit(1).cast("long").alias("n")))


def _filled(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name)


def _distinct(rows: DataFrame) -> DataFrame:
    # copies of a row meet as counts of each task; the digest stands for the text as a key
    return (rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
            .groupBy("conv_id", "turn", "role", "digest").agg(F.first("text").alias("text"), F.sum("n").alias("n")))


def damaged(df: DataFrame) -> DataFrame:
    """:func:`turns` after the damage by crc32 of ``conv_id:turn`` modulo 20; a dropped row stays
    as one of n = 0, so that its conversation is not forgotten."""
    def key(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    rows = df.select("conv_id", "turn", _filled("role"), _filled("text"), (F.crc32(F.concat(key("conv_id"), F.lit(":"), key("turn"))) % 20).alias("k"))
    k, gone = F.col("k"), F.col("k") == 0
    return _distinct(rows.select(
        "conv_id", F.when(~gone, F.col("turn")).alias("turn"),
        F.when(gone, "").when(k == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(gone | (k == 1), "").when(k == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(gone, 0).when(k == 3, 2).otherwise(1).cast("long").alias("n")))


def _flagged(rows: DataFrame) -> DataFrame:
    """With the fault of the first of a row's copies (the other copies are duplicates)."""
    rows = S.table(rows, "conversation-rows")
    # null turns first, as in the order of the rows
    place = F.struct(F.col("turn").isNotNull().alias("some"), F.col("turn").alias("turn"))
    firsts = rows.filter("n > 0").groupBy("conv_id", "role", "digest").agg(F.min(place).alias("place")).select(
        F.col("conv_id").alias("conv_id_"), F.col("role").alias("role_"), F.col("digest").alias("digest_"), "place")
    end = F.rtrim(F.col("text"), F.lit(_SPACES))
    fault = (F.when(end == "", "blank").when(~place.eqNullSafe(F.col("place")), "duplicate")
             .when(~F.substring(end, -1, 1).isin(".", "!", "?"), "truncated").otherwise(""))
    return rows.join(firsts, F.col("conv_id").eqNullSafe(F.col("conv_id_")) & (F.col("role") == F.col("role_")) & (F.col("digest") == F.col("digest_")), "left").select(
        "conv_id", "turn", "role", "text", "n", fault.alias("fault"))


# ---------------------------------------------------------------- segments and pieces

_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_SEGMENT_FIELDS = ("kind string, conv_id {conv}, part int, seg int, ways array<struct<entry:int,leave:int,cost:long,order:int,audit:string>>, "
                   "first string, last string, first_turn {turn}, last_turn {turn}, n_turns long, n_rows long, "
                   "blank long, duplicate long, truncated long, illegal long, cost long, audit string, sha256 string, turns array<struct<role:string,text:string>>")


class _Segment:
    """Rows of one conversation that are searched together."""

    def __init__(self, limit: int):
        self.limit = limit
        self.rows: list[tuple[str, bool, bool]] = []
        self.texts: list[tuple[str, str]] = []
        self.chars = 0

    def add(self, role: str, text: str, fault: str) -> None:
        forced = fault in ("blank", "duplicate")
        self.rows.append((role[:1], forced, fault == "truncated"))
        self.texts.append((role, "" if forced else text))
        self.chars += len(self.texts[-1][1])

    @property
    def full(self) -> bool:
        return len(self.rows) >= self.limit or self.chars >= SEGMENT_CHARS


class _Piece:
    """What one task holds of a conversation: its finished segments as records, one open."""

    def __init__(self, conv, part: int, costs: Costs, segment_rows: int):
        self.conv, self.part, self.costs, self.segment_rows = conv, part, costs, segment_rows
        self.segment = _Segment(segment_rows)
        self.tables: list[Table] = []
        self.first = self.last = self.first_turn = self.last_turn = None
        self.n_turns = self.n_rows = 0
        self.counts = dict.fromkeys(_COUNTS, 0)

    def add(self, turn, role: str, text: str, n: int, fault: str):
        """Yields a segment's record when it is full."""
        if not n:
            return
        if turn is not None and (self.last_turn is None or turn != self.last_turn):
            self.n_turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        initial = role[:1]
        self.first = initial if self.first is None else self.first
        if self.last is not None:
            self.counts["illegal"] += self.last + initial not in ("su", "ua", "au")
        self.last = initial
        self.counts["illegal"] += n - 1
        self.n_rows += n
        for k in range(n):
            name = fault if k == 0 or fault == "blank" else "duplicate"
            if name:
                self.counts[name] += 1
            self.segment.add(role, text, name)
            if self.segment.full:
                yield self.close_segment()

    def record(self, kind: str, **more) -> dict:
        return {"kind": kind, "conv_id": self.conv, "part": self.part} | more

    def close_segment(self) -> dict:
        segment, self.segment = self.segment, _Segment(self.segment_rows)
        ways = transfers(segment.rows, self.costs)
        self.tables.append({(a, b): (cost, order) for a, b, cost, order, _ in ways})
        return self.record("segment", seg=len(self.tables) - 1, ways=[dict(zip(("entry", "leave", "cost", "order", "audit"), w)) for w in ways],
                           turns=[{"role": r, "text": t} for r, t in segment.texts])

    def close(self, whole: bool, keep_turns: bool):
        """The last records: one that is done, or the open segment and the piece."""
        facts = self.counts | {"first": self.first, "last": self.last, "first_turn": self.first_turn, "last_turn": self.last_turn,
                               "n_turns": self.n_turns, "n_rows": self.n_rows}
        if whole and not self.tables:
            cost, audit, _ = search(self.segment.rows, NOTHING, self.costs.tails(), self.costs)
            out = apply_audit(audit, self.segment.texts, NOTHING)
            text = "\n".join(f"{r}:{t}" for r, t in out)
            yield self.record("done", seg=0, cost=cost, audit=audit, sha256=hashlib.sha256(text.encode()).hexdigest(),
                              turns=[{"role": r, "text": t} for r, t in out] if keep_turns else None, **facts)
            return
        if self.segment.rows:
            yield self.close_segment()
        ways = [{"entry": a, "leave": b, "cost": cost, "order": order} for (a, b), (cost, order) in folded(self.tables).items()]
        yield self.record("piece", ways=ways, **facts)


def _repaired(rows: DataFrame, costs: Costs, segment_rows: int, keep_turns: bool) -> DataFrame:
    """The records of all tasks: ``done`` conversations; ``segment`` and ``piece`` of the others."""
    conv, turn = (rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    flagged = S.table(_flagged(rows), "conversation-faults")
    fields = _SEGMENT_FIELDS.format(conv=conv, turn=turn)
    schema = S.arrow_schema(rows.sparkSession, fields)

    def work(batches):
        part, piece, first = TaskContext.get().partitionId(), None, True
        out: list[dict] = []
        size = 0
        for b in batches:
            for conv_id, at, role, text, n, fault in zip(*(b.column(k).to_pylist() for k in range(6)), strict=True):
                if piece is None or conv_id != piece.conv:
                    if piece is not None:
                        out += piece.close(not first, keep_turns)   # the first may have begun in the task before
                        first = False
                    piece = _Piece(conv_id, part, costs, segment_rows)
                for record in piece.add(at, role, text, n, fault):
                    out.append(record)
                size += len(text)
                if len(out) >= 2000 or size >= SEGMENT_CHARS:
                    if out:
                        yield pa.RecordBatch.from_pylist(out, schema)
                    out, size = [], 0
        if piece is not None:
            out += piece.close(False, keep_turns)       # the last may go on in the next task
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    # a prefix of the text is enough to split ranges; whole texts never go to the driver
    ordered = flagged.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 32)).sortWithinPartitions("conv_id", "turn", "role", "text")
    return S.table(ordered.mapInArrow(work, fields), "conversation-repaired")


def _table_of(ways) -> Table:
    return {(int(w["entry"]), int(w["leave"])): (int(w["cost"]), int(w["order"])) for w in ways}


def _same(a: DataFrame, b: DataFrame, *columns: str) -> Column:
    cond = None
    for c in columns:
        one = a[c].eqNullSafe(b[c])
        cond = one if cond is None else cond & one
    return cond


def _stitched(records: DataFrame, costs: Costs) -> tuple[DataFrame, DataFrame]:
    """(facts of each piece and its conversation, the segments with their audits, the inserts
    at a conversation's end among them)."""
    conv, turn = (records.schema[c].dataType.simpleString() for c in ("conv_id", "first_turn"))
    facts = ["first", "last", "first_turn", "last_turn", "n_turns", "n_rows", *_COUNTS]
    pieces = records.filter("kind = 'piece'").select("conv_id", "part", "ways", *facts)

    def over_pieces(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        ends = costs.tails()
        ways = route([_table_of(w) for w in pdf["ways"]], NOTHING)
        leave = min((b for b in ways if b in ends), key=lambda b: (ways[b][0] + ends[b][0], ways[b][1]))
        cost, _, states = ways[leave]
        total = {c: int(pdf[c].sum()) for c in (*_COUNTS, "n_turns", "n_rows")}
        last = low = high = None
        for r in pdf.itertuples():
            if r.n_rows:
                if last is not None:
                    total["illegal"] += last + r.first not in ("su", "ua", "au")
                last = r.last
            if r.n_turns:
                total["n_turns"] -= high is not None and int(r.first_turn) == high
                low, high = (int(r.first_turn) if low is None else low), int(r.last_turn)
        rows = len(pdf)
        out = pd.DataFrame({"part": pdf["part"].astype("int32"), "entry": states[:-1], "leave": states[1:]})
        out.insert(0, "conv_id", pdf["conv_id"].array)
        out["head"] = [True] + [False] * (rows - 1)
        out["tail"] = [""] * (rows - 1) + [ends[leave][1]]
        out["last_leave"] = leave
        out["cost"] = cost + ends[leave][0]
        out["low"], out["high"] = pd.array([low] * rows, dtype="object"), pd.array([high] * rows, dtype="object")
        for c, v in total.items():
            out[c] = v
        return out

    sums = ", ".join(f"{c} long" for c in (*_COUNTS, "n_turns", "n_rows"))
    chosen = S.table(pieces.groupBy("conv_id").applyInPandas(
        over_pieces, f"conv_id {conv}, part int, entry int, leave int, head boolean, tail string, last_leave int, cost long, low {turn}, high {turn}, {sums}"), "conversation-pieces")

    segments = records.filter("kind = 'segment'")
    small = segments.select("conv_id", "part", "seg", F.transform("ways", lambda w: F.struct(w["entry"].alias("entry"), w["leave"].alias("leave"), w["cost"].alias("cost"), w["order"].alias("order"))).alias("ways"))

    def over_segments(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"conv_id": [], "part": [], "seg": [], "entry": [], "leave": []})
        left = left.sort_values("seg")
        states = route([_table_of(w) for w in left["ways"]], int(right["entry"].iloc[0]))[int(right["leave"].iloc[0])][2]
        return pd.DataFrame({"conv_id": left["conv_id"].array, "part": left["part"].array, "seg": left["seg"].array, "entry": states[:-1], "leave": states[1:]})

    paths = small.groupBy("conv_id", "part").cogroup(chosen.groupBy("conv_id", "part")).applyInPandas(over_segments, f"conv_id {conv}, part int, seg int, entry int, leave int")
    way = F.filter("ways", lambda w: (w["entry"] == F.col("entry")) & (w["leave"] == F.col("leave")))[0]
    solved = segments.join(paths, _same(segments, paths, "conv_id", "part", "seg")).select(
        segments["conv_id"], segments["part"], segments["seg"], paths["entry"], way["audit"].alias("audit"), segments["turns"])
    last = _extra(chosen.filter("tail != ''"), F.lit((1 << 31) - 1), F.col("last_leave"), F.col("tail"))
    return chosen, solved.unionByName(last)


def _extra(chosen: DataFrame, part: Column, entry: Column, audit: Column) -> DataFrame:
    """A segment without rows of its own."""
    return chosen.select("conv_id", part.alias("part"), F.lit(0).alias("seg"), entry.alias("entry"), audit.alias("audit"),
                         F.array().cast("array<struct<role:string,text:string>>").alias("turns"))


def _assembled(chosen: DataFrame, solved: DataFrame, conv: str) -> DataFrame:
    """(conv_id, audit, sha256): segments in order, their turns hashed as a stream, so that a
    conversation of any length takes the memory of one segment."""
    bare = _extra(chosen.filter("head"), F.lit(-1), F.lit(NOTHING), F.lit(""))
    fields = f"conv_id {conv}, audit string, sha256 string"
    schema = S.arrow_schema(chosen.sparkSession, fields)

    def stream(batches):
        current, digest, audits, begun, open_ = None, None, [], False, False
        done: list[tuple] = []
        for b in batches:
            for conv_id, entry, audit, texts in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                if not open_ or conv_id != current:
                    if open_:
                        done.append((current, "".join(audits), digest.hexdigest()))
                    current, digest, audits, begun, open_ = conv_id, hashlib.sha256(), [], False, True
                audits.append(audit)
                for role, text in apply_audit(audit, [(t["role"], t["text"]) for t in texts], entry):
                    digest.update((("\n" if begun else "") + f"{role}:{text}").encode())
                    begun = True
        if open_:
            done.append((current, "".join(audits), digest.hexdigest()))
        if done:
            yield pa.RecordBatch.from_pylist([dict(zip(("conv_id", "audit", "sha256"), d)) for d in done], schema)

    rows = solved.unionByName(bare)
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seg")
    return dealt.select("conv_id", "entry", "audit", "turns").mapInArrow(stream, fields)


def repair(rows: DataFrame, costs: Costs = Costs(), segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """One row a conversation of ``rows`` (:func:`turns`, :func:`damaged`): conv_id, gaps, the counts
    of faults, illegal pairs, cost, audit and the hash of the repaired turns."""
    S.prepare(rows.sparkSession)
    records = _repaired(rows, costs, segment_rows, keep_turns=False)
    conv = rows.schema["conv_id"].dataType.simpleString()
    gaps = F.when(F.col("n_turns") == 0, 0).otherwise(F.col("high") - F.col("low") + 1 - F.col("n_turns")).cast("long").alias("gaps")
    done = records.filter("kind = 'done'").withColumns({"low": F.col("first_turn"), "high": F.col("last_turn")}).select("conv_id", gaps, *_COUNTS, "cost", "audit", F.col("sha256").alias("repaired_sha256"))
    chosen, solved = _stitched(records, costs)
    texts = _assembled(chosen, solved, conv)
    heads = chosen.filter("head")
    rest = heads.join(texts, _same(heads, texts, "conv_id")).select(heads["conv_id"], gaps, *(heads[c] for c in _COUNTS), heads["cost"], texts["audit"], texts["sha256"].alias("repaired_sha256"))
    return done.unionByName(rest)


def repaired_turns(rows: DataFrame, costs: Costs = Costs(), segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """(conv_id, part, seg, at, role, text): the repaired conversations' turns; part, seg and at
    order them inside a conversation."""
    S.prepare(rows.sparkSession)
    records = _repaired(rows, costs, segment_rows, keep_turns=True)
    done = records.filter("kind = 'done'").select("conv_id", "part", "seg", F.posexplode("turns").alias("at", "t"))
    chosen, solved = _stitched(records, costs)
    fields = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, part int, seg int, at int, role string, text string"
    schema = S.arrow_schema(rows.sparkSession, fields)

    def expand(batches):
        for b in batches:
            out = []
            for conv_id, part, seg, entry, audit, texts in zip(*(b.column(k).to_pylist() for k in range(6)), strict=True):
                for at, (role, text) in enumerate(apply_audit(audit, [(t["role"], t["text"]) for t in texts], entry)):
                    out.append({"conv_id": conv_id, "part": part, "seg": seg, "at": at, "role": role, "text": text})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)

    rest = solved.select("conv_id", "part", "seg", "entry", "audit", "turns").mapInArrow(expand, fields)
    return done.select("conv_id", "part", "seg", "at", "t.role", "t.text").unionByName(rest)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


#: The same by a dynamic program, row by row: the least struct (cost, audit, repaired text) of each
#: state; before a row there may be up to two inserts.
ORACLE_SQL = f"""
WITH RECURSIVE {_sql.CRC_TABLE},
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_sql.crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS k FROM conversations, crc),
damaged AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN k = 3 THEN [1, 2] ELSE [1] END) AS copy FROM keyed WHERE k <> 0),
placed AS (SELECT *, row_number() OVER w AS i, lead(role) OVER w AS next_role, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
faults AS (SELECT *, CASE WHEN body = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    left(role, 1) AS initial FROM placed),
walk AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS s0, {{'c': 1000000000::BIGINT, 'a': '', 't': ''}} AS s1,
    {{'c': 1000000000::BIGINT, 'a': '', 't': ''}} AS s2, {{'c': 1000000000::BIGINT, 'a': '', 't': ''}} AS s3 FROM faults
  UNION ALL
  SELECT conv_id, i,
    [{{'c': s0.c + 2, 'a': s0.a || 'D', 't': s0.t}}][1],
    list_min(list_filter([{{'c': s1.c + 2, 'a': s1.a || 'D', 't': s1.t}}, CASE WHEN NOT gone AND initial = 's' THEN {{'c': s0.c + late, 'a': s0.a || 'K', 't': s0.t || kept}} END], lambda x: x IS NOT NULL)),
    list_min(list_filter([{{'c': u.c + 2, 'a': u.a || 'D', 't': u.t}}, CASE WHEN NOT gone AND initial = 'u' THEN {{'c': before_u.c + late, 'a': before_u.a || 'K', 't': before_u.t || kept}} END,
        CASE WHEN NOT gone THEN {{'c': before_u.c + late + 1, 'a': before_u.a || 'R', 't': before_u.t || chr(10) || 'user:' || text}} END], lambda x: x IS NOT NULL)),
    list_min(list_filter([{{'c': a.c + 2, 'a': a.a || 'D', 't': a.t}}, CASE WHEN NOT gone AND initial = 'a' THEN {{'c': u.c + late, 'a': u.a || 'K', 't': u.t || kept}} END,
        CASE WHEN NOT gone THEN {{'c': u.c + late + 1, 'a': u.a || 'R', 't': u.t || chr(10) || 'assistant:' || text}} END], lambda x: x IS NOT NULL))
  FROM (SELECT *, list_min([s0, s1, a]) AS before_u FROM (SELECT *,
      list_min([s3, {{'c': s2.c + 5, 'a': s2.a || 'I', 't': s2.t || chr(10) || 'assistant:'}}, {{'c': open.c + 10, 'a': open.a || 'II', 't': open.t || chr(10) || 'user:' || chr(10) || 'assistant:'}}]) AS a,
      list_min([s2, {{'c': shut.c + 5, 'a': shut.a || 'I', 't': shut.t || chr(10) || 'user:'}}]) AS u
    FROM (SELECT w.conv_id, f.i, w.s0, w.s1, w.s2, w.s3, list_min([w.s0, w.s1]) AS open, list_min([w.s0, w.s1, w.s3]) AS shut, f.initial, f.text,
        f.fault IN ('blank', 'duplicate') AS gone, CASE WHEN f.fault = 'truncated' THEN 5 ELSE 0 END AS late, chr(10) || f.role || ':' || f.text AS kept
      FROM walk w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1)))),
ends AS (SELECT conv_id, list_min([s0, s3, {{'c': s2.c + 5, 'a': s2.a || 'I', 't': s2.t || chr(10) || 'assistant:'}},
    {{'c': s1.c + 10, 'a': s1.a || 'II', 't': s1.t || chr(10) || 'user:' || chr(10) || 'assistant:'}}]) AS best
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS back FROM walk) WHERE back = 1),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (next_role IS NOT NULL AND initial || left(next_role, 1) NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(substr(best.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
"""
