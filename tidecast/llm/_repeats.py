"""Common frame of the two operators that remove what a document repeats of earlier ones.

A *unit* is a byte or a word, a *window* is ``length`` consecutive units of one document.  A
unit goes if a window that covers it also starts in a document with a smaller id.

1. ``parse``: each task cuts its texts into *phrases*, runs of windows that share an anchor
   chosen from their own content, so equal windows anywhere have equal anchors.  Equal phrases
   of one task are reduced to that of the smallest document before anything is shuffled; the
   others are marked at once.  A passage in a third of all documents is thus a row per task.
2. ``_meet``: phrases meet by anchor, as packed columns.  Of equal phrases all but those of the
   smallest document are marked; phrases whose anchor also occurs in another document go on,
   one of each kind.
3. ``_cut``: their units are cut from the texts, and split by the context around the anchor that
   all their windows must share, which divides the groups of very common anchors.
4. ``resolve``: within each context group the first document of every window is found (by the
   operator's own index) and later ones are marked.
5. ``keep``: the marks of a document meet its text once more and are cut out.

No step pairs the members of a group, and no step returns anything to the driver.
"""

from __future__ import annotations

import struct
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow.compute import list_value_length, take
from pyspark.sql import Column, DataFrame, functions as F

from . import _shared as S

#: Text bytes whose phrases a task reduces together before the shuffle.
FLUSH_BYTES = 12 << 20
#: Text bytes for each bucket in which phrases of one anchor meet.
BUCKET_BYTES = 4 << 20
#: Payload bytes that ``resolve`` gets at one time, in whole context groups.
SHARD_BYTES = 1 << 20


@dataclass
class Phrases:
    """Phrases of a chunk, sorted by place: row of the chunk, first unit in the row, number of
    windows, hash of the anchor and of all units."""
    row: np.ndarray
    at: np.ndarray
    windows: np.ndarray
    anchor: np.ndarray
    content: np.ndarray


def runs_of(values: np.ndarray, ok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last + 1 of the runs of equal values where ``ok``."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (ok[1:] != ok[:-1])
    a = np.flatnonzero(new)
    b = np.append(a[1:], len(values))
    return a[ok[a]], b[ok[a]]


def group_starts(*keys: np.ndarray) -> np.ndarray:
    """True where a sorted sequence of key tuples takes a new value."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = False
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
    return new


def merged(key: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Sorted, disjoint spans that cover the same units of each key."""
    if not len(key):
        return key, start, end
    o = np.lexsort((start, key))
    key, start, end = key[o], start[o], end[o].astype(np.int64)
    number = np.cumsum(group_starts(key)) - 1
    far = np.maximum.accumulate(end + number * (1 << 40)) - number * (1 << 40)
    new = group_starts(key)
    new[1:] |= start[1:] > far[:-1]
    first = np.flatnonzero(new)
    return key[first], start[first], np.maximum.reduceat(end, first)


def _hits(key, start, end) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(key, np.int64)), pa.array(np.asarray(start, np.int32)), pa.array(np.asarray(end, np.int32))], names=["key", "start", "end"])


HIT_SCHEMA = "key long, start int, end int"


# ---------------------------------------------------------------- packed phrases

def pack(doc: np.ndarray, key: np.ndarray, row: np.ndarray, p: dict[str, np.ndarray]) -> bytes:
    """Phrases of a bucket, sorted by row: the documents once, then one array per column."""
    first = np.flatnonzero(group_starts(row))
    count = np.diff(np.append(first, len(row)))
    at = p["at"].astype(np.int64)
    step = np.diff(at, prepend=0)
    step[first] = at[first]
    wide = bool(len(step) and step.max() >= 1 << 16)
    out = [struct.pack("<IIB", len(first), len(row), wide), doc[row[first]].tobytes(), key[row[first]].tobytes(), count.astype("<u4").tobytes(),
           step.astype("<u4" if wide else "<u2").tobytes(), p["windows"].astype("<u2").tobytes(), p["anchor"].tobytes(), p["content"].tobytes()]
    return b"".join(out)


def unpack(raw: bytes) -> dict[str, np.ndarray]:
    docs, n, wide = struct.unpack_from("<IIB", raw, 0)
    at = 9

    def take(kind: str, m: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(raw, kind, m, at)
        at += out.nbytes
        return out

    doc, key, count = take("<i8", docs), take("<i8", docs), take("<u4", docs)
    step = take("<u4" if wide else "<u2", n).astype(np.int64)
    total = np.cumsum(step)
    first = np.cumsum(count) - count
    place = total - np.repeat(total[first] - step[first], count) if n else total
    return {"doc": np.repeat(doc, count), "key": np.repeat(key, count), "at": place, "windows": take("<u2", n).astype(np.int64), "anchor": take("<u8", n), "content": take("<u8", n)}


def _parse_batches(parse, length: int, buckets: int):
    """Rows (bucket, kind, payload): packed phrases (kind 0) and the marks that a task can see
    on its own (kind 1)."""

    def emit(held):
        row_base, docs, keys, cols = 0, [], [], defaultdict(list)
        for doc, key, p in held:
            docs.append(doc)
            keys.append(key)
            cols["row"].append(p.row + row_base)
            for c in ("at", "windows", "anchor", "content"):
                cols[c].append(getattr(p, c))
            row_base += len(doc)
        doc, key = np.concatenate(docs), np.concatenate(keys)
        p = {c: np.concatenate(v) for c, v in cols.items()}
        if not len(p["row"]):
            return
        name = S.mix(p["anchor"]) ^ p["content"]
        owner = doc[p["row"]]
        o = np.lexsort((owner, name))
        new = group_starts(name[o])
        first = owner[o][np.flatnonzero(new)][np.cumsum(new) - 1]
        later = o[owner[o] > first]
        if len(later):
            k, s, e = merged(key[p["row"][later]], p["at"][later], p["at"][later] + p["windows"][later] + length - 1)
            yield 1, int(S.mix(np.array([k[0]]).view(np.uint64))[0] % np.uint64(buckets)), np.concatenate([k, s, e]).astype("<i8").tobytes()
        stay = np.ones(len(owner), bool)
        stay[later] = False
        p = {c: v[stay] for c, v in p.items()}
        bucket = (p["anchor"] % np.uint64(buckets)).astype(np.uint32)
        o = np.argsort(bucket, kind="stable")
        cut = np.flatnonzero(group_starts(bucket[o]))
        for a, b in zip(cut, np.append(cut[1:], len(o)), strict=True):
            part = {c: v[o[a:b]] for c, v in p.items()}
            yield 0, int(bucket[o[a]]), pack(doc, key, part.pop("row"), part)

    def run(batches):
        held, size = [], 0

        def out(rows):
            for kind, bucket, payload in rows:
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([kind], pa.int8()), pa.array([payload], pa.binary())], names=["bucket", "kind", "payload"])

        for b in batches:
            doc, key = (b.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            for i, j, off, data in S.chunks(b.column(2)):
                held.append((doc[i:j], key[i:j], parse(off, data)))
                size += len(data)
                if size >= FLUSH_BYTES:
                    yield from out(emit(held))
                    held, size = [], 0
        if held:
            yield from out(emit(held))

    return run


_NO_POSITIONS = pa.array([], pa.int32())
MEET_SCHEMA = f"{HIT_SCHEMA}, doc long, windows int, positions array<int>"


def _meet(length: int):
    """Marks (windows null) and the phrases to resolve (start and end null)."""

    def run(batches):
        parts = []
        for b in batches:
            for kind, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if kind:
                    k, s, e = np.frombuffer(raw, "<i8").reshape(3, -1)
                    yield marks(k, s, e)
                else:
                    parts.append(unpack(raw))
        if not parts:
            return
        p = {c: np.concatenate([x[c] for x in parts]) for c in parts[0]}
        del parts
        # a stable sort by key keeps each document's places ascending
        o = np.lexsort((p["key"], p["doc"], p["content"], p["anchor"]))
        p = {c: v[o] for c, v in p.items()}
        kind = group_starts(p["anchor"], p["content"])
        first = p["doc"][np.flatnonzero(kind)][np.cumsum(kind) - 1]
        later = p["doc"] > first
        if later.any():
            yield marks(*merged(p["key"][later], p["at"][later], p["at"][later] + p["windows"][later] + length - 1))
        # phrases of the first document, by anchor: those of an anchor with several documents
        p = {c: v[~later] for c, v in p.items()}
        anchor = group_starts(p["anchor"])
        number = np.cumsum(anchor) - 1
        low = np.minimum.reduceat(p["doc"], np.flatnonzero(anchor)) if len(number) else np.zeros(0, np.int64)
        high = np.maximum.reduceat(p["doc"], np.flatnonzero(anchor)) if len(number) else low
        go = (low < high)[number] if len(number) else np.zeros(0, bool)
        p = {c: v[go] for c, v in p.items()}
        one = np.flatnonzero(group_starts(p["anchor"], p["content"], p["key"]))
        for i in range(0, len(one), 50_000):
            some = one[i:i + 50_000]
            end = one[i + 50_000] if i + 50_000 < len(one) else len(p["at"])
            positions = pa.ListArray.from_arrays(pa.array(np.append(some, end).astype(np.int32) - np.int32(some[0])), pa.array(p["at"][some[0]:end].astype(np.int32)))
            none = pa.nulls(len(some), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(p["key"][some]), none, none, pa.array(p["doc"][some]), pa.array(p["windows"][some].astype(np.int32)), positions],
                                             names=["key", "start", "end", "doc", "windows", "positions"])

    def marks(k, s, e):
        n = len(k)
        return pa.RecordBatch.from_arrays([pa.array(k), pa.array(s.astype(np.int32)), pa.array(e.astype(np.int32)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.int32()))],
                                          names=["key", "start", "end", "doc", "windows", "positions"])

    return run


CUT_SCHEMA = "context long, key long, doc long, first int, windows int, positions array<int>, payload binary"


def _cut(cutter):
    """One row per context group of each phrase.  ``cutter(off, data, row, at, windows)`` gives for
    the phrases of a chunk (row, first unit in it, windows) the arrays phrase, context hash,
    first window of the part, its windows, payload."""

    def run(batches):
        for b in batches:
            for i, j, off, data in S.chunks(b.column(1)):
                lists = b.column(2).slice(i, j - i)
                row = np.repeat(np.arange(j - i), list_value_length(lists).to_numpy(zero_copy_only=False))
                doc, windows, positions = lists.flatten().flatten()
                at = positions.values.to_numpy()[positions.offsets.to_numpy()[:-1]].astype(np.int64)
                phrase, context, first, n, payload = cutter(off, data, row, at, windows.to_numpy().astype(np.int64))
                key = b.column(0).slice(i, j - i).to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(context), pa.array(key[row[phrase]]), take(doc, pa.array(phrase)), pa.array(first.astype(np.int32)), pa.array(n.astype(np.int32)), take(positions, pa.array(phrase)), payload],
                    names=["context", "key", "doc", "first", "windows", "positions", "payload"])

    return run


def _resolve(resolve, length: int):
    """Marks of the phrases, from rows sorted by context.  ``resolve(payloads, docs, windows)``
    gives for distinct payloads the smallest document of each of their windows, flat."""

    def settle(t: pa.Table):
        new = group_starts(t["context"].to_numpy())
        head = np.flatnonzero(new)
        doc = t["doc"].to_numpy()
        several = np.minimum.reduceat(doc, head) < np.maximum.reduceat(doc, head)
        stay = np.flatnonzero(several[np.cumsum(new) - 1])
        if not len(stay):
            return
        t = take(t, pa.array(stay)).combine_chunks()
        doc, key = doc[stay], t["key"].to_numpy()
        n, first = t["windows"].to_numpy().astype(np.int64), t["first"].to_numpy().astype(np.int64)
        kinds = t["payload"].combine_chunks().dictionary_encode()
        which = kinds.indices.to_numpy()
        low = np.full(len(kinds.dictionary), np.iinfo(np.int64).max)
        np.minimum.at(low, which, doc)
        count = np.zeros(len(low), np.int64)
        count[which] = n
        best = resolve(kinds.dictionary.to_pylist(), low, count)
        base, before = np.cumsum(count) - count, np.cumsum(n) - n
        row = np.repeat(np.arange(len(n)), n)
        window = np.arange(len(row)) - before[row]
        at = np.flatnonzero(best[base[which[row]] + window] < doc[row])
        if not len(at):
            return
        # the spans of each phrase, then at each of its places
        offset = window[at] + first[row[at]]
        r, s, e = merged(row[at], offset, offset + length)
        places = t["positions"].combine_chunks()
        bounds, values = places.offsets.to_numpy().astype(np.int64), places.values.to_numpy().astype(np.int64)
        many = (bounds[1:] - bounds[:-1])[r]
        spot = values[np.repeat(bounds[r] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))]
        yield _hits(*merged(np.repeat(key[r], many), spot + np.repeat(s, many), spot + np.repeat(e, many)))

    def run(batches):
        held, size = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            size += b.column(6).nbytes
            if size >= SHARD_BYTES:
                t = pa.Table.from_batches(held)
                context = t["context"].to_numpy()
                whole = int(np.searchsorted(context, context[-1]))      # the last group may go on
                if whole:
                    yield from settle(t.slice(0, whole))
                    held = t.slice(whole).combine_chunks().to_batches()
                    size = sum(x.column(6).nbytes for x in held)
        if held:
            yield from settle(pa.Table.from_batches(held))

    return run


def _remove(remover):
    def run(batches):
        for b in batches:
            out = []
            for key, text, spans in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
                out.append(remover(text.as_buffer(), [(s["start"], s["end"]) for s in spans or ()]))
            n = b.num_columns
            cols = list(zip(*out, strict=True)) if out else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([*b.columns[3:n], pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.binary())],
                                             names=[*b.schema.names[3:n], "n_units", "n_removed", "n_spans", "kept"])
    return run


def remove_repeats(docs: DataFrame, doc_id: str, text: str, keep: list[str], *, length: int, parse, cutter, resolve, remover, name: str) -> DataFrame:
    """The ``keep`` columns of every document with n_units, n_removed, n_spans and the kept text.

    Rows are told apart by (id, text): equal rows have equal marks.  A null id is smaller than
    every other id.
    """
    spark = docs.sparkSession
    S.prepare(spark)
    doc = F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(-(1 << 63)))
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    # a bucket's phrases are held by one task: their number follows the bytes, not the settings
    size = docs.agg(F.coalesce(F.sum(F.octet_length(body)), F.lit(0)).alias("b")).first()["b"]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))

    src = docs.select(doc.alias("doc"), F.xxhash64(doc, body).alias("key"), F.encode(body, "UTF-8").alias("text"))
    packed = src.mapInArrow(_parse_batches(parse, length, buckets), "bucket int, kind byte, payload binary")
    met = S.table(packed.repartitionById(buckets, F.col("bucket")).select("kind", "payload").mapInArrow(_meet(length), MEET_SCHEMA), f"{name}-phrases")

    todo = met.filter(F.col("windows").isNotNull()).groupBy("key").agg(F.collect_list(F.struct("doc", "windows", "positions")).alias("phrases"))
    texts = src.select("key", "text").join(todo, "key")     # a repeated row only repeats its marks
    found = (texts.select("key", "text", "phrases").mapInArrow(_cut(cutter), CUT_SCHEMA)
             .repartition("context").sortWithinPartitions("context").mapInArrow(_resolve(resolve, length), HIT_SCHEMA))
    found = S.table(found, f"{name}-marks")

    marks = met.filter(F.col("start").isNotNull()).select("key", "start", "end").unionByName(found)
    spans = marks.groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("_spans_"))
    columns = [F.col(f"`{c}`") for c in keep if c not in ("n_units", "n_removed", "n_spans", "kept")]
    whole = docs.select(F.xxhash64(doc, body).alias("_key_"), F.encode(body, "UTF-8").alias("_text_"), *columns)
    joined = whole.join(spans.withColumnRenamed("key", "_key_"), "_key_", "left").select("_key_", "_text_", "_spans_", *columns)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema), "n_units long, n_removed long, n_spans long, kept binary"])
    return joined.mapInArrow(_remove(remover), schema)


def disjoint(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted maximal runs that the spans cover; runs that touch are one."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out
