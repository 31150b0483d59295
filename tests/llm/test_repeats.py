"""op4 and op10 against brute force: every window that also starts in a smaller document."""

import hashlib
import random
import re

import numpy as np
import pytest

from tidecast.llm import _repeats, substring_dedup, suffix_dedup

SCHEMA = "doc_id long, text string, n_units string, key string, spans string, row int"


def table(spark, rows, path):
    """documents with clashing further columns, as Parquet."""
    full = [(i, t, "x", "k", "s", 7) for i, t in rows]
    spark.createDataFrame(full, SCHEMA).repartition(4).write.parquet(f"{path}/documents.parquet")
    return str(path)


def brute_bytes(rows, n=50):
    docs = [(i, (t or "").encode()) for i, t in rows]
    low = lambda i: -1 << 63 if i is None else i
    first, out = {}, []
    for i, b in sorted(docs, key=lambda d: low(d[0])):
        for p in range(len(b) - n + 1):
            first.setdefault(b[p:p + n], low(i))
    for i, b in docs:
        gone = bytearray(len(b))
        for p in range(len(b) - n + 1):
            if first[b[p:p + n]] < low(i):
                gone[p:p + n] = b"\1" * n
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


def brute_words(rows, n=50):
    docs = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    low = lambda i: -1 << 63 if i is None else i
    first, out = {}, []
    for i, w in sorted(docs, key=lambda d: low(d[0])):
        for p in range(len(w) - n + 1):
            first.setdefault(tuple(w[p:p + n]), low(i))
    for i, w in docs:
        gone = [0] * len(w)
        for p in range(len(w) - n + 1):
            if first[tuple(w[p:p + n])] < low(i):
                gone[p:p + n] = [1] * n
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((i, len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def fuzz(seed, n=150):
    rnd = random.Random(seed)
    pool = ["".join(rnd.choice("ab ") for _ in range(300)) for _ in range(2)]
    pool += [" ".join(rnd.choice(["x", "y", "the", "ü"]) for _ in range(200)) for _ in range(3)]
    pool += ["of " * 200, "ab" * 150, "a" * 400, " ".join(f"w{rnd.randrange(10**6)}" for _ in range(120))]
    rows = []
    for i in range(n):
        t = ""
        for _ in range(rnd.randrange(0, 6)):
            p = rnd.choice(pool)
            a = rnd.randrange(len(p))
            t += p[a:rnd.randrange(a, len(p) + 1)] + rnd.choice(["", " ", "\n", " ", "é"])
        rows.append((rnd.randrange(n // 2) if i % 3 else i + 1000, t if i % 17 else None))
    long = " ".join(f"v{rnd.randrange(500)}" for _ in range(9000))
    return [*rows, *rows[:5], (None, pool[3]), (None, pool[3]), (5000, ""), (5001, long), (5002, long[20000:41000] + " end")]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("query, brute", [(suffix_dedup.op4_suffix_dedup, brute_bytes), (substring_dedup.op10_substring_dedup, brute_words)])
def test_rows_equal_brute_force(spark, tmp_path, query, brute, seed):
    rows = fuzz(seed)
    got = [tuple(r) for r in query(spark, table(spark, rows, tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)
    assert sum(r[2] for r in got) > 1000


@pytest.mark.parametrize("query", [suffix_dedup.op4_suffix_dedup, substring_dedup.op10_substring_dedup])
def test_empty_table(spark, tmp_path, query):
    got = query(spark, table(spark, [], tmp_path))
    assert got.collect() == [] and got.columns[0] == "doc_id"


def test_operator_keeps_columns_and_text(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, passage, "a"), (2, f"start {passage} end", "b")], "doc_id long, text string, lang string")
    got = {r["lang"]: r for r in substring_dedup.remove_repeated_words(docs).collect()}
    assert bytes(got["a"]["kept"]).decode() == passage and bytes(got["b"]["kept"]) == b"start end"
    assert got["b"]["n_spans"] == 1 and got["b"]["doc_id"] == 2


def test_one_large_group_of_copies_and_a_common_line(spark, tmp_path):
    line = " ".join(f"w{i}" for i in range(55))
    rows = [(i, line) for i in range(300)] + [(1000 + i, f"x{i} y{i} {line} z{i}") for i in range(300)]
    got = {r[0]: r for r in substring_dedup.op10_substring_dedup(spark, table(spark, rows, tmp_path)).collect()}
    assert got[0]["n_removed"] == 0 and all(got[i]["n_removed"] == 55 for i in [*range(1, 300), *range(1000, 1300)])


def test_run_length_index_matches_naive_suffix_order():
    rnd = random.Random(4)
    strings = list({"".join(rnd.choice("ab") for _ in range(rnd.randrange(1, 40))).encode() for _ in range(60)})
    index = suffix_dedup.RunLengthIndex(strings, 5)
    text = b"".join(s + b"\0" for s in strings)
    naive = sorted(range(len(text)), key=lambda i: text[i:])
    assert index.order.tolist() == naive
    bwt = bytes(text[i - 1] for i in naive)
    heads = [i for i in range(len(bwt)) if not i or bwt[i] != bwt[i - 1]]
    assert index.head.tolist() == heads
    assert index.sample.tolist() == [naive[(heads + [len(bwt)])[k + 1] - 1] for k in range(len(heads))]
    low = np.array([rnd.randrange(100) for _ in strings])
    best = index.first_documents(low)
    seen = 0
    for who, place, of_class in index.stream(5):
        for w, p, c in zip(who.tolist(), place.tolist(), of_class.tolist(), strict=True):
            key = strings[w][p:p + 5]
            assert best[c] == min(d for s, d in zip(strings, low.tolist(), strict=True) if key in s)
            seen += 1
    assert seen == sum(max(0, len(s) - 4) for s in strings)


def test_recompression_names_equal_passages_alike():
    rnd = random.Random(2)
    inner = np.array([rnd.randrange(1, 40) for _ in range(80)], np.uint64)
    sets = []
    for _ in range(20):
        left = np.array([rnd.randrange(1, 40) for _ in range(rnd.randrange(60))], np.uint64)
        names = np.concatenate([left, inner, left[::-1]])
        s, e, name = substring_dedup.recompress(names, np.zeros(len(names), np.int64))
        inside = (s >= len(left) + substring_dedup.REACH) & (e <= len(left) + 80 - substring_dedup.REACH)
        sets.append([(a - len(left), b - len(left), n) for a, b, n in zip(s[inside].tolist(), e[inside].tolist(), name[inside].tolist(), strict=True)])
        assert (e - s).max() <= substring_dedup.PAIR[1] and len(s) < len(names)
    assert all(x == sets[0] for x in sets) and sets[0]


def test_pack_round_trip():
    rnd = np.random.RandomState(1)
    row = np.sort(rnd.randint(0, 9, 200))
    p = {"at": np.concatenate([np.sort(rnd.randint(0, 90_000, n)) for n in np.unique(row, return_counts=True)[1]]), "windows": rnd.randint(1, 31, 200),
         "anchor": rnd.randint(0, 1 << 62, 200).astype(np.uint64), "content": rnd.randint(0, 1 << 62, 200).astype(np.uint64)}
    doc, key = rnd.randint(0, 99, 9), rnd.randint(0, 99, 9)
    got = _repeats.unpack(_repeats.pack(doc, key, row, p))
    assert got["doc"].tolist() == doc[row].tolist() and got["key"].tolist() == key[row].tolist()
    assert all(got[c].tolist() == p[c].tolist() for c in p)
