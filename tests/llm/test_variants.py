"""op13: brute force over all pairs, oversized groups, root chains, the defined results."""

import collections
import random
import re
import zlib

import pytest

from tidecast.llm import variants as V

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(vocab, ratio=10):
    out = {}
    for w, n in vocab.items():
        others = sorted(((-m, v) for v, m in vocab.items() if near(w, v)))
        form = others[0][1] if others and -others[0][0] >= ratio * n else None
        out[w] = [w, form, w, n, len(others), vocab[form] if form else None]
    for w, row in out.items():
        while out[row[2]][1]:
            row[2] = out[row[2]][1]
    return sorted(tuple(r) for r in out.values())


def words_of(docs):
    count = collections.Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                p = h % len(run)
                run = run[:p] + run[p + 1:]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}


def results(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def test_pairs_of_a_sorted_list():
    rnd = random.Random(3)
    for _ in range(300):
        size = rnd.randrange(1, 6)
        words = sorted({"".join(rnd.choice("abÿé") for _ in range(size + rnd.randrange(2))) for _ in range(rnd.randrange(1, 25))})
        want = [(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if near(a, b) and len(a) == size and (len(b) > size or i < j)]
        assert sorted(V.one_edit_pairs(words, size)) == sorted(want)


def vocabulary(rnd, n, alphabet="abcß", low=7, high=12):
    return {"".join(rnd.choice(alphabet) for _ in range(rnd.randrange(low, high))): int(10 ** (rnd.random() * 6)) + 2 for _ in range(n)}


@pytest.mark.parametrize("group_words", [2, 5, 256])
def test_every_pair_is_met_once(spark, group_words):
    rnd = random.Random(group_words)
    vocab = vocabulary(rnd, 150) | vocabulary(rnd, 150, "ab", 7, 9)
    vocab |= {"stem" * 6 + "".join(rnd.choice("abcd") for _ in range(rnd.randrange(4, 7))): rnd.randrange(2, 900) for _ in range(120)}     # one stem in many words
    vocab |= {"".join(rnd.choice("ab") for _ in range(rnd.randrange(4, 7))) + "ending" * 3: rnd.randrange(2, 900) for _ in range(60)}
    df = spark.createDataFrame(list(vocab.items()), "word string, n long")
    assert results(V.variants(df, group_words=group_words)) == brute(vocab)


def test_groups_are_small(spark):
    words = [("a" * 9 + x + y + z, 2) for x in "abcdefgh" for y in "abcdefgh" for z in "abcdefgh"]
    members = V.groups(spark.createDataFrame(words, "word string, n long"), 20)
    sizes = members.groupBy("length", "head", "tail").count().collect()
    assert max(r["count"] for r in sizes) <= 20 or all(r["length"] - len(r["head"]) - len(r["tail"]) == 1 for r in sizes if r["count"] > 20)


def test_roots_follow_long_chains(spark):
    vocab = {"abcdefg" + "x" * k: 10 ** (k + 1) for k in range(9)} | {"abcdefz": 1, "lonelyword": 3}
    got = {r["word"]: r["root"] for r in V.variants(spark.createDataFrame(list(vocab.items()), "word string, n long")).collect()}
    assert got == {w: r for w, _, r, *_ in brute(vocab)} and got["abcdefz"] == "abcdefgxxxxxxxx" and got["lonelyword"] == "lonelyword"


def docs_of(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "w", 1, "h") for i, t in rows], "doc_id long, text string, word string, n long, head string").repartition(parts)


def test_whole_query(spark):
    rnd = random.Random(11)
    base = ["Überraschung", "considération", "international", "committee", "received", "mañanas×÷", "ÀÉÎÕÜàéîõü"]

    def spoilt(w):
        i = rnd.randrange(len(w))
        return rnd.choice([w[:i] + w[i + 1:], w[:i] + "e" + w[i:], w[:i] + "é" + w[i + 1:], w, w, w, w, w, w, w, w, w])

    docs = [(i, " ".join(spoilt(rnd.choice(base)) for _ in range(90)) + rnd.choice([".", "\nshort", "1"])) for i in range(60)]
    docs += [(None, "Überraschung überraschung"), (70, None), (71, ""), (72, "a" * 300_000 + " " + "a" * 300_000), (73, "a" * 299_999 + " " + "a" * 299_999 + " " + "a" * 299_999), *docs[:5]]
    got = results(V.variants(V.vocabulary(V.damaged_words(docs_of(spark, docs)))))
    assert got == brute(words_of(docs))
    assert any(r[1] for r in got)


def test_empty_tables(spark):
    assert results(V.variants(V.vocabulary(V.damaged_words(docs_of(spark, []))))) == []
    assert results(V.variants(spark.createDataFrame([("justone", 5)], "word string, n long"))) == [("justone", None, "justone", 5, 0, None)]
