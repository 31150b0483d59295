"""op12: sets of paragraphs by plain Python, sketches and peeling, neighbours, the defined results."""

import collections
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tidecast.llm import fingerprints as P

COLUMNS = ["doc_id", "n_chars", "edited_sha256", "near_edited", "near_next"]


def md5_60(x):
    return int(hashlib.md5(x.encode()).hexdigest()[:15], 16)


def elements(text):
    pars = []
    for line in text.split("\n"):
        pars += [line] if len(line) <= 400 else re.sub("([.!?]) ([A-C])", "\\1\n\\2", line).split("\n")
    return {md5_60(p) if n == 1 else md5_60(f"{md5_60(p)}:{n}") for p, n in collections.Counter(p for p in pars if p).items()}


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(docs):
    docs = sorted(((i, t or "") for i, t in docs), key=lambda d: (d[0] is not None, d[0] or 0, d[1].encode()))
    for k, (i, text) in enumerate(docs):
        following = docs[(k + 1) % len(docs)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        yield i, len(text), hashlib.sha256(edited.encode()).hexdigest(), likeness(elements(text), elements(edited)), likeness(elements(text), elements(following))


def frame(spark, docs, parts=3):
    return spark.createDataFrame([(i, t, 3, "e", True, 1) for i, t in docs], "doc_id long, text string, bucket int, e string, ends boolean, row int").repartition(parts)


def results(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def prose(rnd, lines, words=12, size=300):
    return "\n".join(" ".join(rnd.choice(["é", "w", "ß"]) + str(rnd.randrange(size)) for _ in range(rnd.randrange(1, words))) + rnd.choice([".", ". ", "", "! x. ", "! Ab. Cd "]) * 3 for _ in range(lines))


@pytest.mark.parametrize("bucket_chars", [32_000_000, 3_000])
def test_whole_query(spark, bucket_chars):
    rnd = random.Random(1)
    docs = [(rnd.randrange(10 ** 12), prose(rnd, rnd.randrange(1, 40))) for _ in range(60)]
    docs += [(5, "a\na\na\n\nb"), (6, "a\na\nb"), (7, None), (8, ""), (9, "\n\n"), (10, "one line " * 60 + ". " + "two! " * 90), (11, "😀" * 7)]
    docs += [(12, docs[0][1]), (13, docs[0][1]), (13, "z"), (13, "y"), (None, "no id"), (None, None), docs[3]]
    assert results(P.fingerprints(frame(spark, docs), bucket_chars)) == sorted(expected(docs), key=str)


def test_large_differences_are_retried_until_exact(spark):
    """Long documents without a common paragraph, and long ones that differ in a few."""
    rnd = random.Random(2)
    long = prose(rnd, 4_000, size=10 ** 6)
    docs = [(1, long), (2, prose(rnd, 3_000, size=10 ** 6)), (3, long + "\nmore\nstill more"), (4, long), (5, "short"), (6, "p\n" * 200_000 + long)]
    assert results(P.fingerprints(frame(spark, docs))) == sorted(expected(docs), key=str)


def test_equal_texts_have_equal_fingerprints_and_others_not(spark):
    rnd = random.Random(3)
    docs = [(i, prose(random.Random(i % 20), 5)) for i in range(60)]
    got = {r["doc_id"]: r for r in P.fingerprints(frame(spark, docs), 2_000).collect()}
    assert all(got[i]["fingerprint"] == got[i % 20]["fingerprint"] for i in range(60)) and len({r["fingerprint"] for r in got.values()}) == 20


def test_peeling_recovers_the_differing_digests(spark):
    rnd = random.Random(4)
    same = [rnd.randrange(1 << 60) for _ in range(500)]
    rows = []
    for d in (0, 1, 3, 6, 9, 200):
        a, b = [rnd.randrange(1 << 60) for _ in range(d)], [rnd.randrange(1 << 60) for _ in range(d // 2)]
        rows.append((d, same + a, same + b, sorted([(k, 1) for k in a] + [(k, -1) for k in b])))
    df = spark.createDataFrame([r[:3] for r in rows], "d int, a array<long>, b array<long>")
    got = {r["d"]: r["found"] for r in df.select("d", P.difference(F.col("a"), F.col("b"), P.sketch(F.col("a")), P.sketch(F.col("b")), 6).alias("found")).collect()}
    for d, _, _, want in rows:
        assert sorted((x["k"], x["n"]) for x in got[d]) == want
    small = df.select("d", P.peeled(P.subtract(P.sketch(F.col("a")), P.sketch(F.col("b")))).alias("found")).collect()
    assert {r["d"] for r in small if r["found"] is None} >= {200} and {r["d"] for r in small if r["found"] is not None} >= {0, 1}


def test_one_document_and_none(spark):
    assert results(P.fingerprints(frame(spark, [(4, "abcd\nxy")]))) == sorted(expected([(4, "abcd\nxy")]))
    assert results(P.fingerprints(frame(spark, []))) == []


def test_no_python_in_the_plan(spark):
    for df in (P.fingerprints(frame(spark, [(1, "a\nb"), (2, "c")])),):
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())
