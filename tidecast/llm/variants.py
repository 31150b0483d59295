"""Spelling variants: words one edit apart are found in sorted lists, and each word gets the form
that it is most likely a variant of.

Words are counted in Spark; the vocabulary (words of at least ``min_length`` code points and
``min_count`` occurrences) is grouped so that every pair one edit apart meets in exactly one group:
of the shorter word's halves one is untouched, so words meet under (length, first half) or (length,
last half), a pair whose first half is equal only under the first.  A group of more than
``group_words`` words is cut again by the halves of what is still unknown, until it is small or one
code point is left (then the alphabet bounds it), so that no common stem fills a task.

In a group the unknown middles are a sorted list, scanned once for all its words: the banded rows of
the edit matrix (three cells around the diagonal, capped at 2, so 27 rows in all and a table for the
step by one code point) are kept on a stack by depth; adjacent middles reuse the rows of their common
prefix, and a range is skipped where its shared prefix leaves no word within one edit.

``root`` follows the forms by pointer doubling; counts grow tenfold on the way, so there is no cycle.

Defined results: a null text has no words; a null doc_id counts as an empty text in the hash; words
are kept whole, however long; of near words with equal counts the smallest in code-point order is
the form; repeated documents count each time; an empty table gives no rows; further columns, of
whatever name, are ignored.
"""

from __future__ import annotations

import os
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import _shared as S, _sql

MIN_LENGTH = 7
MIN_COUNT = 2
#: A form occurs at least so many times as often as its variant.
RATIO = 10
#: Groups of more words are cut again.
GROUP_WORDS = 256
#: Every so many-th occurrence (by hash) loses a code point.
DAMAGE = 31

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# ---------------------------------------------------------------- banded rows

def _step(row: tuple[int, int, int], before: bool, at: bool, after: bool) -> tuple[int, int, int]:
    """The next banded row; the flags say whether the code point equals the word's one before,
    at and after the diagonal."""
    x, y, z = row
    a = min(x + (not before), y + 1)
    b = min(y + (not at), z + 1, a + 1)
    c = min(z + (not after), b + 1)
    return min(a, 2), min(b, 2), min(c, 2)


_ROWS = [(x, y, z) for x in range(3) for y in range(3) for z in range(3)]
_START = _ROWS.index((2, 0, 1))
#: [row][flags] -> the next row, or -1 if no cell is within one edit.
_STEP = [[_ROWS.index(r) if min(r := _step(row, bool(m & 1), bool(m & 2), bool(m & 4))) < 2 else -1 for m in range(8)] for row in _ROWS]
_SAME_LENGTH = [row[1] == 1 for row in _ROWS]
_ONE_LONGER = [row[0] == 1 for row in _ROWS]


def one_edit_pairs(words: list[str], length: int):
    """Yield (i, j): ``words[i]`` of ``length`` and ``words[j]`` of ``length`` (j > i) or one more,
    exactly one edit apart.  ``words`` are sorted and distinct, of these two lengths."""
    stack = [[(i, _START, f"\0{w}\0\0") for i, w in enumerate(words) if len(w) == length]]
    before, dead = "", None
    for j, word in enumerate(words):
        shared = len(os.path.commonprefix((before, word)))
        before = word
        if dead is not None and shared >= dead:
            continue        # in a range whose prefix is beyond one edit of every word
        dead = None
        depth = min(shared, len(stack) - 1)
        del stack[depth + 1:]
        while depth < len(word):
            c, row = word[depth], []
            for i, state, text in stack[depth]:
                to = _STEP[state][(text[depth] == c) + 2 * (text[depth + 1] == c) + 4 * (text[depth + 2] == c)]
                if to >= 0:
                    row.append((i, to, text))
            depth += 1
            if not row:
                dead = depth
                break
            stack.append(row)
        else:
            longer = len(word) > length
            good = _ONE_LONGER if longer else _SAME_LENGTH
            for i, state, _ in stack[depth]:
                if good[state] and (longer or i < j):
                    yield i, j


# ---------------------------------------------------------------- words and groups

def runs(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(doc_id, run): the lower-cased maximal runs of at least ``min_length`` letters; a shorter
    one can not give a word."""
    low = F.translate("text", _UPPER, _LOWER)
    return docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
                       F.explode(F.regexp_extract_all(low, F.lit(f"[a-zÀ-ÿ]{{{min_length},}}"), F.lit(0))).alias("run"))


def damaged_words(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(word): each run's word; by the hash of its document and itself one in 31 loses a code point."""
    hashed = runs(docs, min_length).select("run", F.crc32(F.concat("doc_id", F.lit(":"), "run")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return hashed.select(F.when(F.col("h") % DAMAGE == 0, cut).otherwise(F.col("run")).alias("word")).filter(F.length("word") >= min_length)


def vocabulary(words: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n)."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def _unknown() -> Column:
    """Code points of the shorter words' middles in a row's group."""
    return F.col("length") - F.length("head") - F.length("tail")


def _halved(members: DataFrame) -> DataFrame:
    """Every member under the first half of its middle and under the last."""
    half = F.floor(_unknown() / 2).cast("int")
    rest = (_unknown() - half).cast("int")
    size = F.length("mid")
    first = F.struct(F.concat("head", F.substring("mid", F.lit(1), half)).alias("head"), F.substring("mid", half + 1, size).alias("mid"), F.col("tail").alias("tail"))
    last = F.struct(F.col("head").alias("head"), F.substring("mid", F.lit(1), size - rest).alias("mid"), F.concat(F.substring("mid", size - rest + 1, size), F.col("tail")).alias("tail"))
    return members.select("length", "n", F.explode(F.array(first, last)).alias("g")).select("length", "g.head", "g.tail", "g.mid", "n")


def groups(vocab: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """(length, head, tail, mid, n): the words as members of groups (length, head, tail); ``length``
    is that of the shorter words, whose pairs with words as long or one longer meet here."""
    least = vocab.agg(F.min(F.length("word"))).first()[0] or 0
    size = F.length("word")
    whole = vocab.select(F.explode(F.when(size > least, F.array(size, size - 1)).otherwise(F.array(size))).alias("length"),
                         F.lit("").alias("head"), F.lit("").alias("tail"), F.col("word").alias("mid"), "n")
    key = ["length", "head", "tail"]
    members, done = S.table(_halved(whole), "variant-members"), []
    while True:
        large = S.table(members.filter(_unknown() >= 2).groupBy(*key).agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > group_words).select(*key), "variant-large")
        if large.isEmpty():
            return reduce(DataFrame.unionByName, [*done, members])
        done.append(members.join(large, key, "left_anti").select(*members.columns))
        members = S.table(_halved(members.join(large, key, "left_semi")), "variant-members")


_FOUND = "word string, n long, n_near long, best_n long, best string"


def _scan(batches):
    """The near words of every group: their number and the best one, a row a word of the group."""
    key, mids, counts, length = None, [], [], 0
    out: list[dict] = []

    def close():
        if len(mids) < 2:
            return
        head, tail = key[1:]
        near: dict[int, list[int]] = {}
        for i, j in one_edit_pairs(mids, length):
            if tail and len(mids[j]) > length and mids[j].startswith(mids[i]):
                continue        # the first half is untouched too: the pair is met under it
            for a, b in ((i, j), (j, i)):
                found = near.setdefault(a, [0, b])
                found[0] += 1
                if b != found[1] and (-counts[b], mids[b] + tail) < (-counts[found[1]], mids[found[1]] + tail):
                    found[1] = b
        for a, (number, b) in near.items():
            out.append({"word": head + mids[a] + tail, "n": counts[a], "n_near": number, "best_n": counts[b], "best": head + mids[b] + tail})

    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])
    for batch in batches:
        for size, head, tail, mid, n in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
            if (size, head, tail) != key:
                close()
                key, mids, counts, length = (size, head, tail), [], [], size - len(head) - len(tail)
                if len(out) >= 20_000:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out = []
            mids.append(mid)
            counts.append(n)
    close()
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def near_words(vocab: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """(word, n, n_near, best_n, best) of every word of ``vocab``; best is its most frequent near
    word (null if there is none)."""
    S.prepare(vocab.sparkSession)
    vocab = S.table(vocab, "variant-vocabulary")
    members = groups(vocab, group_words).repartition("length", "head", "tail").sortWithinPartitions("length", "head", "tail", "mid")
    found = members.mapInArrow(_scan, _FOUND)
    alone = vocab.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("best_n"), F.lit(None).cast("string").alias("best"))
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))))
    return (found.unionByName(alone).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("b"))
            .select("word", "n", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best")))


def variants(vocab: DataFrame, ratio: int = RATIO, group_words: int = GROUP_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``vocab`` (word, n)."""
    form = F.col("best_n") >= ratio * F.col("n")
    words = S.table(near_words(vocab, group_words).select(
        "word", F.when(form, F.col("best")).alias("form"), "n", "n_near", F.when(form, F.col("best_n")).alias("form_n")), "variant-forms")
    links = words.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:
        # a root that has a form itself: twice as far on the way each round
        links = S.table(links, "variant-roots")
        on = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if links.join(on, "root", "left_semi").isEmpty():
            break
        links = links.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
    return words.join(links, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    S.prepare(spark)
    return variants(vocabulary(damaged_words(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))))


#: The same with pairs from equal rests after one deletion, at any place (shorter word) or at one
#: place (replacement), and the roots by recursion.
ORACLE_SQL = f"""
WITH RECURSIVE {_sql.CRC_TABLE},
runs AS (SELECT doc_id, run, count(*) AS times FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[a-z\\x{{00C0}}-\\x{{00FF}}]{{7,}}')) AS run FROM documents) GROUP BY ALL),
hashed AS (SELECT run, times, {_sql.crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM runs, crc),
vocab AS MATERIALIZED (SELECT word, sum(times)::BIGINT AS n FROM (
    SELECT times, CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
rests AS MATERIALIZED (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM vocab)),
pairs AS (SELECT a.word, b.word AS other, b.n FROM rests a JOIN rests b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT r.word, v.word, v.n FROM rests r JOIN vocab v ON r.rest = v.word
  UNION SELECT v.word, r.word, r.n FROM rests r JOIN vocab v ON r.rest = v.word),
best AS (SELECT word, count(*) AS n_near, min({{'n': -n, 'w': other}}) AS b FROM pairs GROUP BY word),
forms AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.n >= 10 * v.n THEN b.w END AS form, CASE WHEN -b.n >= 10 * v.n THEN -b.n END AS form_n
  FROM vocab v LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS root FROM forms UNION ALL SELECT w.word, f.form FROM walk w JOIN forms f ON f.word = w.root AND f.form IS NOT NULL),
roots AS (SELECT w.word, w.root FROM walk w JOIN forms f ON f.word = w.root WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""
