"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, in Spark expressions
alone (no Python in the tasks).

A text's paragraphs are its non-empty lines; a line of more than ``LONG_LINE`` code points is cut
before sentences that begin with A to C, about every sixth (the cuts depend on the words around them
alone, so an edit moves none elsewhere).  An element is a paragraph's digest with the number of its occurrences, so a
text is a set.  A sketch has three tables of ``CELLS`` cells; an element falls into one cell of each,
which counts its elements and holds the XOR of their digests and of their check values.  The
fingerprint is that sketch in hexadecimal.

Two sketches are subtracted cell by cell, which cancels what the versions share; a cell of one element
(its check value fits) is peeled: the element is recovered with its sign and leaves its other cells.
If cells remain, the difference is too large for the sketch and a larger one is tried: further bits of
the digest choose one of 4, 16, ... sketches of the same size, ``ROW_LEVELS`` times in the row
itself.  What is larger still is exploded, a sketch a row, so that a long document's sketches are
spread over the tasks, and only sketches that fail are split again.  So the recovered difference is
exact whatever its size, and the likeness is the Jaccard similarity of the two sets.

Neighbours in doc_id order meet by one shuffle: quantiles of doc_id bound buckets of about
``BUCKET_CHARS``; a bucket's first document is also sent to the bucket before.

Defined results: a null text is empty; two empty texts have equal fingerprints and likeness 1; the
edited text of a single document is made from itself; documents of one doc_id (or none: they come
first) follow by text; repeated documents get a row each; very long texts are whole; an empty table
gives no rows; further columns, of whatever name, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from . import _shared as S

LONG_LINE = 400
#: Cells of each of the three tables, a power of two.
CELLS = 16
TABLES = 3
ROUNDS = 16
#: Larger sketches tried in the row, each four times as large as the one before.
ROW_LEVELS = 1
BUCKET_CHARS = 4_000_000
MOST_BUCKETS = 65_536

_CELL_BITS = CELLS.bit_length() - 1
_ALL = CELLS * TABLES
_CELL = "struct<n:bigint,k:bigint,c:bigint>"
_FOUND = "array<struct<k:bigint,n:bigint>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def _number(items: Column) -> Column:
    """How many they are; null for null, whatever the session says of that."""
    return _let(items, lambda x: F.when(x.isNotNull(), F.size(x).cast("bigint")))


def _long(value) -> Column:
    return F.lit(value).cast("bigint")


# ---------------------------------------------------------------- elements

def paragraphs(text: Column) -> Column:
    """The paragraphs of a text, in order."""
    lines = F.filter(F.split(text, "\n"), lambda x: x != "")
    sentences = lambda x: F.filter(F.split(F.regexp_replace(x, "([.!?]) ([A-C])", "$1\n$2"), "\n"), lambda y: y != "")
    return F.flatten(F.transform(lines, lambda x: F.when(F.length(x) > LONG_LINE, sentences(x)).otherwise(F.array(x))))


def digest(text: Column) -> Column:
    """60 bits of the md5."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def elements(text: Column) -> Column:
    """The distinct elements (longs): a digest, or that of digest:occurrences if it occurs more often."""
    def counted(d: Column) -> Column:
        ends = F.filter(F.sequence(F.lit(0), F.size(d) - 1), lambda i: F.coalesce(F.get(d, i) != F.get(d, i + 1), F.lit(True)))
        return _let(ends, lambda e: F.transform(e, lambda i, j: _let(
            i - F.when(j == 0, -1).otherwise(F.get(e, j - 1)),
            lambda n: F.when(n == 1, F.get(d, i)).otherwise(digest(F.concat_ws(":", F.get(d, i).cast("string"), n.cast("string")))))))

    return _let(F.sort_array(F.transform(paragraphs(text), digest)),
                lambda d: F.when(F.size(d) == 0, F.array().cast("array<bigint>")).otherwise(counted(d)))


def check(k: Column) -> Column:
    """A value that the XOR of several digests fits by chance only once in 2^31."""
    return (F.shiftright(k, 30) * 1103515245 + k.bitwiseAND((1 << 30) - 1) * 998244353) % 2147483647


def _place(k: Column, table: int) -> Column:
    return F.shiftright(k, _CELL_BITS * table).bitwiseAND(CELLS - 1)


# ---------------------------------------------------------------- sketches

def _signed(elems: Column, sign: int = 1) -> Column:
    """Elements with their check value and sign, as a sketch takes them."""
    return F.transform(elems, lambda k: F.struct(k.alias("k"), check(k).alias("c"), _long(sign).alias("n")))


def _cells(items: Column) -> Column:
    """The cells of elements (k, c, n): each table sorts them by their place and sums the runs."""
    def table(t: int) -> Column:
        def runs(placed: Column) -> Column:
            def cells(up: Column, down: Column) -> Column:
                def cell(j: Column) -> Column:
                    begin = F.array_position(up, j)
                    size = F.size(up) - F.array_position(down, j) + 2 - begin
                    return F.when(begin > 0, _let(F.slice(placed, begin.cast("int"), size.cast("int")), summed)).otherwise(nothing)

                return F.transform(F.sequence(_long(0), _long(CELLS - 1)), cell)

            return _let(placed["i"], lambda up: _let(F.reverse(up), lambda down: cells(up, down)))

        return _let(F.sort_array(F.transform(items, lambda e: F.struct(_place(e["k"], t).alias("i"), e["k"].alias("k"), e["c"].alias("c"), e["n"].alias("n")))), runs)

    def summed(run: Column) -> Column:
        xor = lambda name: F.aggregate(run[name], _long(0), lambda a, x: a.bitwiseXOR(x))
        return F.when(F.size(run) == 1, F.struct(run["n"][0].alias("n"), run["k"][0].alias("k"), run["c"][0].alias("c"))).otherwise(
            F.struct(F.aggregate(run["n"], _long(0), lambda a, x: a + x).alias("n"), xor("k").alias("k"), xor("c").alias("c")))

    nothing = F.struct(_long(0).alias("n"), _long(0).alias("k"), _long(0).alias("c"))
    return F.concat(*(table(t) for t in range(TABLES)))


def sketch(elems: Column) -> Column:
    """The cells of the elements (longs)."""
    return _let(_signed(elems), _cells)


def as_text(cells: Column) -> Column:
    """A sketch as a string: count.digests.checks of each cell, nothing for an empty one."""
    number = lambda x: F.lower(F.hex(x))
    return F.array_join(F.transform(cells, lambda x: F.when(x["n"] == 0, "").otherwise(F.concat_ws(".", number(x["n"]), number(x["k"]), number(x["c"])))), ",")


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.struct((x["n"] - y["n"]).alias("n"), x["k"].bitwiseXOR(y["k"]).alias("k"), x["c"].bitwiseXOR(y["c"]).alias("c")))


def peeled(cells: Column) -> Column:
    """The recovered elements of a difference, with sign n (1: only in the first, -1: only in the
    second); null if the sketch was too small."""
    def pure(cells: Column) -> Column:
        good = F.filter(cells, lambda x: ((x["n"] == 1) | (x["n"] == -1)) & (check(x["k"]) == x["c"]))
        return F.array_distinct(F.transform(good, lambda x: F.struct(x["k"].alias("k"), x["c"].alias("c"), x["n"].alias("n"))))

    def turn(s: Column, _: Column) -> Column:
        def peel(ps: Column) -> Column:
            found = F.concat(s["found"], F.transform(ps, lambda p: F.struct(p["k"].alias("k"), p["n"].alias("n"))))
            return F.when(F.size(ps) == 0, F.struct(s["cells"].alias("cells"), s["found"].alias("found"), F.lit(False).alias("live"))).otherwise(
                F.struct(subtract(s["cells"], _cells(ps)).alias("cells"), found.alias("found"), F.lit(True).alias("live")))

        return F.when(s["live"], _let(pure(s["cells"]), peel)).otherwise(s)

    start = F.struct(cells.cast(f"array<{_CELL}>").alias("cells"), F.array().cast(_FOUND).alias("found"), F.lit(True).alias("live"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn,
                       lambda s: F.when(F.forall(s["cells"], lambda x: (x["n"] == 0) & (x["k"] == 0) & (x["c"] == 0)), s["found"]))


def _bucket(k: Column, level: int) -> Column:
    return F.shiftright(k, _CELL_BITS * TABLES).bitwiseAND((1 << (2 * level)) - 1)


def difference(a: Column, b: Column, cells_a: Column, cells_b: Column, levels: int = ROW_LEVELS) -> Column:
    """The elements in one of ``a`` and ``b`` only, recovered from their sketches and, where these
    are too small, from up to ``levels`` larger ones (a size is passed over if the sets together
    have more elements than it has cells); null if all were too small."""
    def larger(level: int) -> Column:
        def one(found: Column, i: Column) -> Column:
            # concat with null is null: after one failure the other parts are not looked at
            part = lambda e: F.filter(e, lambda k: _bucket(k, level) == i)
            return F.when(found.isNotNull(), F.concat(found, peeled(subtract(sketch(part(a)), sketch(part(b))))))

        return F.when(F.size(a) + F.size(b) <= TABLES * CELLS * 4 ** level,
                      F.aggregate(F.sequence(_long(0), _long(4 ** level - 1)), F.array().cast(_FOUND), one))

    return F.coalesce(peeled(subtract(cells_a, cells_b)), *(larger(n) for n in range(1, levels + 1)))


def likeness(size_a: Column, size_b: Column, differing: Column) -> Column:
    """Jaccard similarity from the sizes of two sets and of their difference."""
    both = size_a + size_b
    return F.when(both == 0, 1.0).otherwise((both - differing).cast("double") / (both + differing).cast("double"))


# ---------------------------------------------------------------- neighbours

def neighbours(docs: DataFrame, bucket_chars: int = BUCKET_CHARS):
    """(doc_id, text, ends, bucket) dealt by bucket, and the window in which the row after a document
    is the next one; a row with ``ends`` is the first of the next bucket (the first of all, behind
    the last)."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.length("text")).alias("chars"), F.min("doc_id").alias("low"), F.max(F.col("doc_id").isNull()).alias("nulls")).first()
    buckets = min(MOST_BUCKETS, max(1, math.ceil((size["chars"] or 0) / bucket_chars)))
    bounds: list[int] = []
    if buckets > 1 and size["low"] is not None:
        at = [k / buckets for k in range(1, buckets)]
        found = docs.agg(F.percentile_approx("doc_id", at, max(10_000, 10 * buckets)).alias("q")).first()["q"]
        bounds = sorted({q for q in found if q > size["low"]})
    # two steps of a search: among every step-th bound, then in the stretch behind it
    step = max(1, math.isqrt(len(bounds)))
    every = lambda values: F.lit(values) if values else F.array().cast("array<bigint>")
    passed = lambda values: F.coalesce(F.size(F.filter(values, lambda q: q <= F.col("doc_id"))), F.lit(0))
    docs = docs.withColumn("block", passed(every(bounds[::step])))
    stretch = F.slice(every(bounds), F.greatest((F.col("block") - 1) * step + 1, F.lit(1)), step)
    docs = docs.withColumn("bucket", F.when(F.col("block") == 0, 0).otherwise((F.col("block") - 1) * step + passed(stretch)))
    # bounds are ids that occur: a document at its bucket's bound also ends the bucket before
    first = F.col("doc_id").isNull() if size["nulls"] else F.col("doc_id") == F.lit(size["low"])
    ahead = F.when(first, len(bounds)).when((F.col("bucket") > 0) & (F.col("doc_id") == F.get(every(bounds), F.col("bucket") - 1)), F.col("bucket") - 1)
    places = F.filter(F.array(F.struct(F.lit(False).alias("ends"), F.col("bucket").alias("bucket")), F.struct(F.lit(True).alias("ends"), ahead.cast("int").alias("bucket"))), lambda p: p["bucket"].isNotNull())
    dealt = docs.select("doc_id", "text", F.explode(places).alias("p")).select("doc_id", "text", "p.ends", "p.bucket").repartition("bucket")
    order = Window.partitionBy("bucket").orderBy("ends", F.col("doc_id").asc_nulls_first(), "text")
    return dealt, order


def _halves(text: Column, following: Column) -> Column:
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def fingerprints(docs: DataFrame, bucket_chars: int = BUCKET_CHARS) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)."""
    dealt, order = neighbours(docs, bucket_chars)
    own = dealt.withColumn("e", elements(F.col("text"))).withColumn("s", sketch(F.col("e")))
    after = own.select("ends", "doc_id", "text", "e", "s", F.lead(F.struct("text", "e", "s")).over(order).alias("next")).filter("not ends")
    edited = (after.withColumn("edited", _halves(F.col("text"), F.col("next.text")))
              .withColumn("ee", elements(F.col("edited"))).withColumn("es", sketch(F.col("ee"))))
    found = edited.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("s")).alias("fingerprint"), as_text(F.col("es")).alias("edited_fingerprint"),
        F.col("e").alias("own"), F.array(F.col("ee"), F.col("next.e")).alias("others"),
        F.array(_number(difference(F.col("e"), F.col("ee"), F.col("s"), F.col("es"))), _number(difference(F.col("e"), F.col("next.e"), F.col("s"), F.col("next.s")))).alias("ds"))
    large = F.exists("ds", lambda x: x.isNull())
    empty = F.array().cast("array<bigint>")
    first = S.table(found.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        F.size("own").alias("n"), F.transform("others", F.size).alias("ns"), "ds",
        # the elements themselves only where a larger sketch is needed
        F.when(large, F.col("own")).otherwise(empty).alias("own"), F.when(large, F.col("others")).otherwise(F.array().cast("array<array<bigint>>")).alias("others")), "fingerprints")

    def result(rows: DataFrame) -> DataFrame:
        near = [likeness(F.col("n"), F.col("ns")[k], F.col("ds")[k]).alias(name) for k, name in enumerate(("near_edited", "near_next"))]
        return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", *near)

    retried = first.filter(large)
    sums = larger_differences(retried.select("row", F.posexplode("others").alias("which", "b"), "own", "ds").filter(F.get("ds", F.col("which")).isNull())
                              .select("row", "which", F.col("own").alias("a"), "b"))
    sums = sums.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("which", "differing"))).alias("more"))
    rest = retried.join(sums, "row").withColumn("ds", F.transform("ds", lambda x, i: F.coalesce(x, F.col("more")[i])))
    return result(first.filter(~large)).unionByName(result(rest))


def larger_differences(pairs: DataFrame, level: int = ROW_LEVELS + 1) -> DataFrame:
    """(row, which, differing): the size of the difference of the element sets ``a`` and ``b`` of each
    pair (row, which), by 4^level sketches in rows of their own, those that fail split by 16 again
    until none does."""
    done: list[DataFrame] = []
    rows, width = pairs, 4 ** level
    while True:
        # the elements once, each dealt to its part: no pass over the sets per part
        shift = _CELL_BITS * TABLES + (0 if not done else 2 * (level - 2))
        entry = lambda side, sign: F.transform(side, lambda k: F.struct(F.shiftright(k, shift).bitwiseAND(width - 1).alias("i"), k.alias("k"), F.lit(sign).alias("first")))
        exploded = rows.select("row", "which", *(["part"] if done else [F.lit(0).cast("bigint").alias("part")]), F.explode(F.concat(entry(F.col("a"), True), entry(F.col("b"), False))).alias("e"))
        side = lambda first: F.collect_list(F.when(F.col("e.first") == first, F.col("e.k")))
        parts = exploded.groupBy("row", "which", (F.col("part") * width + F.col("e.i")).alias("part")).agg(side(True).alias("a"), side(False).alias("b"))
        solved = S.table(parts.select(
            "row", "which", "part", "a", "b", _number(peeled(subtract(sketch(F.col("a")), sketch(F.col("b"))))).alias("d")), "fingerprint-differences")
        done.append(solved.filter("d is not null").select("row", "which", "d"))
        rows, width, level = solved.filter("d is null").select("row", "which", "part", "a", "b"), 16, level + 2
        if rows.isEmpty():
            return reduce(DataFrame.unionByName, done).groupBy("row", "which").agg(F.sum("d").alias("differing"))


def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


#: The sketches by grouping cells, the likeness from the sets themselves.
ORACLE_SQL = f"""
WITH docs AS (SELECT row_number() OVER w AS r, doc_id, coalesce(text, '') AS text, coalesce(lead(coalesce(text, '')) OVER w, first_value(coalesce(text, '')) OVER w) AS following
  FROM documents WINDOW w AS (ORDER BY doc_id NULLS FIRST, text ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
versions AS (SELECT r, 0 AS v, text FROM docs
  UNION ALL SELECT r, 1, left(text, length(text) - length(text) // 2) || left(following, length(text) // 2) FROM docs),
lines AS (SELECT r, v, unnest(string_split(text, chr(10))) AS line FROM versions),
pars AS (SELECT r, v, unnest(CASE WHEN length(line) > {LONG_LINE} THEN string_split(regexp_replace(line, '([.!?]) ([A-C])', '\\1' || chr(10) || '\\2', 'g'), chr(10)) ELSE [line] END) AS p FROM lines),
digests AS (SELECT r, v, ('0x' || left(md5(p), 15))::BIGINT AS d, count(*) AS times FROM pars WHERE p <> '' GROUP BY ALL),
elems AS MATERIALIZED (SELECT r, v, CASE WHEN times = 1 THEN d ELSE ('0x' || left(md5(d::VARCHAR || ':' || times::VARCHAR), 15))::BIGINT END AS k FROM digests),
cells AS (SELECT r, v, t * {CELLS} + ((k >> ({_CELL_BITS} * t)) & {CELLS - 1}) AS i, format('{{:x}}.{{:x}}.{{:x}}', count(*), bit_xor(k),
    bit_xor(((k >> 30) * 1103515245 + (k & {(1 << 30) - 1}) * 998244353) % 2147483647)) AS cell
  FROM elems, (SELECT unnest(range({TABLES}))::BIGINT AS t) GROUP BY ALL),
prints AS (SELECT r, v, string_agg(coalesce(cell, ''), ',' ORDER BY i) AS fingerprint
  FROM (SELECT r, v, unnest(range({_ALL})) AS i FROM versions) LEFT JOIN cells USING (r, v, i) GROUP BY r, v),
sizes AS (SELECT r, v, count(k) AS n FROM versions LEFT JOIN elems USING (r, v) GROUP BY r, v),
pairs AS (SELECT r, 1 AS v, r AS other FROM docs UNION ALL SELECT r, 0, r % (SELECT count(*) FROM docs) + 1 FROM docs),
shared AS (SELECT p.r, p.v, count(*) AS c FROM pairs p JOIN elems a ON a.r = p.r AND a.v = 0 JOIN elems b ON b.r = p.other AND b.v = p.v AND b.k = a.k GROUP BY ALL),
near AS (SELECT p.r, p.v, CASE WHEN a.n + b.n = 0 THEN 1 ELSE (2 * coalesce(c, 0))::DOUBLE / (2 * (a.n + b.n - coalesce(c, 0)))::DOUBLE END AS likeness
  FROM pairs p JOIN sizes a ON a.r = p.r AND a.v = 0 JOIN sizes b ON b.r = p.other AND b.v = p.v LEFT JOIN shared s ON s.r = p.r AND s.v = p.v)
SELECT doc_id, length(docs.text)::BIGINT AS n_chars, sha256(e.text) AS edited_sha256, p0.fingerprint, p1.fingerprint AS edited_fingerprint,
  n1.likeness AS near_edited, n0.likeness AS near_next
FROM docs JOIN versions e ON e.r = docs.r AND e.v = 1 JOIN prints p0 ON p0.r = docs.r AND p0.v = 0 JOIN prints p1 ON p1.r = docs.r AND p1.v = 1
JOIN near n0 ON n0.r = docs.r AND n0.v = 0 JOIN near n1 ON n1.r = docs.r AND n1.v = 1
"""
