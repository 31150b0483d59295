"""Near-duplicate documents by Order MinHash, verified by banded alignment.

Words are those of ``decontaminate`` (lower-cased, runs of digits, letters, non-ASCII).  A
document is the sequence of its 5-word shingles (one shingle of all words if it has fewer), each
labelled with its occurrence number.  Each of ``SKETCHES`` hash functions selects the ``MINIMA``
labelled shingles with the smallest hashes and keeps their text order; two documents meet where
one function selects the same shingles in the same order, which gets likely with their edit
similarity and not only with their common words.

Documents that meet are compared by the alignment of their shingle sequences: the longest
common subsequence A inside a band around the diagonal that holds every alignment of the
threshold, similarity A / (n + m - A).  At 0.8 and above they are linked; the classes are the
connected components of the links.

Texts with equal words are one node of that graph, so copies cost one row each.  In a bucket
every node is compared with two leaders, the smallest and the largest node by a hash of bucket
and node, unless they are in one component already; then the leaders leave.  While a bucket has
several components its nodes stay, linked or not (different texts around one template).  They are
joined by their rarest shingles, an exact prefix filter (``candidates``), and compared with all
they can be similar to: further leaders would compare every node twice more in each bucket and link
few.  So the classes are those of all pairs that share a bucket.

Defined results: a document without words (null, empty, signs only) is a class of its own
doc_id; repeated rows and copies are one class; a class id is its smallest doc_id (null ids count
as smaller than all and give a null class id); an empty table gives no rows; other columns are
kept (``with_class``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyarrow.compute import take
from pyspark.sql import DataFrame, Window, functions as F

from . import _repeats as R, _shared as S
from .decontaminate import Words

SHINGLE, SIMILARITY = 5, 0.8
#: A pair of similarity J meets in one sketch with about J^MINIMA: at 0.8 all 16 miss it with
#: a probability below 1e-7.
SKETCHES, MINIMA = 16, 2
#: Groups of shingles whose numbers order them from rare to common; few groups order them less
#: well, which costs candidates and no links.
SLOTS = 1 << 18
#: Parity bits of a text's labelled shingles: two texts differ in at least as many shingles as in bits.
PARITY = 512

_SLACK = 1e-6   # against rounding, in shingles
_LOW = np.uint64((1 << 32) - 1)
_NULL = -(1 << 63)


def shingles(w: Words, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first shingle of each row) of the chunk's shingles."""
    first, last = w.row[:-1], w.row[1:]
    size = last - first
    count = np.where(size >= n, size - n + 1, (size > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(count)])
    row = np.repeat(np.arange(len(size)), count)
    at = first[row] + np.arange(bounds[-1]) - bounds[row]
    return S.span_hash(w.sums, at, np.minimum(at + n, last[row])), bounds


def labelled(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Hashes of the shingles with their occurrence number in the row."""
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)).astype(np.uint64)
    own = h ^ S.mix(row + np.uint64(1))
    o = np.argsort(own, kind="stable")
    new = R.group_starts(own[o])
    at = np.arange(len(o))
    nth = np.empty(len(o), np.uint64)
    nth[o] = at - np.maximum.accumulate(np.where(new, at, 0))
    return S.mix(h + nth * np.uint64(0x9E3779B97F4A7C15))


def sketch(h: np.ndarray, bounds: np.ndarray, sketches: int = SKETCHES, minima: int = MINIMA) -> np.ndarray:
    """(rows with shingles, sketches) bucket keys: per function the hash of the chosen labelled
    shingles in text order."""
    some = np.flatnonzero(np.diff(bounds))
    out = np.zeros((len(bounds) - 1, sketches), np.uint64)
    if not len(some):
        return out
    names = labelled(h, bounds)
    cut = bounds[some]
    place = np.arange(len(names), dtype=np.uint64)
    full = np.uint64((1 << 64) - 1)
    for f in range(sketches):
        v = (S.mix(names ^ np.uint64(0xA0761D6478BD642F * (f + 1) % (1 << 64))) & ~_LOW) | place
        chosen = []
        for _ in range(minima):
            low = np.minimum.reduceat(v, cut)
            chosen.append(low)
            v[(low[low != full] & _LOW).astype(np.int64)] = full
        spot = np.sort(np.stack([np.where(c == full, full, c & _LOW) for c in chosen]), axis=0)
        key = np.full(len(some), np.uint64(f + 1))
        for s in spot:      # a row with fewer shingles chooses fewer
            has = s != full
            key[has] = S.mix(key[has] * np.uint64(0xE7037ED1A0B428DB) + names[s[has].astype(np.int64)])
        out[some, f] = key
    return out


# ---------------------------------------------------------------- alignment

def banded_lcs(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Longest common subsequence whose matched places differ by at most ``band``, with one
    machine-word-parallel step per element of ``a``."""
    at: dict[int, list[int]] = {}
    for j, x in enumerate(b.tolist()):
        at.setdefault(x, []).append(j)
    m = len(b)
    full = (1 << m) - 1
    state = full
    for i, x in enumerate(a.tolist()):
        match = 0
        for j in at.get(x, ()):
            if -band <= j - i <= band:
                match |= 1 << j
        if match:
            u = state & match
            state = ((state + u) | (state - u)) & full
    return m - state.bit_count()


def aligned(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Similarity of two shingle sequences; exact where it is at least ``least``, else below it.

    The common labelled shingles bound the alignment from above, which rejects most pairs; if
    their places ascend in both, they are the alignment."""
    n, m = len(a), len(b)
    if not n or not m:
        return 0.0
    la, lb = (labelled(x, np.array([0, len(x)])) for x in (a, b))
    _, ia, ib = np.intersect1d(la, lb, assume_unique=True, return_indices=True)
    common = len(ia)
    best = common / (n + m - common)
    if best < least:
        return best
    o = np.argsort(ia)
    if not (np.diff(ib[o]) < 0).any():
        return best
    band = int((n + m) * (1 - least) / (1 + least)) + 1
    # equal ends are aligned as they are
    k = min(n, m)
    differ = np.flatnonzero(a[:k] != b[:k])
    head = int(differ[0]) if len(differ) else k
    differ = np.flatnonzero(a[head:][::-1][:k - head] != b[head:][::-1][:k - head])
    tail = int(differ[0]) if len(differ) else k - head
    got = head + tail + banded_lcs(a[head:n - tail], b[head:m - tail], band)
    return got / (n + m - got)


# ---------------------------------------------------------------- Spark

def _source(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(*_keys(doc_id, text), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))


def _keys(doc_id: str, text: str) -> list:
    """Id and text hash of a row: rows that share both are equal."""
    return [F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(_NULL)).alias("doc"), F.xxhash64(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))).alias("row")]


def _node(w: Words) -> np.ndarray:
    """Hash of all words of each row, 0 for none."""
    first, last = w.row[:-1], w.row[1:]
    return np.where(last > first, S.span_hash(w.sums, first, last), np.uint64(0))


def sketches(src: DataFrame) -> DataFrame:
    """(doc, row, node, keys) of every row; node 0 without words."""

    def run(batches):
        for b in batches:
            for i, j, off, data in S.chunks(b.column(2)):
                w = Words(off, data)
                h, bounds = shingles(w)
                node = S.signed(_node(w))
                keys = S.signed(sketch(h, bounds))
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(node) + 1, dtype=np.int32) * SKETCHES), pa.array(keys.reshape(-1)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), pa.array(node), flat], names=["doc", "row", "node", "keys"])

    return src.mapInArrow(run, "doc long, row long, node long, keys array<long>")


def _texts(src: DataFrame) -> DataFrame:
    """(node, text) of every row with words."""

    def run(batches):
        for b in batches:
            for i, j, off, data in S.chunks(b.column(0)):
                node = S.signed(_node(Words(off, data)))
                yield pa.RecordBatch.from_arrays([pa.array(node), b.column(0).slice(i, j - i)], names=["node", "text"])

    return src.select("text").mapInArrow(run, "node long, text string").filter("node != 0")


def _verify(pairs: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b, text_a, text_b) of at least that similarity."""

    def run(batches):
        last, seq = None, None
        for b in batches:
            out = []
            left, right = b.column(0).to_pylist(), b.column(1).to_pylist()
            texts_a, texts_b = b.column(2), b.column(3)
            for i in range(len(left)):
                if left[i] != last:
                    last, seq = left[i], _sequence(texts_a[i])
                if aligned(seq, _sequence(texts_b[i]), least) >= least:
                    out.append(i)
            yield pa.RecordBatch.from_arrays([take(b.column(0), pa.array(out, pa.int64())), take(b.column(1), pa.array(out, pa.int64()))], names=["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def _sequence(text: pa.StringScalar) -> np.ndarray:
    data = np.frombuffer(text.as_buffer(), np.uint8)
    return shingles(Words(np.array([0, len(data)]), data))[0]


def components(links: DataFrame) -> DataFrame:
    """(node, root) of the linked nodes, root the smallest node of the component, by alternating
    large and small stars; every half step is a minimum per node and a join, so a node with
    very many links is reduced before the shuffle and split by AQE after it."""
    edges = S.table(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), "links")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        # in a table of its own: the driver plans the rest of the round anew after each stage
        large = S.table(both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct(), "large")
        # small star: every edge points from the larger node to the smaller
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).filter("u != v").distinct()
        edges = S.table(small, "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now


def _compare(pairs: DataFrame, text: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) of at least that similarity; ``text`` has node and text."""
    both = (pairs.hint("merge").join(text.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
            .join(text.select(F.col("node").alias("a"), F.col("text").alias("text_a")).hint("merge"), "a").select("a", "b", "text_a", "text_b"))
    return _verify(both, least)


def _commonness(text: DataFrame) -> np.ndarray:
    """How many labelled shingles of all texts fall into each of SLOTS groups."""

    def run(batches):
        total = np.zeros(SLOTS, np.int64)
        for b in batches:
            for _, _, off, data in S.chunks(b.column(1)):
                total += np.bincount((labelled(*shingles(Words(off, data))) % np.uint64(SLOTS)).astype(np.int64), minlength=SLOTS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["slot", "n"])

    got = text.select("node", "text").mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    count = np.zeros(SLOTS, np.int64)
    count[got.column(0).to_numpy()] = got.column(1).to_numpy()
    return count


def parity(names: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(rows, PARITY / 64) words: bit k tells whether an odd number of the row's labelled shingles
    fall on k."""
    rows = len(bounds) - 1
    row = np.repeat(np.arange(rows), np.diff(bounds))
    odd = np.bincount(row * PARITY + (S.mix(names) % np.uint64(PARITY)).astype(np.int64), minlength=rows * PARITY) & 1
    return np.packbits(odd.astype(bool).reshape(rows, PARITY), axis=1, bitorder="little").view(np.int64)


def _prefixes(text: DataFrame, least: float) -> DataFrame:
    """(shingle, node, root, n, at, early, bits): the rarest labelled shingles of each text (node,
    text, root), ``at`` their place in the order from rare to common, n the size of the text and
    bits its ``parity``."""
    count = _commonness(text)

    def run(batches):
        for b in batches:
            for i, j, off, data in S.chunks(b.column(1)):
                h, bounds = shingles(Words(off, data))
                names = labelled(h, bounds)
                bits = parity(names, bounds)
                row = np.repeat(np.arange(j - i), np.diff(bounds))
                names = names[np.lexsort((names, count[(names % np.uint64(SLOTS)).astype(np.int64)], row))]
                at, n = np.arange(len(row)) - bounds[row], np.diff(bounds)[row]
                some = np.flatnonzero(at <= n - np.ceil(least * n - _SLACK))
                early = at <= n - np.ceil(2 * least / (1 + least) * n - _SLACK)
                of = [take(b.column(c).slice(i, j - i), pa.array(row[some])) for c in (0, 2)]
                yield pa.RecordBatch.from_arrays([pa.array(S.signed(names[some])), *of, pa.array(n[some]), pa.array(at[some]), pa.array(early[some]),
                                                  pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * bits.shape[1]), pa.array(bits[row[some]].reshape(-1)))],
                                                 names=["shingle", "node", "root", "n", "at", "early", "bits"])

    return text.select("node", "text", "root").mapInArrow(run, "shingle long, node long, root long, n long, at long, early boolean, bits array<long>")


def candidates(text: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """All pairs (a, b) of ``text`` (node, text, and where known root, its component) that can have
    that similarity and are not in one component, and some others.

    Texts of n <= m shingles share at least least / (1 + least) * (n + m) of them.  In one order of
    all shingles the first they share is then among the first of the shorter text (``early``) and
    of the longer, with as many behind it in both.  The order is from rare to common, so that a
    passage of very many texts is in few of these prefixes.  The shingles that only one of them
    has, (1 - least) / (1 + least) * (n + m) at most, are at least as many as the differing bits of
    ``parity``, which rejects most texts that share a rare shingle and are not similar."""
    if "root" not in text.columns:
        text = text.withColumn("root", F.col("node"))
    p = S.table(_prefixes(text, least), "prefixes")
    x, y = (p.select("shingle", *[F.col(c).alias(f"{c}_{k}") for c in ("node", "root", "n", "at", "early", "bits")]) for k in "xy")
    left = F.least(F.col("n_x") - F.col("at_x"), F.col("n_y") - F.col("at_y"))
    differ = sum((F.bit_count(F.col("bits_x")[i].bitwiseXOR(F.col("bits_y")[i])) for i in range(PARITY // 64)), F.lit(0))
    met = x.filter("early_x").join(y, (x["shingle"] == y["shingle"]) & (x["root_x"] != y["root_y"]) & ((F.col("n_x") < F.col("n_y")) | ((F.col("n_x") == F.col("n_y")) & (F.col("node_x") < F.col("node_y"))))
                                   & (left >= least / (1 + least) * (F.col("n_x") + F.col("n_y")) - _SLACK)
                                   & (differ <= (1 - least) / (1 + least) * (F.col("n_x") + F.col("n_y")) + _SLACK))
    return met.select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")).distinct()


def links(src: DataFrame, nodes: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Verified links (a, b) between different nodes; ``nodes`` has node and keys."""
    members = nodes.select("node", F.explode("keys").alias("key"))
    # other leaders in every bucket
    ranked = members.select("key", F.struct(F.xxhash64("key", "node").alias("r"), F.col("node").alias("n")).alias("x"))
    lead = ranked.groupBy("key").agg(F.min("x").alias("lo"), F.max("x").alias("hi")).filter("lo.n != hi.n").select("key", F.col("lo.n").alias("lo"), F.col("hi.n").alias("hi"))
    met = S.table(members.join(lead, "key"), "buckets")
    pairs = (met.select("node", F.explode(F.array("lo", "hi")).alias("x")).filter("x != node")
             .select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct())
    tried = S.table(pairs, "pairs")
    if not tried.limit(1).count():
        return tried
    # one text per node, for the nodes of some pair; the later pairs have no other nodes
    wanted = tried.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    text = S.table(_texts(src).join(wanted.hint("merge"), "node", "left_semi").groupBy("node").agg(F.first("text").alias("text")), "texts")
    found = S.table(_compare(tried, text, least), "verified")
    # a leader has met its whole bucket; of the others all stay, linked or not, while the bucket
    # has several components
    rest = (met.filter("node != lo AND node != hi").select("node", "key").join(components(found), "node", "left")
            .select("node", "key", F.coalesce("root", "node").alias("root")))
    rest = S.table(rest, "rest")
    several = rest.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo != hi").select("key")
    left = S.table(rest.join(several, "key").select("node", "root").distinct(), "left")
    if not left.limit(1).count():
        return found
    # whoever shares a bucket with another component still is compared with all it can be similar to
    pairs = S.table(candidates(text.join(left.hint("merge"), "node"), least).join(tried, ["a", "b"], "left_anti"), "pairs")
    return S.table(_compare(pairs, text, least).unionByName(found), "verified")


def with_class(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """(doc, row, root, class_id) per row of ``docs``: doc the id (null as the smallest number),
    row the hash of the text, root the component's node (null without words)."""
    S.prepare(docs.sparkSession)
    src = _source(docs, doc_id, text)
    rows = S.table(sketches(src), "sketches")
    nodes = rows.filter("node != 0").groupBy("node").agg(F.min("doc").alias("low"), F.first("keys").alias("keys"))
    nodes = S.table(nodes, "nodes")
    roots = components(links(src, nodes, least))
    rooted = nodes.select("node", "low").join(roots, "node", "left").select("node", "low", F.coalesce("root", "node").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("class_id"))
    of_node = rooted.select("node", "root").join(lowest, "root").select("node", "root", "class_id")
    # copies in very large groups share a node: the join is split where one is hot
    return rows.select("doc", "row", "node").join(of_node, "node", "left").select("doc", "row", "root", F.coalesce("class_id", "doc").alias("class_id"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """One document of each class, that with the smallest id (of equal ids one); documents
    without words all stay."""
    classes = with_class(docs, doc_id, text, least)
    first = classes.filter("root IS NOT NULL").groupBy("root").agg(F.min(F.struct("doc", "row")).alias("x")).select("x.doc", "x.row", F.lit(True).alias("one"))
    keep = S.table(first.unionByName(classes.filter("root IS NULL").select("doc", "row", F.lit(False).alias("one")).distinct()), "kept")
    columns = docs.columns
    doc, row = _keys(doc_id, text)
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_doc_"), doc, row)
    left = keyed.join(keep, ["doc", "row"])
    # of rows that are equal in id and text one stays
    nth = F.row_number().over(Window.partitionBy("doc", "row").orderBy("one"))
    return left.withColumn("nth", nth).filter("nth = 1 OR NOT one").select("_doc_.*")


def op9_neardup(spark, sf_dir: str) -> DataFrame:
    """One row per document of the whole ``documents`` table with its class (smallest doc_id)."""
    got = with_class(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    null = lambda c: F.when(F.col(c) != _NULL, F.col(c)).alias(c)
    return got.withColumnRenamed("doc", "doc_id").select(null("doc_id"), null("class_id"))
