"""Benchmark decontamination: a hash set of the benchmark's normalised n-grams is broadcast,
training texts are scanned window by window, hits are verified word by word, and spans or
whole documents are removed.

Words are the runs of digits, letters a-z (A-Z lower-cased first) and non-ASCII characters.
A window is ``n`` consecutive words of an item; an item with fewer words, but at least one,
is one window.

Defined results: a null or empty text has no words and no hits; a null item text has no
window; an empty benchmark or documents table gives no hits / no rows; repeated documents
get a row each; items with equal windows all count; further columns of the inputs, of
whatever name, are kept (``decontaminate``) or ignored (``scan``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyarrow.compute import take
from pyspark.sql import Column, DataFrame, functions as F

from . import _shared as S

WINDOW_WORDS = 10
#: The n-gram set is broadcast up to this size; beyond it the windows are joined by shuffle.
BROADCAST_BYTES = 64 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True

SCAN_SCHEMA = "n_words long, hits array<struct<word:int,words:int,start:int,end:int,items:array<string>>>"


class Words:
    """The normalised words of a chunk of texts: byte spans, row bounds and hashes."""

    def __init__(self, off: np.ndarray, data: np.ndarray):
        self.data = _LOWER[data] if len(data) else data
        self.start, self.end = S.spans_of(_WORD[self.data], off)
        self.row = np.searchsorted(self.start, off)     # first word of each row
        sums = S.prefix(S.BYTE_VALUE[self.data])
        self.hash = S.span_hash(sums, self.start, self.end)
        self.sums = S.prefix(self.hash)

    def windows(self, n: int, exact_rows: bool = False):
        """(first word, hash) of every window of n words inside one row; with
        ``exact_rows`` only rows of exactly n words."""
        first, last = self.row[:-1], self.row[1:]
        if exact_rows:
            at = first[last - first == n]
        else:
            at = np.arange(max(0, len(self.start) - n + 1))
            row_end = np.repeat(last, last - first)
            at = at[row_end[at] - at >= n]
        return at, S.span_hash(self.sums, at, at + n)

    def text(self, at: int, n: int) -> bytes:
        return b" ".join(self.data[self.start[i]:self.end[i]].tobytes() for i in range(at, at + n))


def ngrams(items: DataFrame, item_id: str | Column, text: str | Column, n: int = WINDOW_WORDS) -> DataFrame:
    """(hash, words, gram, items): the distinct windows and the sorted ids of their items."""
    S.prepare(items.sparkSession)

    def cut(batches):
        for b in batches:
            out = {"item": [], "hash": [], "words": [], "gram": []}
            for i, j, off, data in S.chunks(b.column(1)):
                w = Words(off, data)
                for k in range(1, n + 1):
                    at, h = w.windows(k, exact_rows=k < n)
                    row = np.searchsorted(w.row, at, "right") - 1
                    out["item"] += take(b.column(0).slice(i, j - i), pa.array(row)).to_pylist()
                    out["hash"] += S.signed(h).tolist()
                    out["words"] += [k] * len(at)
                    out["gram"] += [w.text(a, k) for a in at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["item"], pa.string()), pa.array(out["hash"], pa.int64()), pa.array(out["words"], pa.int32()), pa.array(out["gram"], pa.binary())],
                names=["item", "hash", "words", "gram"])

    src = items.select(_col(item_id).cast("string").alias("item"), _col(text).cast("string").alias("text"))
    return (src.mapInArrow(cut, "item string, hash long, words int, gram binary")
            .groupBy("hash", "words", "gram").agg(F.array_sort(F.collect_set("item")).alias("items")))


def scan(docs: DataFrame, text: str | Column, grams: DataFrame, keep: list[Column], n: int = WINDOW_WORDS,
         broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The ``keep`` columns of every document with ``n_words`` and its verified ``hits``
    (first word, words, first and last byte in the text, items).

    The n-gram set is broadcast if its measured size allows; otherwise each document's
    windows are joined with it by hash (a shuffle) and the gram is compared there.
    """
    spark = docs.sparkSession
    S.prepare(spark)
    size = grams.agg(F.coalesce(F.sum(F.length("gram") + 16 + 12 * F.size("items")), F.lit(0)).alias("b")).first()["b"]
    if size > broadcast_bytes:
        return _scan_joined(docs, text, grams, keep, n)
    got = grams.toArrow()
    index: dict[tuple[int, bytes], list[str]] = {}
    for k, g, it in zip(*(got.column(c).to_pylist() for c in ("words", "gram", "items")), strict=True):
        index[k, bytes(g)] = it
    hashes = {k: np.unique(got.filter(pa.compute.equal(got["words"], k))["hash"].to_numpy()) for k in set(got["words"].to_pylist())}
    shared = spark.sparkContext.broadcast((hashes, index))
    names = [c for c in docs.select(*keep).columns]

    def look(batches):
        tables, lookup = shared.value
        small = {k: _bits(v) for k, v in tables.items()}
        for b in batches:
            n_words, hits = [], []
            for i, j, off, data in S.chunks(b.column(len(names))):
                w = Words(off, data)
                n_words += np.diff(w.row).tolist()
                found = [[] for _ in range(i, j)]
                for k, known in tables.items():
                    at, h = w.windows(k)
                    h = S.signed(h)
                    mask, bits = small[k]
                    near = np.flatnonzero(bits[h & mask])
                    near = near[np.isin(h[near], known)]
                    for a in at[near].tolist():
                        it = lookup.get((k, w.text(a, k)))
                        if it is not None:
                            r = int(np.searchsorted(w.row, a, "right")) - 1
                            found[r].append((a - int(w.row[r]), k, int(w.start[a] - off[r]), int(w.end[a + k - 1] - off[r]), it))
                hits += [sorted(f, key=lambda x: x[:2]) for f in found]
            yield _attach(b, names, n_words, hits)

    schema = _schema(docs, keep)
    return docs.select(*keep, _col(text).cast("string").alias("_text_")).mapInArrow(look, schema)


_HIT = pa.struct([("word", pa.int32()), ("words", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("items", pa.list_(pa.string()))])


def _attach(b: pa.RecordBatch, names: list[str], n_words: list[int], hits: list) -> pa.RecordBatch:
    rows = [[dict(zip(("word", "words", "start", "end", "items"), h, strict=True)) for h in r] for r in hits]
    return pa.RecordBatch.from_arrays([*b.columns[:len(names)], pa.array(n_words, pa.int64()), pa.array(rows, pa.list_(_HIT))], names=[*names, "n_words", "hits"])


def _schema(docs: DataFrame, keep: list[Column]) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema), SCAN_SCHEMA])


def _bits(hashes: np.ndarray) -> tuple[np.int64, np.ndarray]:
    """A table of bits that most foreign hashes miss, to look up few in the sorted array."""
    size = 1 << max(16, int(len(hashes) * 16).bit_length())
    bits = np.zeros(size, bool)
    bits[hashes & (size - 1)] = True
    return np.int64(size - 1), bits


def _scan_joined(docs: DataFrame, text: str | Column, grams: DataFrame, keep: list[Column], n: int) -> DataFrame:
    """The same rows for an n-gram set of any size: windows are joined by hash and words."""
    rows = S.table(docs.select(F.monotonically_increasing_id().alias("_row_"), _col(text).cast("string").alias("_text_"), F.struct(*keep).alias("_keep_")), "decontaminate-rows")
    lengths = [r["words"] for r in grams.groupBy("words").agg(F.count(F.lit(1)).alias("c")).toLocalIterator()]

    def windows(batches):
        for b in batches:
            for i, j, off, data in S.chunks(b.column(1)):
                w = Words(off, data)
                for k in lengths:
                    at, h = w.windows(k)
                    row = np.searchsorted(w.row, at, "right") - 1
                    for s in range(0, len(at), 100_000):
                        a, r = at[s:s + 100_000], row[s:s + 100_000]
                        yield pa.RecordBatch.from_arrays(
                            [take(b.column(0).slice(i, j - i), pa.array(r)), pa.array(S.signed(h[s:s + 100_000])), pa.array(np.full(len(a), k, np.int32)),
                             pa.array((a - w.row[r]).astype(np.int32)), pa.array((w.start[a] - off[r]).astype(np.int32)), pa.array((w.end[a + k - 1] - off[r]).astype(np.int32))],
                            names=["_row_", "hash", "words", "word", "start", "end"])

    def count(batches):
        for b in batches:
            n_words = []
            for _, _, off, data in S.chunks(b.column(1)):
                n_words += np.diff(Words(off, data).row).tolist()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words, pa.int64())], names=["_row_", "n_words"])

    win = rows.select("_row_", "_text_").mapInArrow(windows, "_row_ long, hash long, words int, word int, start int, end int")
    near = win.join(grams, ["hash", "words"])
    # the words are compared: the normalised text of the window must equal the gram
    cut = F.substring(F.encode("_text_", "UTF-8"), F.col("start") + 1, F.col("end") - F.col("start"))
    words = F.regexp_replace(F.translate(F.decode(cut, "UTF-8"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
                             r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    hits = (near.join(rows.select("_row_", "_text_"), "_row_").filter(F.encode(words, "UTF-8") == F.col("gram"))
            .groupBy("_row_").agg(F.array_sort(F.collect_list(F.struct("word", "words", "start", "end", "items"))).alias("hits")))
    counted = rows.select("_row_", "_text_").mapInArrow(count, "_row_ long, n_words long")
    empty = F.array().cast("array<struct<word:int,words:int,start:int,end:int,items:array<string>>>")
    return (rows.select("_row_", "_keep_").join(counted, "_row_").join(hits, "_row_", "left")
            .select("_keep_.*", "n_words", F.coalesce("hits", empty).alias("hits")))


def _col(c: str | Column) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def hit_words() -> Column:
    """Number of words inside any hit (``hits`` is sorted by first word)."""
    step = F.aggregate("hits", F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto")),
                       lambda a, h: F.struct((a["n"] + F.greatest(F.lit(0), h["word"] + h["words"] - F.greatest(a["upto"], h["word"]))).alias("n"),
                                             F.greatest(a["upto"], h["word"] + h["words"]).alias("upto")))
    return step["n"].cast("long")


def hit_items() -> Column:
    """Sorted distinct ids of the items that occur."""
    return F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda h: h["items"]))))


def decontaminate(docs: DataFrame, items: DataFrame, doc_text: str = "text", item_id: str = "item_id", item_text: str = "text",
                  n: int = WINDOW_WORDS, remove: str = "documents") -> DataFrame:
    """``docs`` without the documents that hold a benchmark window (``remove="documents"``),
    or with the hit spans cut out of their text (``remove="spans"``)."""
    found = scan(docs, doc_text, ngrams(items, item_id, item_text, n), [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc_")], n)
    if remove == "documents":
        return found.filter(F.size("hits") == 0).select("_doc_.*")
    raw = F.encode(F.coalesce(F.col(f"_doc_.`{doc_text}`"), F.lit("")), "UTF-8")
    gaps = F.aggregate("hits", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<a:int,b:int>>").alias("kept")),
                       lambda s, h: F.struct(F.greatest(s["at"], h["end"]).alias("at"),
                                             F.when(h["start"] > s["at"], F.concat(s["kept"], F.array(F.struct(s["at"].alias("a"), h["start"].alias("b"))))).otherwise(s["kept"]).alias("kept")))
    spans = F.concat(F.col("_g_.kept"), F.array(F.struct(F.col("_g_.at").alias("a"), F.length("_raw_").alias("b"))))
    cut = F.array_join(F.transform(spans, lambda s: F.decode(F.substring(F.col("_raw_"), s["a"] + 1, s["b"] - s["a"]), "UTF-8")), "")
    return (found.withColumn("_raw_", raw).withColumn("_g_", gaps)
            .withColumn("_cut_", F.when(F.size("hits") > 0, cut).otherwise(F.col(f"_doc_.`{doc_text}`")))
            .select(*[(F.col("_cut_") if c == doc_text else F.col(f"_doc_.`{c}`")).alias(c) for c in docs.columns]))


def op7_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    """Contract rows of op7 over the whole ``documents`` and ``benchmark`` tables."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = scan(docs, "text", ngrams(bench, "item_id", "text"), [F.col("doc_id")])
    return (found.withColumn("items", hit_items())
            .select("doc_id", "n_words", hit_words().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated")))


_SQL_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

#: The same by joining the windows' texts.
ORACLE_SQL = f"""
WITH iw AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
grams AS (SELECT DISTINCT item_id, least(len(w), 10) AS size, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + 9], ' '))) AS g FROM iw WHERE len(w) > 0),
dw AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
wins AS (SELECT doc_id, size, x.i AS i, x.g AS g FROM (SELECT doc_id, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: {{'i': i, 'g': array_to_string(w[i:i + size - 1], ' ')}})) AS x
  FROM dw, (SELECT DISTINCT size FROM grams) WHERE len(w) >= size)),
hits AS (SELECT doc_id, i, h.size AS size, item_id FROM wins h JOIN grams g ON g.size = h.size AND g.g = h.g),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw d LEFT JOIN words ON words.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
"""
