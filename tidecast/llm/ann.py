"""Approximate nearest neighbours by multi-index hashing.

1. ``learn`` fits a rotation (PCA, then iterative quantisation) to at most ``SAMPLE_ROWS`` rows,
   those with the smallest hash of their id; the signs of the rotated vector are its code.
2. ``build`` writes the index: blocks of rows, each with its vectors, its codes and one bucket
   table per substring of the code.  Every row is indexed; of equal vectors the k + 1 smallest
   ids, as no answer can hold others.
3. ``search`` probes, per block and query, all buckets of each substring within radius
   floor(R / substrings): by the pigeonhole principle these hold every code within Hamming radius
   R.  Codes within R are reranked by the distance of the original vectors in double precision.
4. R is calibrated: ``CALIBRATION`` queries are answered exactly by a scan, and R is the
   distance within which the share ``TARGET`` of their neighbours' codes lies.  Queries that find
   fewer than k rows are searched again with the full radius, which is exact.

Query blocks meet index blocks; only the k best of each query and block are emitted.  An index block
is sent to one task and every query block after it: nothing of either passes the driver, and the few
queries of the calibration alone are sent to all tasks.

Defined results: vectors that are null, zero, hold null or non-finite components, or have not the
most frequent dimension take no part, as query or candidate, nor do rows with a null id; rows
that repeat an id with its vector count once; ties go to the smaller id; with fewer than k
candidates all are returned; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import _shared as S

BITS, PART_BITS = 64, 8
SAMPLE_ROWS, CALIBRATION, TARGET = 10_000, 64, 0.97
BLOCK_ROWS, QUERY_ROWS = 8192, 2048
#: Every query goes to every block, so once there are ``BLOCKS`` of them they grow, up to ``MOST_ROWS`` rows.
BLOCKS, MOST_ROWS = 32, 65_536
_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)

RESULT = "query_id long, query_hash long, vec_id long, score double, bits long"


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v, h): the rows that take part, vectors as floats if they are so in ``vectors`` and else
    as doubles, and their hash as doubles."""
    v = F.col(f"`{embedding}`")
    v = v.cast("array<float>" if vectors.select(v).schema[0].dataType.simpleString() == "array<float>" else "array<double>")
    good = (F.size("v") > 0) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = (vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), v.alias("v")).filter("vec_id IS NOT NULL AND v IS NOT NULL").filter(good))
    most = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).select("d")
    d = most.first()
    return rows.filter(F.size("v") == (d["d"] if d else 0)).withColumn("h", F.xxhash64(F.col("v").cast("array<double>")))


def _numbers(rows: int) -> int:
    """Into how many blocks so many rows are cut."""
    return max(1, min(-(-rows // BLOCK_ROWS), max(BLOCKS, -(-rows // MOST_ROWS))))


class Rotation:
    """Centre and rotation of the codes."""

    def __init__(self, centre: np.ndarray, matrix: np.ndarray):
        self.centre, self.matrix = centre, matrix
        self.bits = matrix.shape[1]
        self.parts = max(1, -(-self.bits // PART_BITS))

    def codes(self, x: np.ndarray) -> np.ndarray:
        """(rows, parts) bytes, one per substring."""
        on = (x - self.centre) @ self.matrix > 0
        return np.packbits(np.pad(on, ((0, 0), (0, self.parts * PART_BITS - self.bits))), axis=1, bitorder="little")


def learn(rows: DataFrame, count: int, sample_rows: int = SAMPLE_ROWS, rounds: int = 30) -> Rotation:
    placed = rows.select("v", F.xxhash64("vec_id").alias("r"), "vec_id")
    # twice the sample lies below this hash, so a task need not send ``sample_rows`` rows to be sorted
    low = placed.filter(F.col("r") < -2**63 + int(2**64 * (2 * sample_rows / count))) if count > 4 * sample_rows else placed
    got = None
    for some in (low, placed):
        if got is None or got.num_rows < min(sample_rows, count):
            got = some.orderBy("r", "vec_id").limit(sample_rows).select("v").toArrow()
    x = np.array(got["v"].combine_chunks().flatten(), np.float64).reshape(got.num_rows, -1) if got.num_rows else np.zeros((0, 1))
    d = x.shape[1]
    bits = min(BITS, d)
    if len(x) < 2:
        return Rotation(np.zeros(d), np.eye(d)[:, :bits])
    centre = x.mean(0)
    _, axes = np.linalg.eigh(np.cov((x - centre).T).reshape(d, d))
    p = (x - centre) @ axes[:, ::-1][:, :bits]
    turn = np.linalg.qr(np.random.RandomState(11).randn(bits, bits))[0]
    for _ in range(rounds):
        u, _, vt = np.linalg.svd(np.sign(p @ turn).T @ p)
        turn = (u @ vt).T
    return Rotation(centre, axes[:, ::-1][:, :bits] @ turn)


def _dump(**arrays) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _load(raw: bytes) -> dict[str, np.ndarray]:
    return dict(np.load(pa.BufferReader(raw)))


def blocks(rows: DataFrame, number: int, rotation: Rotation | None, tables: bool = False) -> DataFrame:
    """(block, payload): ids, hashes and vectors of each block; with a rotation also codes, and with
    ``tables`` bucket tables."""
    shared = rows.sparkSession.sparkContext.broadcast(rotation)

    def run(batches):
        from pyspark import TaskContext
        ids, hs, xs = [], [], []
        for b in batches:
            if b.num_rows:
                ids.append(b.column(0).to_numpy())
                hs.append(b.column(2).to_numpy())
                xs.append(b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1))
        if not ids:
            return
        out = {"id": np.concatenate(ids), "h": np.concatenate(hs), "x": np.concatenate(xs)}
        if shared.value is not None:
            out["code"] = np.concatenate([shared.value.codes(x.astype(np.float64)) for x in xs])
        if tables:
            order = np.argsort(out["code"], axis=0, kind="stable")      # rows by substring value
            out["order"] = order.astype(np.int32)
            out["first"] = np.stack([np.searchsorted(out["code"][order[:, j], j], np.arange(257)) for j in range(order.shape[1])], axis=1).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([_dump(**out)], pa.binary())], names=["block", "payload"])

    place = F.pmod(F.xxhash64("vec_id", "h"), F.lit(number)).cast("int")
    return rows.select("vec_id", "v", "h").repartitionById(number, place).mapInArrow(run, "block int, payload binary")


def _nearest(ids, scores, k: int) -> np.ndarray:
    """Places of the k best, ties to the smaller id."""
    if len(ids) > 4 * k:
        edge = np.partition(scores, k - 1)[k - 1]
        some = np.flatnonzero(scores <= edge)
    else:
        some = np.arange(len(ids))
    return some[np.lexsort((ids[some], scores[some]))][:k]


def probe(block: dict[str, np.ndarray], code: np.ndarray, radius: int) -> np.ndarray:
    """Rows of the block whose code is within ``radius`` of ``code``."""
    parts = len(code)
    near = np.zeros(len(block["id"]), bool)
    values = np.arange(256, dtype=np.uint8)
    for j in range(parts):
        hit = np.flatnonzero(_POP[values ^ code[j]] <= radius // parts)
        a, b = block["first"][hit, j], block["first"][hit + 1, j]
        size = b - a
        at = np.repeat(a - (np.cumsum(size) - size), size) + np.arange(size.sum())
        near[block["order"][at, j]] = True
    rows = np.flatnonzero(near)
    return rows[_POP[block["code"][rows] ^ code].sum(1) <= radius]


def _answers(block: dict[str, np.ndarray], q: dict[str, np.ndarray], radius: int | None, k: int) -> pa.RecordBatch:
    """The k best rows of a block for each query of another; a null radius looks at all rows."""
    out, found = [], []
    for i, (qid, qh, x) in enumerate(zip(q["id"].tolist(), q["h"].tolist(), q["x"].astype(np.float64), strict=True)):
        rows = np.arange(len(block["id"])) if radius is None else probe(block, q["code"][i], radius)
        rows = rows[block["id"][rows] != qid]
        scores = np.sqrt(((block["x"][rows] - x) ** 2).sum(1))
        best = _nearest(block["id"][rows], scores, k)
        found.append(rows[best])
        out.append((np.full(len(best), qid), np.full(len(best), qh), block["id"][rows[best]], scores[best],
                    _POP[block["code"][rows[best]] ^ q["code"][i]].sum(1) if "code" in q else np.zeros(len(best))))
    cols = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64()), strict=True)],
                                      names=["query_id", "query_hash", "vec_id", "score", "bits"])


def _ranked(answers: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id", "query_hash").orderBy("score", "vec_id")
    return answers.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _search(index: DataFrame, queries: DataFrame, numbers: int, radius: int | None, k: int) -> DataFrame:
    """The k best of every query among all blocks; a null radius looks at all rows."""

    def run(batches):
        held, block = None, None
        for b in batches:
            for number, turn, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                if turn == 0:
                    block, held = _load(raw.as_buffer()), number
                elif held == number:    # else no row is in the block
                    yield _answers(block, _load(raw.as_buffer()), radius, k)

    # a block comes once, before the queries that are sent to it
    spread = queries.select(F.explode(F.sequence(F.lit(0), F.lit(numbers - 1))).alias("block"), F.lit(1).alias("turn"), "payload")
    sent = index.select("block", F.lit(0).alias("turn"), "payload").unionByName(spread).repartitionById(numbers, F.col("block"))
    return _ranked(sent.sortWithinPartitions("block", "turn").mapInArrow(run, RESULT), k)


def search(vectors: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query row's k nearest other rows that are found."""
    spark = vectors.sparkSession
    S.prepare(spark)
    rows = S.table(usable(vectors, vec_id, embedding), "vectors")
    copies = F.dense_rank().over(Window.partitionBy("h", "v").orderBy("vec_id"))
    # a repeated row is left out by a second window over the same partitions, without a shuffle
    again = F.row_number().over(Window.partitionBy("h", "v", "vec_id").orderBy("vec_id"))
    index_rows = rows.withColumn("nth", copies).filter(F.col("nth") <= k + 1).withColumn("again", again).filter("again = 1").select("vec_id", "v", "h")
    count = rows.count()
    number = _numbers(count)
    rotation = learn(rows, count)
    index = S.table(blocks(index_rows, number, rotation, tables=True), "index")
    asked = rows.filter(is_query).select("vec_id", "v", "h").distinct()
    asked_number = max(1, -(-asked.count() // QUERY_ROWS))
    queries = S.table(blocks(asked, asked_number, rotation), "queries")
    radius = calibrate(index, asked, rotation, k)
    found = S.table(_search(index, queries, number, radius, k), "found")
    # too few found: once more with the full radius
    few = asked.join(found.groupBy(F.col("query_id").alias("vec_id"), F.col("query_hash").alias("h")).agg(F.count(F.lit(1)).alias("n")), ["vec_id", "h"], "left").filter(F.coalesce("n", F.lit(0)) < k)
    few = S.table(few.select("vec_id", "v", "h"), "few")
    again = few.count()
    if again:
        more = _search(index, blocks(few, max(1, -(-again // QUERY_ROWS)), None), number, None, k)
        gone = few.select(F.col("vec_id").alias("query_id"), F.col("h").alias("query_hash"))
        found = found.join(gone, ["query_id", "query_hash"], "left_anti").unionByName(more)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def calibrate(index: DataFrame, asked: DataFrame, rotation: Rotation, k: int, queries: int = CALIBRATION, target: float = TARGET) -> int:
    """The Hamming radius that holds the share ``target`` of the exact neighbours of some queries."""
    some = S.table(asked.orderBy(F.xxhash64("vec_id"), "vec_id").limit(queries), "calibration")
    first = blocks(some, 1, rotation).select("payload").first()
    if first is None:
        return rotation.bits
    # ``queries`` vectors at most; a join would copy them for every block, and in the driver
    shared = index.sparkSession.sparkContext.broadcast(bytes(first["payload"]))

    def run(batches):
        q = _load(shared.value)
        for b in batches:
            for raw in b.column(0):
                yield _answers(_load(raw.as_buffer()), q, None, k)

    exact = _ranked(index.select("payload").mapInArrow(run, RESULT), k)
    r = exact.agg(F.percentile("bits", F.lit(target)).alias("r")).first()["r"]
    return rotation.bits if r is None else int(np.ceil(r))


def op8_multi_index_ann(spark, sf_dir: str) -> DataFrame:
    """Contract rows of op8: queries are the rows whose vec_id is divisible by 100."""
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)
