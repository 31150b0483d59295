"""SentencePiece encoding and decoding by a relational lattice.

1. Texts are normalised as the model does it (a leading ``▁``, spaces become ``▁``) and cut into
   words where no piece can reach across: before a run of ``▁``, around line breaks, and between
   a letter and a sign that follows no letter in any piece.
2. ``lattice``: the bounded-length substrings of each distinct word are exploded and equi-joined
   to the piece table; the edges are grouped by word again (no second shuffle: the words are
   already partitioned by word).
3. The edges are folded by a higher-order aggregate: ``viterbi`` (best sum of scores) for unigram
   models.  A BPE model's segmentation is not its best path; for it the fold merges, step by
   step, the neighbours whose joint edge scores best (``merges``), which is what the library does.
4. The ids of the ``TABLE_WORDS`` most frequent words (as many as fit, whole counts only) are
   broadcast, and the texts are put together from them.  Words beyond that table, or longer than
   ``WORD_CHARS``, go through the same merges in the task that meets them.

``decode`` joins pieces and bytes to the text again.

Defined results: a null or empty text has no ids and decodes to the empty text; a ``▁``
in a text comes back as a space, as from the library; characters without a piece become byte pieces, or the unknown id in a model without them; text that looks
like a control piece is ordinary text; repeated rows are encoded alike; an empty table gives no
rows; other columns are kept (``encode``).
"""

from __future__ import annotations

import heapq
import itertools
import math
import operator
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import _shared as S

SPACE = "▁"
TABLE_WORDS, WORD_CHARS = 300_000, 32
#: The piece table is broadcast up to this many pieces, beyond it the join shuffles.
BROADCAST_PIECES = 1_000_000
#: Distinct parts between spaces that a task counts before it hands on their words; words and parts
#: whose ids a worker remembers.
COUNT_PARTS, CACHE_WORDS, CACHE_PARTS = 150_000, 50_000, 100_000


class Pieces:
    """Piece table of a model file: what encoding and decoding need of it."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.unknown = sp.unk_id()
        self.text = [sp.id_to_piece(i) for i in range(n)]
        self.scores = [sp.get_score(i) for i in range(n)]
        special = [sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i) for i in range(n)]
        self.control = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i)}
        self.ids = {p: i for i, p in enumerate(self.text) if not special[i]}
        self.bytes = {int(self.text[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        probe = "a  béé\nﬁ "
        if sp.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("the model's normalisation is not supported")
        if any(re.search(f"[^{SPACE}]{SPACE}", p) or "\n" in p for p in self.ids):
            raise ValueError("a piece reaches over a word's start")
        after = {b for p in self.ids for a, b in zip(p, p[1:], strict=False) if a.isalpha()}
        self.signs = "".join(c for c in ".,;:!?|%$&*#" if c not in after)
        self.longest = max(map(len, self.ids))

    def table(self, spark: SparkSession) -> DataFrame:
        """(piece, id, score)"""
        rows = [(p, i, float(self.scores[i])) for p, i in self.ids.items()]
        return spark.createDataFrame(pa.table({"piece": [r[0] for r in rows], "id": pa.array([r[1] for r in rows], pa.int32()), "score": [r[2] for r in rows]}))


def word_pattern(signs: str) -> re.Pattern:
    stop = f"{SPACE}\n{re.escape(signs)}"
    return re.compile(rf"{SPACE}*[^\W\d_]+(?=[{stop}]|\Z)|{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")


def normalised(text: str) -> str:
    return SPACE + text.replace(" ", SPACE) if text else ""


def parts(text: str) -> list[str] | None:
    """The parts of a text between its single spaces: the words of ``normalised(text)`` are those of
    each part with ``SPACE`` before it.  None where a word's run of ``SPACE`` may be longer."""
    if not text:
        return []
    return None if text[0] == " " or "  " in text or SPACE in text else text.split(" ")


# ---------------------------------------------------------------- lattice and folds in Spark

def lattice(words: DataFrame, pieces: DataFrame, longest: int, broadcast_pieces: int = BROADCAST_PIECES) -> DataFrame:
    """(word, chars, edges) with edges (start, end, id, score, piece) sorted by end and start;
    words, a column ``word`` of distinct words, without any edge are left out."""
    size = F.char_length("word")
    subs = F.flatten(F.transform(F.sequence(F.lit(1), size), lambda s: F.transform(
        F.sequence(F.lit(1), F.least(F.lit(longest), size - s + 1)), lambda n: F.struct((s - 1).alias("start"), (s - 1 + n).alias("end"), F.substring(F.col("word"), s, n).alias("piece")))))
    cut = words.repartition("word").filter(size > 0).select("word", F.explode(subs).alias("x")).select("word", "x.*")
    if pieces.count() <= broadcast_pieces:
        pieces = F.broadcast(pieces)
    edges = cut.join(pieces, "piece").groupBy("word").agg(F.array_sort(F.collect_list(F.struct("end", "start", "id", "score", "piece"))).alias("edges"))
    return edges.select("word", F.char_length("word").alias("chars"), "edges")


def viterbi() -> Column:
    """Ids of the path with the best sum of scores (null if no path covers the word); of equal
    sums that whose last pieces start first."""
    return F.expr("""
      transform(array(aggregate(edges,
          transform(sequence(0, chars), i -> named_struct('total', IF(i = 0, 0D, CAST(NULL AS DOUBLE)), 'back', -1, 'id', -1)),
          (best, e) -> transform(best, (x, i) -> IF(i = e.end AND best[e.start].total IS NOT NULL
                                                  AND (x.total IS NULL OR best[e.start].total + e.score > x.total),
                                                named_struct('total', best[e.start].total + e.score, 'back', e.start, 'id', e.id), x)))),
        best -> IF(best[chars].total IS NULL, CAST(NULL AS array<int>),
          aggregate(sequence(1, chars), named_struct('at', chars, 'ids', CAST(array() AS array<int>)),
            (s, k) -> IF(s.at <= 0, s, named_struct('at', best[s.at].back, 'ids', concat(array(best[s.at].id), s.ids))), s -> s.ids)))[0]""")


def merges() -> Column:
    """Ids after merging, again and again, the neighbours whose joint edge scores best, the
    leftmost of equals (null if a character has no edge)."""
    return F.expr("""
      transform(array(named_struct('score', map_from_entries(array_distinct(transform(edges, e -> struct(e.piece, e.score)))),
                                   'id', map_from_entries(array_distinct(transform(edges, e -> struct(e.piece, e.id)))))),
        m -> transform(aggregate(sequence(1, chars), transform(sequence(1, chars), i -> substring(word, i, 1)),
          (now, k) -> IF(size(now) < 2, now,
            transform(array(array_max(transform(sequence(0, greatest(size(now) - 2, 0)), i -> struct(m.score[concat(now[i], now[i + 1])] AS score, -i AS i)))),
              b -> IF(b.score IS NULL, now, concat(slice(now, 1, -b.i), array(concat(now[-b.i], now[1 - b.i])), slice(now, 3 - b.i, size(now)))))[0])),
          p -> m.id[p]))[0]""")


def count_words(docs: DataFrame, text: str, pattern: re.Pattern) -> DataFrame:
    """(word, n): the distinct words of all texts; each task counts its own first."""

    def run(batches):
        seen, words = Counter(), Counter()
        for b in batches:
            for t in b.column(0):
                t = t.as_py() or ""
                if (cut := parts(t)) is None:
                    words.update(pattern.findall(normalised(t)))
                else:
                    seen.update(cut)
                if len(seen) + len(words) >= COUNT_PARTS:
                    yield from out(seen, words)
                    seen, words = Counter(), Counter()
        yield from out(seen, words)

    def out(cut, seen):
        # a part is cut into its words once, however often it was met; letters alone are a word
        while cut:
            part, n = cut.popitem()
            if part.isalpha():
                seen[SPACE + part] += n
            else:
                for w in pattern.findall(SPACE + part):
                    seen[w] += n
        # long texts without a break can be long words: bounded batches
        words, size = [], 0
        for w in seen:
            words.append(w)
            size += len(w)
            if size > S.CHUNK_BYTES:
                yield batch(words, seen)
                words, size = [], 0
        if words:
            yield batch(words, seen)

    def batch(words, seen):
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(map(seen.__getitem__, words), pa.int64())], names=["word", "n"])

    found = docs.select(F.col(f"`{text}`").cast("string").alias("text")).filter("text IS NOT NULL AND text != ''").mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def word_table(docs: DataFrame, text: str, model: Pieces, limit: int = TABLE_WORDS) -> DataFrame:
    """(word, ids) of the most frequent words: all with at least the smallest count at which no
    more than ``limit`` words are left."""
    spark = docs.sparkSession
    words = S.table(count_words(docs, text, word_pattern(model.signs)).filter(F.char_length("word") <= WORD_CHARS), "words")
    # a row per distinct count and task
    counts = words.groupBy("n").agg(F.count(F.lit(1)).alias("words"))
    rest = F.sum("words").over(_by_count())
    least = counts.withColumn("rest", rest).filter(F.col("rest") <= limit).agg(F.min("n").alias("n")).first()["n"]
    often = words.filter(F.col("n") >= (least if least is not None else (1 << 62)))
    cut = lattice(often.select("word"), model.table(spark), model.longest)
    # a word with a character that has no piece has no such path
    whole = F.size(F.filter("edges", lambda e: e["end"] - e["start"] == 1)) == F.col("chars")
    return cut.filter(whole).select("word", merges().alias("ids"))


def _by_count():
    from pyspark.sql import Window
    return Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, 0)


# ---------------------------------------------------------------- in the task

class Merger:
    """The same merges for one word: ids of its pieces, bytes for what has none."""

    def __init__(self, ids: dict[str, int], scores: dict[str, float], byte_ids: dict[int, int], unknown: int):
        self.ids, self.scores, self.byte_ids, self.unknown = ids, scores, byte_ids, unknown

    def __call__(self, word: str) -> list[int]:
        parts = self.short(list(word)) if len(word) <= 64 else self.long(word)
        out = list(map(self.ids.get, parts))
        if None not in out:
            return out
        out = []
        for p in parts:
            i = self.ids.get(p)
            if i is not None:
                out.append(i)
            elif self.byte_ids:
                out += [self.byte_ids[x] for x in p.encode()]
            else:
                out.append(self.unknown)
        return out

    def short(self, parts: list[str]) -> list[str]:
        get, none = self.scores.get, -math.inf
        scores = list(map(get, map(operator.add, parts, parts[1:]), itertools.repeat(none)))
        while scores and (best := max(scores)) > none:
            at = scores.index(best)     # the leftmost of equals
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at < len(scores):
                scores[at] = get(parts[at] + parts[at + 1], none)
            if at:
                scores[at - 1] = get(parts[at - 1] + parts[at], none)
        return parts

    def long(self, word: str) -> list[str]:
        """The same with a heap, for words of any length."""
        n = len(word)
        part: list[str | None] = list(word)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        get, heap = self.scores.get, []

        def push(i: int) -> None:
            j = after[i]
            if j < n and (s := get(part[i] + part[j])) is not None:
                heap.append((-s, i, len(part[i]), len(part[j])))

        for i in range(n - 1):
            push(i)
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if part[i] is None or len(part[i]) != a or j >= n or part[j] is None or len(part[j]) != b:
                continue
            part[i] += part[j]
            part[j] = None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (s := get(part[k] + part[after[k]])) is not None:
                    heapq.heappush(heap, (-s, k, len(part[k]), len(part[after[k]])))
        return [p for p in part if p is not None]


_STATE: dict[str, tuple] = {}


class Encoder:
    """Bytes of the ids (little-endian u32) of texts, in a task.  A word of the table that starts with
    ``SPACE`` is cut nowhere when it stands alone, so a part is looked up there before it is cut."""

    def __init__(self, shared):
        key, model, words, ids, ends = shared
        if key not in _STATE:
            _STATE.clear()
            raw, bounds = ids.tobytes(), (4 * ends).tolist()
            # words that start with SPACE are kept without it: a part that is one needs no cutting
            first, table = {}, {}
            for w, a, b in zip(words, [0, *bounds], bounds, strict=False):
                if w[0] == SPACE:
                    first[w[1:]] = raw[a:b]
                else:
                    table[w] = raw[a:b]
            merger = Merger(model.ids, {p: model.scores[i] for p, i in model.ids.items()}, model.bytes, model.unknown)
            _STATE[key] = (first, table, merger, word_pattern(model.signs), {}, {})
        self.first, self.table, self.merger, self.pattern, self.cache, self.known = _STATE[key]

    def _rest(self, word: str) -> bytes:
        got = self.cache.get(word)
        if got is None:
            ids = self.merger(word)
            got = struct.pack(f"<{len(ids)}I", *ids)
            if len(word) <= WORD_CHARS:
                if len(self.cache) >= CACHE_WORDS:
                    self.cache.clear()
                self.cache[word] = got
        return got

    def _words(self, normal: str) -> bytes:
        first, get, rest = self.first.get, self.table.get, self._rest
        return b"".join([(first(w[1:]) if w[0] == SPACE else get(w)) or rest(w) for w in self.pattern.findall(normal)])

    def _part(self, part: str) -> bytes:
        """Of a part that is no word of the table, met for the first time."""
        if part.isalpha():
            return self._rest(SPACE + part)     # remembered there
        got = self._words(SPACE + part)
        if len(part) <= WORD_CHARS:
            if len(self.known) >= CACHE_PARTS:
                self.known.clear()
            self.known[part] = got
        return got

    def __call__(self, text: str) -> bytes:
        if (cut := parts(text)) is None:
            return self._words(normalised(text))
        first, get, new = self.first.get, self.known.get, self._part
        return b"".join([first(x) or get(x) or new(x) for x in cut])


class Decoder:
    def __init__(self, model: Pieces):
        self.parts = [p.replace(SPACE, " ").encode() for p in model.text]
        for value, i in model.bytes.items():
            self.parts[i] = bytes([value])
        for i in model.control:
            self.parts[i] = b""
        self.table = pa.array(self.parts, pa.binary())

    def texts(self, ids: list[bytes]) -> list[bytes]:
        """What the ids (little-endian u32) of several texts stand for, in one look-up."""
        got = pa.DictionaryArray.from_arrays(pa.array(np.frombuffer(b"".join(ids), "<i4")), self.table).dictionary_decode()
        bounds = np.frombuffer(got.buffers()[1], np.int32)[np.cumsum([0, *(len(x) // 4 for x in ids)])].tolist() if len(got) else [0] * (len(ids) + 1)
        raw = memoryview(got.buffers()[2] or b"")
        return [bytes(raw[a + (raw[a:a + 1] == b" "):b]) if a < b else b"" for a, b in zip(bounds, bounds[1:], strict=False)]

    def __call__(self, ids) -> bytes:
        raw = b"".join(map(self.parts.__getitem__, ids))
        return raw[1:] if raw[:1] == b" " else raw


def _shared(docs: DataFrame, text: str, model: Pieces, limit: int):
    """The broadcast: the model and the word table, whose size ``limit`` bounds."""
    import uuid
    got = S.table(word_table(docs, text, model, limit), "word-ids").toArrow()
    ids = got["ids"].combine_chunks() if got.num_rows else pa.array([], pa.list_(pa.int32()))
    ends = np.cumsum(pa.compute.list_value_length(ids).to_numpy(zero_copy_only=False).astype(np.int64)) if len(ids) else np.zeros(0, np.int64)
    return docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, model, got["word"].to_pylist(), np.asarray(ids.flatten(), np.uint32), ends))


def encode(docs: DataFrame, model_path: str, text: str = "text", name: str = "ids", table_words: int = TABLE_WORDS) -> DataFrame:
    """``docs`` without its text and with its ids, an array of ints, in place of a column of that
    name."""
    S.prepare(docs.sparkSession)
    shared = _shared(docs, text, Pieces(model_path), table_words)
    keep = [c for c in docs.columns if c not in (text, name)]

    def run(batches):
        encoder = Encoder(shared.value)
        for b in batches:
            i = 0
            while i < b.num_rows:
                ids, j, size = [], i, 0
                while j < b.num_rows and size < S.CHUNK_BYTES:
                    t = b.column(0)[j].as_py() or ""
                    ids.append(encoder(t))
                    size += len(t) + 1
                    j += 1
                ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
                flat = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4")))
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in b.columns[1:]), flat], names=[*keep, name])
                i = j

    kept = [F.col(f"`{c}`") for c in keep]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema), f"`{name}` array<int>"])
    return docs.select(F.col(f"`{text}`").cast("string").alias("_text_"), *kept).mapInArrow(run, schema)


def decode(encoded: DataFrame, model_path: str, ids: str = "ids", name: str = "text") -> DataFrame:
    """``encoded`` without its ids and with the text they stand for."""
    S.prepare(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast(Pieces(model_path))
    keep = [c for c in encoded.columns if c not in (ids, name)]

    def run(batches):
        decoder = Decoder(shared.value)
        for b in batches:
            texts = [decoder(x.values.to_pylist() if x.is_valid else []).decode("utf-8", "replace") for x in b.column(0)]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(texts, pa.string())], names=[*keep, name])

    kept = [F.col(f"`{c}`") for c in keep]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.select(*kept).schema), f"`{name}` string"])
    return encoded.select(F.col(f"`{ids}`"), *kept).mapInArrow(run, schema)


def digests(docs: DataFrame, model_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (of the ids as little-endian u32), decoded_crc32 (of the UTF-8
    text that the ids decode to) and round_trip: whether that is the text."""
    S.prepare(docs.sparkSession)
    model = Pieces(model_path)
    shared = _shared(docs, text, model, TABLE_WORDS)

    def run(batches):
        encoder, decoder = Encoder(shared.value), Decoder(shared.value[1])
        for b in batches:
            out, i = [], 0
            while i < b.num_rows:
                texts, size = [], 0
                while i < b.num_rows and size < S.CHUNK_BYTES:
                    texts.append(b.column(1)[i].as_py() or "")
                    size += len(texts[-1]) + 1
                    i += 1
                ids = [encoder(t) for t in texts]
                out += [(len(x) // 4, zlib.crc32(x), zlib.crc32(back), back == t.encode()) for t, x, back in zip(texts, ids, decoder.texts(ids), strict=True)]
            n, crc, decoded, same = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(decoded, pa.int64()), pa.array(same, pa.bool_())],
                                             names=["doc_id", "n_tokens", "ids_crc32", "decoded_crc32", "round_trip"])

    src = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, decoded_crc32 long, round_trip boolean")


def op5_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Every document of the whole ``documents`` table encoded and decoded."""
    import public_tokenizers
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"))
