"""Token ids in directly addressable codes (DAC): random access to any token of a file.

An id is split into chunks of ``CHUNK_BITS`` bits, lowest first.  Level 0 holds the lowest chunk
of every id, level k the k-th chunk of the ids that are that long.  A continuation bitmap per
level says which entries go on in the next one; a rank directory (ones before each block of 512
bits) turns an entry's place into its place there.  No block has to be decoded: token i costs
one look into each of its levels.

File: ``DAC1``, n tokens (u64), n levels (u32), then per level its n entries (u64), entry bytes,
bitmap words (u64 each), rank directory (u64 each), all little-endian.

A document's ids are those of the whole text and the end id.  Files are written per range of
doc_id, so their order is that of the ids; ``start`` is a document's place among all tokens.

Defined results: a null or empty text has only the end id; repeated documents and ids have a
place each, in the order of (doc_id, text); a null doc_id comes first; empty tables give no file
and no row; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from . import _shared as S

CHUNK_BITS = 8
_BLOCK = 512
#: Distinct words whose ids a worker remembers at one time.
CACHE_WORDS = 1_600_000

INDEX_SCHEMA = "doc_id long, shard int, at long, n_tokens long"


# ---------------------------------------------------------------- the code

def encode_dac(ids: np.ndarray) -> bytes:
    """The DAC file of ``ids`` (unsigned, below 2^32)."""
    left, levels = np.asarray(ids, np.uint32), []
    mask = np.uint32((1 << CHUNK_BITS) - 1)
    while True:
        entry = (left & mask).astype(np.uint8)
        rest = left >> np.uint32(CHUNK_BITS)
        more = rest > 0
        words = np.packbits(np.concatenate([more, np.zeros(-len(more) % _BLOCK, bool)]), bitorder="little").view("<u8")
        ones = np.bitwise_count(words).reshape(-1, _BLOCK // 64).sum(1, dtype=np.uint64)
        levels.append((entry, words, np.concatenate([[0], np.cumsum(ones)]).astype("<u8")))
        if not more.any():
            break
        left = rest[more]
    out = [b"DAC1", struct.pack("<QI", len(ids), len(levels))]
    for entry, words, rank in levels:
        out += [struct.pack("<Q", len(entry)), entry.tobytes(), words.tobytes(), rank.tobytes()]
    return b"".join(out)


class Dac:
    """Random access to the ids of a DAC file."""

    def __init__(self, raw: bytes):
        if raw[:4] != b"DAC1":
            raise ValueError("no DAC file")
        self.n, levels = struct.unpack_from("<QI", raw, 4)
        at, self.levels = 16, []
        for _ in range(levels):
            (n,) = struct.unpack_from("<Q", raw, at)
            blocks = -(-n // _BLOCK)
            entry = np.frombuffer(raw, np.uint8, n, at + 8)
            words = np.frombuffer(raw, "<u8", blocks * (_BLOCK // 64), at + 8 + n)
            rank = np.frombuffer(raw, "<u8", blocks + 1, at + 8 + n + words.nbytes)
            at += 8 + n + words.nbytes + rank.nbytes
            self.levels.append((entry, words, rank))

    def get(self, places: np.ndarray) -> np.ndarray:
        """The ids at ``places``, in any order."""
        at = np.asarray(places, np.int64)
        if len(at) and (at.min() < 0 or at.max() >= self.n):
            raise IndexError("no such token")
        out, who = np.zeros(len(at), np.uint32), None
        for k, (entry, words, rank) in enumerate(self.levels):
            part = entry[at].astype(np.uint32) << np.uint32(k * CHUNK_BITS)
            if who is None:
                out = part
            else:
                out[who] |= part
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            here = words[word]
            go = np.flatnonzero((here >> bit) & np.uint64(1))
            if not len(go):
                break
            who = go if who is None else who[go]
            word, bit, here, block = word[go], bit[go], here[go], at[go] // _BLOCK
            before = rank[block].astype(np.int64) + np.bitwise_count(here & ((np.uint64(1) << bit) - np.uint64(1)))
            for d in range(1, _BLOCK // 64):    # whole words of the block before this one
                has = word % (_BLOCK // 64) >= d
                before[has] += np.bitwise_count(words[word[has] - d])
            at = before
        return out

    def run(self, start: int, end: int) -> np.ndarray:
        """The ids of places start..end, each level read as one slice."""
        out, who = None, None
        for k, (entry, words, rank) in enumerate(self.levels):
            part = entry[start:end].astype(np.uint32) << np.uint32(k * CHUNK_BITS)
            if out is None:
                out = part
            else:
                out[who] |= part
            first = start // 64
            bits = np.unpackbits(words[first:-(-end // 64)].view(np.uint8), bitorder="little")[start - 64 * first:end - 64 * first]
            go = np.flatnonzero(bits)
            if not len(go):
                break
            who = go if who is None else who[go]
            block = start // _BLOCK
            part_words = words[block * (_BLOCK // 64):start // 64]
            before = int(rank[block]) + int(np.bitwise_count(part_words).sum())
            if start % 64:
                before += int(np.bitwise_count(words[start // 64] & np.uint64((1 << (start % 64)) - 1)))
            start, end = before, before + len(go)
        return out


# ---------------------------------------------------------------- encoding texts

_TOKENIZERS: dict[int, tuple] = {}
_SEPARATORS: dict[int, tuple[str, int] | None] = {}
_MODELS: dict[int, tuple | None] = {}


#: A sign after a letter is a token boundary of its own; the apostrophe may start a suffix.
_SIGN_AFTER_LETTER = re.compile(rb"[.,!?;:|%$&*#](?<=[A-Za-z].)")
#: Lower-case letters of ASCII and Latin-1: normalising and cutting leave a run of them as it is.
_PLAIN_LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")


def word_ids(tokenizer_json: str):
    """A function from texts' bytes to their ids as little-endian u32 bytes.

    Only for tokenizers for which ``splits_words`` holds: they lower-case, drop white space and
    never join over it, nor a letter and a following sign.  The parts between are encoded by the
    library each on its own (plain letters by its model alone, ``_byte_model``), and a worker
    remembers those it met last (``CACHE_WORDS`` at most).
    Texts in which a special token may be written are encoded whole."""
    key = hash(tokenizer_json)
    if key not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tok = Tokenizer.from_str(tokenizer_json)
        special = [x["content"].lower().encode() for x in json.loads(tokenizer_json).get("added_tokens", ())]
        _TOKENIZERS[key] = (tok, special, {}, {})
        _SEPARATORS[key] = _separator(tok, tokenizer_json)
        _MODELS[key] = _byte_model(tok)
    (tok, special, young, old), between, model = _TOKENIZERS[key], _SEPARATORS[key], _MODELS[key]

    def library(texts: list[bytes]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in tok.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]

    def one_by_one(words: list[bytes]) -> list[bytes]:
        """The ids of each word, from the model itself where it is plain letters; of the others from
        one text with a special token between them."""
        if model is None:
            return joined(words)
        cut, signs, number = model
        plain, out, rest = _PLAIN.fullmatch, [], []
        for w in words:
            if plain(w):
                out.append(b"".join([number[t.id] for t in cut(w.decode("latin-1").translate(signs))]))
            else:
                out.append(None)
                rest.append(w)
        if rest:
            ids = iter(joined(rest))
            out = [next(ids) if x is None else x for x in out]
        return out

    def joined(words: list[bytes]) -> list[bytes]:
        if between is None:
            return library(words)
        sign, number = between
        ids = np.array(tok.encode_batch_fast([sign.join([w.decode() for w in words])], add_special_tokens=False)[0].ids, "<u4")
        cuts = np.flatnonzero(ids == number)
        if len(cuts) != len(words) - 1:
            return library(words)
        raw = ids.tobytes()
        return [raw[x:y] for x, y in zip([0, *(4 * cuts + 4).tolist()], [*(4 * cuts).tolist(), len(raw)], strict=True)]

    def known(words) -> list[bytes]:
        """Those of ``words`` that the caches lack; what the old one has moves to the young one."""
        lack = []
        for w in words:
            if (ids := old.get(w)) is None:
                lack.append(w)
            else:
                young[w] = ids
        return lack

    def learnt(words: list[bytes]) -> list[bytes]:
        """The ids of distinct words."""
        ids = list(map(young.get, words))
        new = [w for w, x in zip(words, ids, strict=True) if x is None]
        if not new:
            return ids
        if len(young) + len(new) > CACHE_WORDS // 2:
            old.clear()
            old.update(young)
            young.clear()
        # only words met for the first time are cut at their signs; their parts are mostly known
        lack = known(new)
        cut = {w: x.split(b" ") for w, x in zip(lack, _SIGN_AFTER_LETTER.sub(rb" \g<0>", b"\n".join(lack)).split(b"\n"), strict=True) if len(w) != len(x)} if lack else {}
        whole = [w for w in lack if w not in cut]
        learn = whole + known({x for xs in cut.values() for x in xs}.difference(young, whole))
        for i in range(0, len(learn), 1_000):
            young.update(zip(learn[i:i + 1_000], one_by_one(learn[i:i + 1_000]), strict=True))
        for w, xs in cut.items():
            young[w] = b"".join(map(young.__getitem__, xs))
        return [young[w] if x is None else x for w, x in zip(words, ids, strict=True)]

    def encode(texts: list[bytes]) -> list[bytes]:
        low = [t.lower() for t in texts]
        apart = {i for i, t in enumerate(low) if any(x in t for x in special)}
        # a word is looked up once a call; the texts' ids are taken from those of their words
        words = pc.ascii_split_whitespace(pa.array([b"" if i in apart else t for i, t in enumerate(low)], pa.large_string()))
        coded = words.flatten().dictionary_encode()
        ids = pa.DictionaryArray.from_arrays(coded.indices, pa.array(learnt(coded.dictionary.cast(pa.large_binary()).to_pylist()), pa.large_binary())).dictionary_decode()
        off, data = S.buffers(ids)
        raw, bounds = data.tobytes(), off[words.offsets.to_numpy()].tolist()
        got = [raw[x:y] for x, y in zip(bounds, bounds[1:], strict=False)]
        for i in apart:
            got[i] = library([texts[i]])[0]
        return got

    return encode


def _separator(tok, tokenizer_json: str) -> tuple[str, int] | None:
    """(text, id) of a special token that keeps what stands before and behind it apart, as far as a
    probe shows."""
    ids = lambda t: tok.encode(t, add_special_tokens=False).ids
    for x in json.loads(tokenizer_json).get("added_tokens", ()):
        sign, number = x["content"], x["id"]
        if x.get("special") and not x.get("normalized") and all(ids(f"{a}{sign}{b}") == [*ids(a), number, *ids(b)] for a in ("ab", "é.", "--", "1", "\u0301", "<") for b in ("cd", "'s", "-", "1", "\u0301", ">")):
            return sign, number
    return None


def _byte_model(tok) -> tuple | None:
    """(function from a word in the byte alphabet to its tokens, the alphabet, each id as u32 bytes)
    for words of ``_PLAIN_LETTERS``, if a probe of each letter, pair and some triples shows that the
    library hands such a word to its model whole and as it is."""
    # the byte alphabet of byte-level models: printable bytes stand for themselves, the rest follow 255
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in shown)}
    cut, few = tok.model.tokenize, "aetß" + _PLAIN_LETTERS[-12::3]
    probe = [*_PLAIN_LETTERS, *(a + b for a in _PLAIN_LETTERS for b in _PLAIN_LETTERS), *(a + b + c for a in few for b in few for c in few), "therefore", "größenwahn", "évènement", _PLAIN_LETTERS]
    try:
        got = [[t.id for t in cut(w.encode().decode("latin-1").translate(signs))] for w in probe]
    except Exception:   # a model that does not know the alphabet
        return None
    if got != [e.ids for e in tok.encode_batch_fast(probe, add_special_tokens=False)]:
        return None
    return cut, signs, [struct.pack("<I", i) for i in range(1 + max(tok.get_vocab(True).values()))]


def splits_words(tokenizer_json: str) -> bool:
    """Whether texts may be encoded part by part, as far as a probe shows."""
    from tokenizers import Tokenizer
    tok = Tokenizer.from_str(tokenizer_json)
    ids = lambda t: tok.encode(t, add_special_tokens=False).ids
    spaces = all(ids(f"{a}{s}{b}") == ids(a) + ids(b) and ids(s) == [] for s in (" ", "\n", " \t ", "\r\n") for a, b in (("ab", "cd"), ("1", "2"), ("é.", "'s"), ("--", "-")))
    signs = all(ids(f"the{s}{t}") == ids("the") + ids(f"{s}{t}") for s in ".,!?;:|%$&*#" for t in ("", "!!", "a", "1", "'s", "é"))
    return spaces and signs and ids("AbC É") == ids("abc É") == ids("abc é")


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 1, partitions: int | None = None) -> DataFrame:
    """Encode ``docs`` (doc_id, text), write one DAC file per range of doc_id and return the
    index: doc_id, shard, place in the shard's file, number of tokens with the end id."""
    spark = docs.sparkSession
    S.prepare(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        model = f.read()
    shared, by_part = spark.sparkContext.broadcast(model), splits_words(model)
    end = struct.pack("<I", end_id)

    def write(batches):
        from pyspark import TaskContext
        shard = TaskContext.get().partitionId()
        if by_part:
            encode = word_ids(shared.value)
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer
            whole = Tokenizer.from_str(shared.value)
            encode = lambda texts: [np.array(e.ids, "<u4").tobytes() for e in whole.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]
        ids, at, parts = [], 0, []
        for b in batches:
            # a word is looked up once a chunk: larger ones look up fewer
            for i, j, off, data in S.chunks(b.column(1), 2 * S.CHUNK_BYTES):
                raw = data.tobytes()
                tokens = [t + end for t in encode([raw[x:y] for x, y in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)])]
                n = np.array([len(t) // 4 for t in tokens], np.int64)
                # ids are held in two bytes each where they fit
                joined = np.frombuffer(b"".join(tokens), "<u4")
                ids.append(joined.astype(np.uint16) if joined.max() < 1 << 16 else joined)
                parts.append((b.column(0).slice(i, j - i), at + np.cumsum(n) - n, n))
                at += int(n.sum())
        if not parts:
            return
        S.put_file(folder, f"shard-{shard:06d}.dac", lambda out: out.write(encode_dac(np.concatenate(ids))))
        for doc, start, n in parts:
            yield pa.RecordBatch.from_arrays([doc, pa.array(np.full(len(n), shard, np.int32)), pa.array(start), pa.array(n)], names=["doc_id", "shard", "at", "n_tokens"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # the text's hash splits the rows of a doc_id that repeats very often
    keys = [F.col("doc_id"), F.xxhash64("text")]
    cut = src.repartitionByRange(partitions, *keys) if partitions else src.repartitionByRange(*keys)
    S.write(cut.sortWithinPartitions("doc_id", F.xxhash64("text"), "text").mapInArrow(write, INDEX_SCHEMA), f"{folder}/index")
    return spark.read.schema(INDEX_SCHEMA).parquet(f"{folder}/index")


def starts(index: DataFrame) -> DataFrame:
    """The index with ``start``, a document's place among the tokens of all files.  Only the
    sums per file, a row for each task that wrote, pass through one task."""
    sums = index.groupBy("shard").agg(F.sum("n_tokens").alias("sum"))
    before = F.coalesce(F.sum("sum").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return index.join(F.broadcast(sums.select("shard", before.alias("before"))), "shard").withColumn("start", F.col("before") + F.col("at"))


def read_tokens(index: DataFrame, folder: str) -> DataFrame:
    """The index rows with ``ids``, read from the files by random access."""
    S.prepare(index.sparkSession)
    columns = index.columns
    spot = {c: columns.index(c) for c in ("shard", "at", "n_tokens")}

    def read(batches):
        f, base = S.filesystem(folder)
        held, dac = None, None
        for b in batches:
            shard, at, n = (b.column(spot[c]).to_pylist() for c in ("shard", "at", "n_tokens"))
            i = 0
            while i < len(shard):
                rows, size = [], 0
                j = i
                while j < len(shard) and size < S.CHUNK_BYTES:
                    if shard[j] != held:
                        with f.open_input_file(f"{base}/shard-{shard[j]:06d}.dac") as source:
                            dac = Dac(source.read())
                        held = shard[j]
                    rows.append(dac.run(at[j], at[j] + n[j]))
                    size += 4 * n[j]
                    j += 1
                ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n[i:j])]).astype(np.int32)), pa.array(np.concatenate(rows).astype(np.int64)))
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in b.columns), ids], names=[*columns, "ids"])
                i = j

    return index.mapInArrow(read, ", ".join([*(f"`{x.name}` {x.dataType.simpleString()}" for x in index.schema), "ids array<long>"]))


def token_digests(index: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32: the checksum of each document's ids as read from the
    files (little-endian u32)."""
    S.prepare(index.sparkSession)

    def read(batches):
        f, base = S.filesystem(folder)
        held, dac = None, None
        for b in batches:
            doc, start, n, shard, at = (c.to_pylist() for c in b.columns)
            crc, i = [], 0
            while i < len(shard):
                if shard[i] != held:
                    with f.open_input_file(f"{base}/shard-{shard[i]:06d}.dac") as source:
                        dac = Dac(source.read())
                    held = shard[i]
                # documents that follow each other in the file are read as one run
                first, end, j = at[i], at[i], i
                while j < len(shard) and shard[j] == held and at[j] == end and (j == i or 4 * (end - first) < S.CHUNK_BYTES):
                    end += n[j]
                    j += 1
                ids = dac.run(first, end).astype("<u4")
                crc += [zlib.crc32(ids[a - first:a - first + m]) for a, m in zip(at[i:j], n[i:j], strict=True)]
                i = j
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return starts(index).select("doc_id", "start", "n_tokens", "shard", "at").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op6_token_store(spark, sf_dir: str) -> DataFrame:
    """Contract rows of op6, read back from the files of the whole ``documents`` table."""
    import public_tokenizers
    folder = S.shared_dir(spark, "tokens")
    index = write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return token_digests(index, folder)
