"""op2, op5 and op6: exact round trips against the libraries and plain recomputation."""

import base64
import hashlib
import os
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidecast.llm import pieces, token_store, warc

BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BITS = ["a", "I", "İ", "̇", "́", "É", "ß", " ", "\n", "\t", "\x0b", "\x1c", "\x85", "the", "Ing", ".", ",", "!!", "'s", "'S", "12", "中", "ﬁ", "😀", " ", "<|endoftext|>", "<|ENDOFTEXT|>",
        "Σ", "|", "»", "_", "-", "▁", "<s>", " ", "x" * 70, "abc" * 25, "\r"]


def texts(seed, n=300):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(BITS) for _ in range(rnd.randrange(0, 12))) for _ in range(n)]


# ---------------------------------------------------------------- op2

PAGES = [(1, "http://a/1", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (7, "http://a/7", "<p>same</p>"), (3, "http://b/\r\nX: y", "é"), (4, None, None), (5, "u", ""), (6, "u", "long" * 50_000), (6, "u", "long" * 50_000)]


def expected(rows):
    by = {}
    for i, _, h in rows:
        by.setdefault((h or "").encode(), []).append(i)
    for i, _, h in rows:
        b = (h or "").encode()
        top = max(by[b])
        yield i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if i == top else "revisit", None if i == top else top


def pages(spark, rows, path):
    spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, digest string, offset int").repartition(3).write.parquet(f"{path}/pages.parquet")
    return str(path)


def test_warc_rows(spark, tmp_path):
    got = [tuple(r) for r in warc.op2_warc(spark, pages(spark, PAGES, tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(expected(PAGES), key=repr)


def test_warc_matches_sql(spark, tmp_path):
    d = pages(spark, PAGES, tmp_path)
    got = sorted(map(tuple, warc.op2_warc(spark, d).collect()), key=repr)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{d}/pages.parquet/*.parquet')")
    assert got == sorted(con.execute(warc.ORACLE_SQL).fetchall(), key=repr)


def test_warc_empty_table(spark, tmp_path):
    assert warc.op2_warc(spark, pages(spark, [], tmp_path)).collect() == []


def test_warc_selected_records_and_ranges(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"page {i} " * (i % 50)) for i in range(400)]
    index = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4), str(tmp_path / "w"))
    assert index.count() == 400
    some = index.filter(F.col("page_id") % 7 == 0)
    for gap, most in ((0, 1 << 30), (1 << 20, 1 << 30), (100, 300)):
        got = {r["page_id"]: bytes(r["payload"]).decode() for r in warc.read_records(some, str(tmp_path / "w"), gap, most).collect() if r["payload"] is not None}
        want = {i: h for i, _, h in rows if i % 7 == 0 and i == max(j for j, _, g in rows if g == h)}
        assert got == want
    near, apart = warc.byte_ranges(some, 1 << 20, 1 << 30).count(), warc.byte_ranges(some, 0, 1 << 30).count()
    assert near <= 4 < apart


def test_warc_small_payloads_are_all_responses(spark, tmp_path):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")]
    index = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "w"), least=5)
    assert {r["page_id"]: r["record_type"] for r in index.collect()} == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_warc_damage_is_seen(spark, tmp_path):
    with pytest.raises(ValueError):
        warc.parse_record(b"nothing")


# ---------------------------------------------------------------- op6

@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 511, 512, 513, 5000])
def test_dac_random_access(n):
    rnd = np.random.RandomState(n)
    ids = np.where(rnd.rand(n) < 0.5, rnd.randint(0, 256, n), rnd.randint(0, 1 << 31, n)).astype(np.uint32)
    dac = token_store.Dac(token_store.encode_dac(ids))
    at = rnd.randint(0, n, 3 * n) if n else np.zeros(0, int)
    assert dac.get(at).tolist() == ids[at].tolist()
    for _ in range(20):
        a, b = sorted(rnd.randint(0, n + 1, 2))
        assert dac.run(a, b).tolist() == ids[a:b].tolist()
    with pytest.raises(IndexError):
        dac.get(np.array([n]))


def test_words_encode_as_the_library():
    with open(BPE) as f:
        model = f.read()
    assert token_store.splits_words(model)
    encode, tok = token_store.word_ids(model), Tokenizer.from_str(model)
    for t in texts(5, 3000):
        assert np.frombuffer(encode([t.encode()])[0], "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, t


def test_word_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(token_store, "CACHE_WORDS", 40)
    with open(BPE) as f:
        model = f.read() + " "
    encode, tok = token_store.word_ids(model), Tokenizer.from_str(model)
    for i in range(30):
        t = " ".join(f"w{j}" for j in range(i, i + 15))
        assert np.frombuffer(encode([t.encode()])[0], "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids
        _, _, young, old = token_store._TOKENIZERS[hash(model)]
        assert len(young) <= 20 and len(old) <= 20


def test_words_learnt_together_encode_as_each_alone(monkeypatch):
    """New words reach the library as one text with a special token between them."""
    with open(BPE) as f:
        model = f.read() + "\n"
    tok, calls = Tokenizer.from_str(model), []
    sign, number = token_store._separator(tok, model)
    assert number == tok.token_to_id(sign)
    encode = token_store.word_ids(model)
    library, *rest = token_store._TOKENIZERS[hash(model)]

    class Counted:
        def encode_batch_fast(self, texts, **options):
            calls.append(len(texts))
            return library.encode_batch_fast(texts, **options)

    monkeypatch.setitem(token_store._TOKENIZERS, hash(model), (Counted(), *rest))
    words = sorted({w for t in texts(6, 2000) for w in t.lower().split() if "<|" not in w})
    got = token_store.word_ids(model)([" ".join(words).encode()])[0]
    assert np.frombuffer(got, "<u4").tolist() == [i for w in words for i in tok.encode(w, add_special_tokens=False).ids]
    assert set(calls) == {1} and len(calls) < len(words) / 100 + 1 and encode([b""]) == [b""]


def token_rows(rows):
    tok, at = Tokenizer.from_file(BPE), 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        yield i, at, len(ids), zlib.crc32(ids.tobytes())
        at += len(ids)


def documents(spark, rows, path, parts=4):
    spark.createDataFrame([(*r, 3, "s", 1) for r in rows], "doc_id long, text string, shard int, ids string, start int").repartition(parts).write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_token_store_rows(spark, tmp_path):
    rows = [(i * 3, t if i % 11 else None) for i, t in enumerate(texts(6))] + [(100_000, "the word " * 40_000)]
    got = [tuple(r) for r in token_store.op6_token_store(spark, documents(spark, rows, tmp_path)).collect()]
    assert sorted(got) == sorted(token_rows(rows))


def test_token_store_repeated_and_null_ids(spark, tmp_path):
    rows = [(None, "null id"), (4, "b"), (4, "a a"), (4, "b"), (1, "x"), (9, "")]
    got = sorted((tuple(r) for r in token_store.op6_token_store(spark, documents(spark, rows, tmp_path)).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, 1, 4, 4, 4, 9]
    assert [r[1] for r in got] == np.cumsum([0, *(r[2] for r in got[:-1])]).tolist()
    assert sorted(r[2:] for r in got) == sorted(r[2:] for r in token_rows(rows))


def test_token_store_empty_table(spark, tmp_path):
    assert token_store.op6_token_store(spark, documents(spark, [], tmp_path)).collect() == []


def test_tokens_read_back(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(texts(8, 60))]
    index = token_store.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path / "t"), BPE, partitions=3)
    tok = Tokenizer.from_file(BPE)
    got = {r["doc_id"]: list(r["ids"]) for r in token_store.read_tokens(index, str(tmp_path / "t")).collect()}
    assert got == {i: [*tok.encode(t, add_special_tokens=False).ids, 1] for i, t in rows}


def test_tokenizer_that_keeps_white_space_is_encoded_whole(spark, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path) as f:
        assert not token_store.splits_words(f.read())
    rows = [(1, "a  b\n\nc"), (2, " the end. ")]
    index = token_store.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path / "t"), path, end_id=50256, partitions=1)
    tok = Tokenizer.from_file(path)
    got = {r["doc_id"]: list(r["ids"]) for r in token_store.read_tokens(index, str(tmp_path / "t")).collect()}
    assert got == {i: [*tok.encode(t, add_special_tokens=False).ids, 50256] for i, t in rows}


def test_files_are_moved_into_place(spark, tmp_path):
    token_store.write_tokens(spark.createDataFrame([(1, "a")], "doc_id long, text string"), str(tmp_path / "t"), BPE, partitions=2)
    assert all(not f.startswith("_shard") for f in os.listdir(tmp_path / "t"))


# ---------------------------------------------------------------- op5

def test_pieces_equal_the_library():
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    m = pieces.Pieces(PIECES)
    merger = pieces.Merger(m.ids, {p: m.scores[i] for p, i in m.ids.items()}, m.bytes, m.unknown)
    pattern, decoder = pieces.word_pattern(m.signs), pieces.Decoder(m)
    for t in texts(7, 3000):
        ids = [i for w in pattern.findall(pieces.normalised(t)) for i in merger(w)]
        assert ids == sp.encode(t), t
        assert decoder(ids).decode() == sp.decode(ids) == t.replace("▁", " ")


def test_parts_between_spaces_hold_the_words_of_the_text(monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_PARTS", 7)
    m = pieces.Pieces(PIECES)
    pattern, decoder = pieces.word_pattern(m.signs), pieces.Decoder(m)
    merger = pieces.Merger(m.ids, {p: m.scores[i] for p, i in m.ids.items()}, m.bytes, m.unknown)
    encoder = pieces.Encoder(("parts", m, [], np.zeros(0, np.uint32), np.zeros(0, np.int64)))
    some = [*texts(8, 2000), "a b. c", "a \n b", " a", "a ", "a  b", "a▁ b", "\n", " "]
    rnd = random.Random(9)
    some += [" ".join(rnd.choice([x for x in BITS if x not in " ▁"]) + rnd.choice(["", ".", "\n", "a"]) for _ in range(9)) for _ in range(300)]
    coded, whole = [encoder(t) for t in some], 0
    for t, ids in zip(some, coded, strict=True):
        words = pattern.findall(pieces.normalised(t))
        assert np.frombuffer(ids, "<u4").tolist() == [i for w in words for i in merger(w)], t
        if (cut := pieces.parts(t)) is not None:
            whole += 1
            assert [w for x in cut for w in pattern.findall(pieces.SPACE + x)] == words, t
    assert whole > 300
    assert decoder.texts(coded) == [decoder(np.frombuffer(x, "<u4").tolist()) for x in coded] and decoder.texts([b"", b""]) == [b"", b""]


def test_encode_and_decode_in_spark(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = [(i, t if i % 13 else None, "keep", "x") for i, t in enumerate(texts(9, 200))] + [(None, "the same the same", "k", "x")] * 2 + [(999, "z" * 30_000, "k", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string, ids string")
    coded = pieces.encode(docs, PIECES, table_words=150)
    assert coded.columns == ["doc_id", "word", "ids"]
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], list(r["ids"])) for r in coded.collect())
    assert got == sorted((-1 if r[0] is None else r[0], sp.encode(r[1] or "")) for r in rows)
    back = sorted(r["text"] for r in pieces.decode(coded, PIECES).collect())
    assert back == sorted((r[1] or "").replace("▁", " ") for r in rows)


def test_op5_rows(spark, tmp_path):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = [(i, t) for i, t in enumerate(texts(10, 150))] + [(900, None)]
    got = {r["doc_id"]: r for r in pieces.op5_sentencepiece(spark, documents(spark, rows, tmp_path)).collect()}
    for i, t in rows:
        ids = np.array(sp.encode(t or ""), "<u4")
        back = (t or "").replace("▁", " ")
        assert tuple(got[i])[1:] == (len(ids), zlib.crc32(ids.tobytes()), zlib.crc32(back.encode()), back == (t or ""))


def test_op5_empty_table(spark, tmp_path):
    assert pieces.op5_sentencepiece(spark, documents(spark, [], tmp_path)).collect() == []


def test_lattice_merges_equal_the_task(spark):
    m = pieces.Pieces(PIECES)
    merger = pieces.Merger(m.ids, {p: m.scores[i] for p, i in m.ids.items()}, m.bytes, m.unknown)
    rnd = random.Random(1)
    words = list({"▁" * rnd.randrange(0, 4) + "".join(rnd.choice("theringoa,.é") for _ in range(rnd.randrange(1, 14))) for _ in range(300)})
    df = spark.createDataFrame([(w,) for w in words], "word string")
    for most in (1_000_000, 10):      # the piece table broadcast, or joined by shuffle
        cut = pieces.lattice(df, m.table(spark), m.longest, broadcast_pieces=most)
        got = {r["word"]: list(r["ids"]) for r in cut.select("word", pieces.merges().alias("ids")).collect()}
        assert got == {w: merger(w) for w in words}


def test_viterbi_equals_brute_force(spark):
    rnd = random.Random(3)
    table = {p: round(-rnd.random() * 5, 3) for p in {"".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 4))) for _ in range(25)} | {"a", "b"}}
    table.pop("c", None)
    names = sorted(table)
    df = spark.createDataFrame(pa.table({"piece": names, "id": pa.array(range(len(names)), pa.int32()), "score": [table[p] for p in names]}))
    words = list({"".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 9))) for _ in range(60)})
    cut = pieces.lattice(spark.createDataFrame([(w,) for w in words], "word string"), df, 3)
    got = {r["word"]: r["ids"] for r in cut.select("word", pieces.viterbi().alias("ids")).collect()}

    def best(w):
        found = [(0.0, [])] if not w else []
        for n in range(1, min(3, len(w)) + 1):
            if w[:n] in table and (rest := best(w[n:])) is not None:
                found.append((table[w[:n]] + rest[0], [names.index(w[:n]), *rest[1]]))
        return max(found, key=lambda x: x[0]) if found else None

    for w in words:
        want, ids = best(w), got.get(w)
        if want is None:
            assert ids is None
        else:
            assert "".join(names[i] for i in ids) == w and abs(sum(table[names[i]] for i in ids) - want[0]) < 1e-9


def test_plain_words_are_encoded_by_the_model():
    with open(BPE, encoding="utf-8") as f:
        model = f.read()
    tok, rnd, held = Tokenizer.from_str(model), random.Random(31), token_store._PLAIN_LETTERS
    cut, signs, number = token_store._byte_model(tok)
    words = ["".join(rnd.choice(held) for _ in range(rnd.randrange(1, 15))) for _ in range(300)]
    assert [b"".join(number[t.id] for t in cut(w.encode().decode("latin-1").translate(signs))) for w in words] == [np.array(e.ids, "<u4").tobytes() for e in tok.encode_batch(words, add_special_tokens=False)]
    assert all(token_store._PLAIN.fullmatch(w.encode()) for w in words) and not any(token_store._PLAIN.fullmatch(w.encode()) for w in ("é.", "É", "a÷", "A", "1", "ā"))
    # a library that changes plain letters before its model sees them is asked for every word
    odd = Tokenizer.from_str(model.replace('"type":"NFC"', '"type":"NFD"').replace('"type": "NFC"', '"type": "NFD"'))
    assert odd.encode("é", add_special_tokens=False).ids != tok.encode("é", add_special_tokens=False).ids and token_store._byte_model(odd) is None


def test_a_call_of_the_encoder_looks_a_word_up_once():
    with open(BPE, encoding="utf-8") as f:
        model = f.read()
    tok, encode = Tokenizer.from_str(model), token_store.word_ids(model)
    many = ["  the\tzoo \n", "", "the zoo. the, <|endoftext|> zoo", " ", "zoo\x0bzöo.a ÉA.b", "the zoo.."] * 3
    assert encode([t.encode() for t in many]) == [np.array(e.ids, "<u4").tobytes() for e in tok.encode_batch(many, add_special_tokens=False)]


def test_words_of_the_table_are_found_without_a_cut():
    m, lib = pieces.Pieces(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    merger = pieces.Merger(m.ids, {p: m.scores[i] for p, i in m.ids.items()}, m.bytes, m.unknown)
    words = ["▁und", "und", "&&&", "▁größer", "▁▁x", "▁a_b", "▁"]
    ids = [merger(w) for w in words]
    encoder = pieces.Encoder(("table", m, words, np.array([i for x in ids for i in x], np.uint32), np.cumsum([len(x) for x in ids])))
    for t in ["und größer", "und&&& größer.und  x", "größer  x a_b", "a_b ", "▁und", "und ½² x²y", "日本 ßÿund 12und"]:
        assert np.frombuffer(encoder(t), "<u4").tolist() == lib.encode(t)
    encoder.pattern = None
    assert np.frombuffer(encoder("und a_b größer neuesWort"), "<u4").tolist() == lib.encode("und a_b größer neuesWort")
