"""Substring dedup over bytes by a run-length index of the corpus' repeated phrases.

The texts are parsed into phrases at anchors chosen from their content (as in prefix-free
parsing, the usual way to build a run-compressed Burrows-Wheeler transform of a repetitive
corpus): each phrase is named once, and only distinct phrases whose anchor recurs are indexed.
``RunLengthIndex`` holds their transform as runs, with the suffix-array sample of every run end
and the places where neighbours in suffix order share fewer than ``LENGTH`` bytes.  Streaming
all phrases through it from their right ends (one LF step on the runs per byte, for all phrases
at once) gives, per byte, whether the match that starts there is at least ``LENGTH`` long and
the smallest document that holds it.

A byte goes if a ``LENGTH``-byte string that covers it also starts in a document with a smaller
doc_id; texts are UTF-8, matches never cross documents and are judged on the input.

Defined results: a null or empty text has 0 bytes; texts shorter than ``LENGTH`` keep all;
repeated rows and rows with equal doc_id do not remove each other's bytes; a null doc_id is
smaller than every other; an empty table gives no rows; other columns are ignored.  A cut may
split a character of several bytes, so the kept text is binary.

Equal phrases and windows are told by 64-bit hashes of their bytes within one anchor's group.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from . import _repeats as R, _shared as S

LENGTH = 50
#: Bytes of the string whose hash chooses a window's anchor, and the least context on one side
#: of it that the windows of a context group share.
ANCHOR, SIDE = 20, 15
_SPAN = LENGTH - ANCHOR + 1
LOW = np.uint64((1 << 32) - 1)


def _slide_min(v: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours."""
    n, span = len(v) - width + 1, 1
    while span * 2 <= width:
        v = np.minimum(v[:-span], v[span:])
        span *= 2
    return np.minimum(v[:n], v[width - span:width - span + n])


def parse(off: np.ndarray, data: np.ndarray) -> R.Phrases:
    """Phrases of a chunk: the windows with one anchor, the rightmost of the ANCHOR-byte strings
    with the smallest hash in the window."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return R.Phrases(none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    sums = S.prefix(S.BYTE_VALUE[data])
    grams = _grams(sums, slice(0, n - ANCHOR + 1), slice(ANCHOR, n + 1))
    # the place in the low half: of equal upper halves the rightmost wins, wherever the text lies
    best = _slide_min((grams & ~LOW) | (LOW - np.arange(len(grams), dtype=np.uint64)), _SPAN)
    # the last windows of a row cross its end, so no run goes on in the next row
    ok = np.repeat(off[1:], np.diff(off))[:len(best)] - np.arange(len(best)) >= LENGTH
    a, b = R.runs_of(best, ok)
    anchor = S.mix(grams[(LOW - (best[a] & LOW)).astype(np.int64)])
    row = np.searchsorted(off, a, "right") - 1
    return R.Phrases(row, a - off[row], b - a, anchor, S.span_hash(sums, a, b + LENGTH - 1))


def _grams(sums: np.ndarray, start, end) -> np.ndarray:
    """Hashes of the ANCHOR-byte strings; only their upper halves are well spread."""
    return (sums[end] - sums[start]) * S.inverse_powers(len(sums))[start]


def cutter(off: np.ndarray, data: np.ndarray, row: np.ndarray, at: np.ndarray, windows: np.ndarray):
    """Parts of the phrases by the side on which all their windows have SIDE bytes beside the
    anchor."""
    sums = S.prefix(S.BYTE_VALUE[data])
    begin = off[row] + at
    spot = np.empty(len(at), np.int64)
    for i in range(0, len(at), 20_000):
        # the strings that every window of the phrase holds; the same choice as in parse
        place = np.arange(_SPAN)
        inside = place >= windows[i:i + 20_000, None] - 1
        start = (begin[i:i + 20_000, None] + place).ravel()
        upper = np.where(inside, _grams(sums, start, start + ANCHOR).reshape(inside.shape) & ~LOW, ~np.uint64(0))
        spot[i:i + 20_000] = _SPAN - 1 - np.argmin(upper[:, ::-1], axis=1)
    # windows from here on have SIDE bytes to the right of the anchor, those before to its left
    split = np.clip(spot + ANCHOR + SIDE - LENGTH, 0, windows)
    left, right = np.flatnonzero(split > 0), np.flatnonzero(split < windows)
    anchor = begin + spot
    context = np.concatenate([S.span_hash(sums, anchor[left] - SIDE, anchor[left] + ANCHOR) ^ np.uint64(1), S.span_hash(sums, anchor[right], anchor[right] + ANCHOR + SIDE)])
    phrase = np.concatenate([left, right])
    first = np.concatenate([np.zeros(len(left), np.int64), split[right]])
    count = np.concatenate([split[left], (windows - split)[right]])
    start = begin[phrase] + first
    return phrase, S.signed(context), first, count, S.gather(data, start, start + count + LENGTH - 1)


class RunLengthIndex:
    """Run-compressed Burrows-Wheeler transform of byte strings (each ended by a separator)."""

    def __init__(self, strings: list[bytes], length: int = LENGTH):
        sizes = np.array([len(s) for s in strings], np.int64)
        self.end = np.cumsum(sizes + 1) - 1             # places of the separators
        self.start = self.end - sizes
        text = np.zeros(int(self.end[-1]) + 1, np.int64)
        body = np.frombuffer(b"".join(strings), np.uint8)
        inside = np.ones(len(text), bool)
        inside[self.end] = False
        text[inside] = body.astype(np.int64) + 1
        order, rank = suffix_order(text)
        bwt = text[order - 1]
        new = R.group_starts(bwt)
        self.head = np.flatnonzero(new)                 # first row of each run
        self.char = bwt[self.head]                      # its byte
        self.sample = order[np.append(self.head[1:], len(order)) - 1]   # suffix at its last row
        size = np.diff(np.append(self.head, len(bwt)))
        by = np.argsort(self.char, kind="stable")
        # rows of suffixes that begin with the run's byte: smaller bytes, then earlier runs
        self.lf0 = np.empty(len(by), np.int64)
        self.lf0[by] = np.cumsum(size[by]) - size[by]
        # classes of rows whose suffixes share ``length`` bytes of one string
        left = np.repeat(self.end, sizes + 1) - np.arange(len(text))
        long = left[order] >= length
        sums = S.prefix(S.BYTE_VALUE[body if len(body) else np.zeros(0, np.uint8)])
        before = np.cumsum(inside) - inside             # place in the joined bytes
        at = before[order]
        h = np.zeros(len(order), np.uint64)
        h[long] = S.span_hash(sums, at[long], at[long] + length)
        same = np.zeros(len(order), bool)
        same[1:] = long[1:] & long[:-1] & (h[1:] == h[:-1])
        self.of_class = np.cumsum(~same) - 1
        self.class_head = np.flatnonzero(~same)
        self.order = order
        self.first_row = rank[self.end]

    def lf(self, rows: np.ndarray) -> np.ndarray:
        """Rows of the suffixes one byte longer to the left."""
        run = np.searchsorted(self.head, rows, "right") - 1
        return self.lf0[run] + rows - self.head[run]

    def first_documents(self, docs: np.ndarray) -> np.ndarray:
        """Smallest document of each class; ``docs`` belong to the strings."""
        owner = np.repeat(docs, self.end - self.start + 1)
        return np.minimum.reduceat(owner[self.order], self.class_head)

    def stream(self, length: int = LENGTH):
        """Matching statistics, right to left and for all strings at once: yields (strings,
        places in them, classes) where ``length`` bytes are left to match."""
        sizes = self.end - self.start
        who = np.argsort(-sizes, kind="stable")
        rows = self.first_row[who]
        most = sizes[who]
        for step in range(1, int(most[0]) + 1 if len(most) else 1):
            live = int(np.searchsorted(-most, -step, "right"))      # strings with so many bytes
            rows = self.lf(rows[:live])
            if step >= length:
                yield who[:live], most[:live] - step, self.of_class[rows]


def suffix_order(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and ranks of ``text`` (0 to 256) by prefix doubling from seven symbols."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(7, np.int64)])
    key = np.zeros(n, np.int64)
    for k in range(7):
        key = (key << 9) | padded[k:k + n]
    step = 7
    while True:
        order = np.argsort(key, kind="stable")
        s = key[order]
        new = np.ones(n, bool)
        new[1:] = s[1:] != s[:-1]
        number = np.cumsum(new) - 1
        rank = np.empty(n, np.int64)
        rank[order] = number
        if number[-1] == n - 1:
            return order, rank
        after = np.full(n, -1, np.int64)
        if step < n:
            after[:n - step] = rank[step:]
        key = rank * (n + 1) + after + 1
        step *= 2


def resolve(payloads: list[bytes], docs: np.ndarray, windows: np.ndarray) -> np.ndarray:
    index = RunLengthIndex(payloads)
    best = index.first_documents(docs)
    base = np.cumsum(windows) - windows
    out = np.empty(int(windows.sum()), np.int64)
    for who, place, of_class in index.stream():
        out[base[who] + place] = best[of_class]
    return out


def remover(text, spans):
    raw = text.to_pybytes()
    runs, at, kept = R.disjoint(spans), 0, []
    for s, e in runs:
        kept.append(raw[at:s])
        at = e
    kept.append(raw[at:])
    return len(raw), sum(e - s for s, e in runs), len(runs), b"".join(kept)


def remove_repeated_bytes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (all but the text) with n_units, n_removed, n_spans and the ``kept``
    bytes of every document."""
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    return R.remove_repeats(docs, doc_id, text, keep, length=LENGTH, parse=parse, cutter=cutter, resolve=resolve, remover=remover, name="bytes")


def op4_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract rows of op4 over the whole ``documents`` table."""
    found = remove_repeated_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep=["doc_id"])
    return found.select("doc_id", F.col("n_units").alias("n_bytes"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


#: The same from every string of 50 bytes, written in hexadecimal: a byte is covered if a repeated
#: string starts at most 49 bytes before it.
ORACLE_SQL = """
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
c AS (SELECT doc_id, n, k, substr(hx, 512 * k + 1, 512 + 98) AS part FROM (SELECT doc_id, n, hx, unnest(range(0, (n + 255) // 256)) AS k FROM b)),
u AS (SELECT doc_id, x.j AS j, x.byte AS byte, x.h AS h FROM (SELECT doc_id, unnest(list_transform(range(1, least(256, n - 256 * k) + 1), lambda i:
    {'j': 256 * k + i, 'byte': substr(part, 2 * i - 1, 2), 'h': CASE WHEN 256 * k + i + 49 <= n THEN hash(substr(part, 2 * i - 1, 100)) END})) AS x FROM c)),
f AS (SELECT h, min(doc_id) AS low FROM u WHERE h IS NOT NULL GROUP BY h),
m AS (SELECT u.doc_id, j, byte, coalesce(max(CASE WHEN low < u.doc_id THEN j END) OVER (PARTITION BY u.doc_id ORDER BY j) >= j - 49, false) AS gone FROM u LEFT JOIN f ON f.h = u.h),
e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY j), false) AS begins FROM m),
k AS (SELECT doc_id, count(*) AS n_bytes, count(*) FILTER (gone) AS n_removed, count(*) FILTER (begins) AS n_spans, string_agg(byte, '' ORDER BY j) FILTER (NOT gone) AS kept FROM e GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_bytes, 0)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM documents d LEFT JOIN k ON k.doc_id = d.doc_id
"""
