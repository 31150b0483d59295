"""Substring dedup over words by recompression.

Words get names by their content.  One round names short runs of equal names, further rounds
name pairs of neighbours (a name of class L followed by one of class R), as in recompression;
a name depends only on the words it stands for, so equal passages get equal symbols in all
tasks and documents.  A symbol's bounds depend on at most ``REACH`` words around them, so every
window of ``WINDOW`` words has inner symbols that are equal wherever the window occurs.  The
smallest of them is the window's anchor; phrases whose anchors and ``REACH`` words beside them
are equal meet (``_repeats``), and each window that they share is verified through the names of
its words.

Words are the runs of characters other than space and U+0009 to U+000D, unchanged.  A word goes
if a window that covers it also starts in a document with a smaller doc_id.

Defined results: a null or empty text has no words; documents of fewer than ``WINDOW`` words
keep all; repeated rows and rows with equal doc_id do not remove each other's words; a null
doc_id is smaller than every other; kept words are joined by one space; an empty table gives no
rows; other columns are ignored.

Equal words, phrases and windows are told by 64-bit hashes within one anchor's group.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from . import _repeats as R, _shared as S

WINDOW = 50
#: Longest named run; most words of a symbol after the first and the second pair round.
RUN, PAIR = 3, (6, 8)
#: Words beside a bound on which it can depend: a run's length, then a symbol per round.
REACH = RUN + RUN + PAIR[0]
LOW = np.uint64((1 << 32) - 1)

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def words(off: np.ndarray, data: np.ndarray):
    """(starts, ends, first word of each row) of the words of a chunk."""
    start, end = S.spans_of(~_SPACE[data], off)
    return start, end, np.searchsorted(start, off)


def recompress(names: np.ndarray, row: np.ndarray):
    """Symbols of the words ``names``: first word, last + 1, name, after a run round and the
    pair rounds.  Symbols never cross rows."""
    n = len(names)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), names
    head = np.flatnonzero(R.group_starts(names, row))
    size = np.diff(np.append(head, n))
    single = np.repeat(size > RUN, size)            # longer runs stay single words
    first = np.ones(n, bool)
    first[1:] = single[1:] | (names[1:] != names[:-1]) | (row[1:] != row[:-1])
    start = np.flatnonzero(first)
    end = np.append(start[1:], n)
    name = S.mix(names[start] + (end - start - 1).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    for k, most in enumerate(PAIR):
        side = S.mix(name ^ np.uint64(0x9FB21C651E98DF25 + k)) & np.uint64(1)
        join = (side[:-1] == 0) & (side[1:] == 1) & (row[start[:-1]] == row[start[1:]]) & (end[1:] - start[:-1] <= most)
        left = np.flatnonzero(join)                 # disjoint: no symbol is of both classes
        pair = S.mix(name[left] * np.uint64(0xC2B2AE3D27D4EB4F) + S.mix(name[left + 1]) + np.uint64(k + 1))
        name = name.copy()
        name[left] = pair
        end = end.copy()
        end[left] = end[left + 1]
        stay = np.ones(len(start), bool)
        stay[left + 1] = False
        start, end, name = start[stay], end[stay], name[stay]
    return start, end, name


def anchors(names: np.ndarray, row: np.ndarray, last: np.ndarray):
    """Per window start: whether a window of its row starts there, and its anchor's number and
    rank value; ``last`` is the end of each word's row."""
    n = len(names)
    start, end, name = recompress(names, row)
    at = np.arange(n)
    ok = last - at >= WINDOW
    at = at[ok]
    lo = np.searchsorted(start, at + REACH)
    hi = np.searchsorted(end, at + WINDOW - REACH, "right")
    # the place in the low half: of equal upper halves the rightmost wins, wherever the text lies
    value = (S.mix(name) & ~LOW) | (LOW - np.arange(len(name), dtype=np.uint64))
    # smallest value in [lo, hi): two blocks of a power of two
    count = hi - lo
    level = np.frexp(count.astype(np.float64))[1] - 1
    best = np.empty(len(at), np.uint64)
    block = value
    for k in range(int(level.max()) + 1 if len(level) else 0):
        some = np.flatnonzero(level == k)
        best[some] = np.minimum(block[lo[some]], block[hi[some] - (1 << k)])
        block = np.minimum(block[:-(1 << k)], block[1 << k:]) if len(block) > 1 << k else block[:0]
    symbol = (LOW - (best & LOW)).astype(np.int64)
    return at, best, start[symbol], end[symbol], name[symbol]


def parse(off: np.ndarray, data: np.ndarray) -> R.Phrases:
    start, end, first = words(off, data)
    names = S.span_hash(S.prefix(S.BYTE_VALUE[data]), start, end)
    count = np.diff(first)
    row = np.repeat(np.arange(len(count)), count)
    last = np.repeat(first[1:], count)
    at, best, s, e, _ = anchors(names, row, last)
    new = R.group_starts(row[at], best)
    a = np.flatnonzero(new)
    n = np.diff(np.append(a, len(at)))
    w = at[a]
    # phrases meet by the symbol and the REACH words that all their windows hold on both sides
    # of it: a short symbol alone would bring phrases together by chance
    sums = S.prefix(names)
    return R.Phrases(row[w], w - first[row[w]], n, S.span_hash(sums, s[a] - REACH, e[a] + REACH), S.span_hash(sums, w, w + n + WINDOW - 1))


def cutter(off: np.ndarray, data: np.ndarray, row: np.ndarray, at: np.ndarray, windows: np.ndarray):
    """The phrases' names of words, by the REACH words that all their windows hold on both sides
    of the anchor."""
    start, end, first = words(off, data)
    names = S.span_hash(S.prefix(S.BYTE_VALUE[data]), start, end)
    sums = S.prefix(names)
    count = np.diff(first)
    place, _, s, e, _ = anchors(names, np.repeat(np.arange(len(count)), count), np.repeat(first[1:], count))
    begin = first[row] + at
    spot = np.searchsorted(place, begin)
    context = S.signed(S.span_hash(sums, s[spot] - REACH, e[spot] + REACH))
    return np.arange(len(at)), context, np.zeros(len(at), np.int64), windows, S.gather(names, begin, begin + windows + WINDOW - 1)


def resolve(payloads: list[bytes], docs: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Smallest document of each window: equal windows have equal names of all words."""
    names = np.frombuffer(b"".join(payloads), np.uint64)
    base = np.cumsum(windows + WINDOW - 1) - (windows + WINDOW - 1)
    out = np.cumsum(windows) - windows
    owner = np.repeat(np.arange(len(windows)), windows)
    at = np.arange(int(windows.sum())) - out[owner] + base[owner]
    h = S.span_hash(S.prefix(names), at, at + WINDOW)
    o = np.argsort(h, kind="stable")
    new = R.group_starts(h[o])
    low = np.minimum.reduceat(docs[owner][o], np.flatnonzero(new))
    best = np.empty(len(h), np.int64)
    best[o] = low[np.cumsum(new) - 1]
    return best


def remover(text, spans):
    data = np.frombuffer(text, np.uint8)
    start, end, _ = words(np.array([0, len(data)]), data)
    runs = R.disjoint(spans)
    stay = np.ones(len(start), bool)
    for s, e in runs:
        stay[s:e] = False
    raw = data.tobytes()
    kept = [raw[s:e] for s, e in zip(start[stay].tolist(), end[stay].tolist(), strict=True)]
    return len(start), len(start) - len(kept), len(runs), b" ".join(kept)


def remove_repeated_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (all but the text) with n_units, n_removed, n_spans and the ``kept``
    words (UTF-8, joined by one space) of every document."""
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    return R.remove_repeats(docs, doc_id, text, keep, length=WINDOW, parse=parse, cutter=cutter, resolve=resolve, remover=remover, name="words")


def op10_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract rows of op10 over the whole ``documents`` table."""
    found = remove_repeated_words(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep=["doc_id"])
    return found.select("doc_id", F.col("n_units").alias("n_words"), "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


#: The same from every window's text: a word is covered if a repeated window starts at most 49 words
#: before it.
ORACLE_SQL = """
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
u AS (SELECT doc_id, x.j AS j, x.word AS word, x.h AS h FROM (SELECT doc_id, unnest(list_transform(range(1, len(w) + 1), lambda j:
    {'j': j, 'word': w[j], 'h': CASE WHEN j + 49 <= len(w) THEN hash(array_to_string(w[j:j + 49], ' ')) END})) AS x FROM w)),
f AS (SELECT h, min(doc_id) AS low FROM u WHERE h IS NOT NULL GROUP BY h),
m AS (SELECT u.doc_id, j, word, coalesce(max(CASE WHEN low < u.doc_id THEN j END) OVER (PARTITION BY u.doc_id ORDER BY j) >= j - 49, false) AS gone FROM u LEFT JOIN f ON f.h = u.h),
k AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY j) FILTER (NOT gone) AS kept FROM m GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN k ON k.doc_id = d.doc_id
"""
