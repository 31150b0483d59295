"""Personal data by base rules and bootstrapped contextual extraction.

Base rules find e-mail addresses, IP addresses, card and phone numbers (``base_spans``).  They are
the seeds of the bootstrap: every identifier-shaped token of the corpus is an instance, and
the lexical patterns around it (the word or two before it, a key before ``=`` or ``:``, its
leading letters; a token is cut at signs, and its later values have the key or else the value
before them) are linked to it in a graph.  ``bootstrap`` scores both sides in rounds, with
Spark aggregations over the edges:

* a pattern's precision is the mean score of its distinct instances, seeds counting 1 and
  unknown instances what they have earned so far; it is trusted from ``MIN_PRECISION`` and
  ``MIN_SUPPORT`` known instances on;
* an unknown instance scores the mean precision of its trusted patterns, and is known from
  ``MIN_SCORE`` on, so that in the next round it vouches for further patterns; it keeps the
  greatest score it has had, and the rounds end when neither the known instances nor the sum of
  their scores (to 6 places each) change.

Tokens in the form of a base rule that fail its check (a card number that breaks Luhn's rule, an
address part over 255) are negative seeds: they score 0 throughout and count against their
patterns.  Unknown instances that are known in the end are the added spans, kind ``id``.

Defined results: a null or empty text has no spans; spans are in code points, end exclusive;
base spans of different kinds may overlap, added ones never overlap a base span; repeated rows
have equal spans and count once in the graph; an empty table gives no rows; other columns are
kept (``mask``).
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import _shared as S

KINDS = ("email", "ip", "card", "phone")
ADDED = "id"
MASK = "[{}]"

MIN_PRECISION, MIN_SUPPORT, MIN_SCORE = 0.7, 5, 0.6
#: Shape of an instance: its characters, and of them at least so many digits.
CHARS, DIGITS = (6, 64), 2

# Fixed patterns of the base rules.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")


def _emails(text: str):
    end, at = 0, text.find("@")
    while at >= 0:
        s = at
        while s > end and text[s - 1] in _LOCAL:
            s -= 1
        m = _DOMAIN.match(text, at + 1) if s < at else None
        if m:
            end = m.end()
            yield s, end
        at = text.find("@", max(at + 1, end))


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i & 1:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind as listed in KINDS."""
    out = [(s, e, "email") for s, e in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append((*m.span(), "ip"))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = _NOT_DIGIT.sub("", m[0])
                if 14 <= len(digits) <= 19 and _luhn(digits):
                    out.append((*m.span(), "card"))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                    out.append((*m.span(), "phone"))
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


#: Tokens of these characters only, or with an @, are for the base rules to judge.
_BASE_FORM = re.compile(r"[0-9 ().+-]+|.*@.*")
_EDGE = ".,;:!?()[]{}<>\"'`|"
#: Values of a token without spaces (JSON, CSV, URL queries, logs), and what ends a key.
_PIECE = re.compile(r"""[^=:,;&?|()\[\]{}<>"'`]+""")
_KEY_SIGN = re.compile(r"[=:]")
_WORD_BEFORE = re.compile(r"(\S{1,40})\s+(\S{1,40})\s*\Z|(\S{1,40})\s*\Z")


def instances(text: str, base: list[tuple[int, int, str]]):
    """(start, end, value, patterns, seed) of the identifier-shaped tokens and the base spans; seed
    is 1 for base spans, 0 for negative seeds, null for unknown instances."""
    out = []
    covered, at = [(s, e) for s, e, _ in base], 0
    for s, e, _ in base:
        out.append((s, e, text[s:e], _patterns(text[max(0, s - 90):s], text[s:e]), 1.0))
    upto = 0
    for m in _DIGIT.finditer(text):
        if m.start() < upto:
            continue
        s = m.start()
        while s > upto and not text[s - 1].isspace():
            s -= 1
        e = m.end()
        while e < len(text) and not text[e].isspace():
            e += 1
        upto = e
        # a token is cut into values; a key before a value belongs to the context
        left, last = None, ""
        for i, piece in enumerate(_PIECE.finditer(text, s, e)):
            key = last if left is not None and _KEY_SIGN.search(text, left, piece.start()) else ""
            before = text[max(0, s - 90):s] if i == 0 or i == 1 and key else "" if key else last
            left, last = piece.end(), piece[0][-40:]
            a, b = piece.span()
            while a < b and text[a] in _EDGE:
                a += 1
            while b > a and text[b - 1] in _EDGE:
                b -= 1
            if not CHARS[0] <= b - a <= CHARS[1]:
                continue
            value = text[a:b]
            if len(_DIGIT.findall(value)) < DIGITS:
                continue
            while at < len(covered) and covered[at][1] <= a:
                at += 1
            k = at
            while k < len(covered) and covered[k][0] < b and covered[k][1] <= a:
                k += 1
            if k < len(covered) and covered[k][0] < b:
                continue
            out.append((a, b, value, _patterns(before, value, key), 0.0 if _BASE_FORM.fullmatch(value) else None))
    return out


def _patterns(before: str, value: str, key: str = "") -> list[str]:
    found = []
    key = key.lower()
    m = _WORD_BEFORE.search(before)
    if m:
        near = (m[2] or m[3]).lower().strip(_EDGE)
        found.append(f"word {near}")
        if m[1]:
            found.append(f"words {m[1].lower().strip(_EDGE)} {near}")
    if key:
        found.append(f"key {key}")
    lead = re.match(r"[A-Za-z]{3,8}", value)
    if lead:
        found.append(f"lead {lead[0][:4]}")
    return [_DIGIT.sub("0", p) for p in found]


_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])
_INSTANCE = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("value", pa.string()), ("patterns", pa.list_(pa.string())), ("seed", pa.float64())])
SCAN_SCHEMA = ("base array<struct<start:int,end:int,kind:string>>, "
               "instances array<struct<start:int,end:int,value:string,patterns:array<string>,seed:double>>")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, row, base, instances) of every row: id, hash of the text, spans.  One pass over the
    texts; everything after it works on these small rows."""
    S.prepare(docs.sparkSession)

    def run(batches):
        for b in batches:
            base, found = [], []
            for t in b.column(2):
                t = t.as_py() or ""
                spans = base_spans(t)
                base.append([dict(zip(("start", "end", "kind"), x, strict=True)) for x in spans])
                found.append([dict(zip(("start", "end", "value", "patterns", "seed"), x, strict=True)) for x in instances(t, spans)])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(base, pa.list_(_SPAN)), pa.array(found, pa.list_(_INSTANCE))],
                                             names=["doc", "row", "base", "instances"])

    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    src = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc"), F.xxhash64(body).alias("row"), body.alias("text"))
    return src.mapInArrow(run, f"doc long, row long, {SCAN_SCHEMA}")


def bootstrap(scanned: DataFrame) -> DataFrame:
    """(value, score) of the discovered identifiers, from the pattern-instance graph of all rows.

    Edges are distinct (pattern, value) pairs, so copies of a text add nothing; both sides are
    reduced by partial aggregation before each shuffle."""
    edges = (scanned.select(F.explode("instances").alias("x")).select(F.explode("x.patterns").alias("pattern"), F.col("x.value").alias("value"), F.col("x.seed").alias("seed"))
             .groupBy("pattern", "value").agg(F.max("seed").alias("seed")))
    edges = S.table(edges, "pii-edges")
    # every edge knows its value's seed, so that no round has to look for the seeds again
    seeds = edges.filter("seed IS NOT NULL").groupBy("value").agg(F.max("seed").alias("base"))
    edges = S.table(edges.select("pattern", "value").join(seeds, "value", "left"), "pii-edges")
    known, seen = None, None
    while True:
        scored = edges if known is None else edges.join(known, "value", "left")
        score = F.coalesce("base", F.lit(0.0)) if known is None else F.coalesce("base", "score", F.lit(0.0))
        patterns = (scored.groupBy("pattern").agg(F.avg(score).alias("precision"), F.sum((score > 0).cast("int")).alias("support"))
                    .filter((F.col("precision") >= MIN_PRECISION) & (F.col("support") >= MIN_SUPPORT)).select("pattern", "precision"))
        found = (edges.filter("base IS NULL").join(patterns, "pattern").groupBy("value").agg(F.avg("precision").alias("score"))
                 .filter(F.col("score") >= MIN_SCORE))
        if known is not None:
            # scores only rise, so the rounds come to an end
            found = found.unionByName(known).groupBy("value").agg(F.max("score").alias("score"))
        known = S.table(found, "pii-found")
        now = known.agg(F.count(F.lit(1)), F.sum(F.col("score").cast("decimal(18,6)"))).first()
        if now == seen or not now[0]:
            return known
        seen = now


def spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, row, base, added): the spans of every row; added holds the discovered ones."""
    scanned = S.table(scan(docs, doc_id, text), "pii-scan")
    found = bootstrap(scanned)
    near = scanned.select("doc", "row", F.explode("instances").alias("x")).filter("x.seed IS NULL").select("doc", "row", F.col("x.start").alias("start"), F.col("x.end").alias("end"), F.col("x.value").alias("value"))
    added = (near.join(found.select("value"), "value").select("doc", "row", "start", "end").distinct()
             .groupBy("doc", "row").agg(F.array_sort(F.collect_list(F.struct("start", "end", F.lit(ADDED).alias("kind")))).alias("added")))
    same = (F.col("a.doc").eqNullSafe(F.col("b.doc"))) & (F.col("a.row") == F.col("b.row"))
    none = F.array().cast("array<struct<start:int,end:int,kind:string>>")
    return scanned.alias("a").join(added.alias("b"), same, "left").select("a.doc", "a.row", "a.base", F.coalesce("b.added", none).alias("added"))


def _listed(column):
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _ordered(column):
    """Spans by start, then kind as listed (added kinds last)."""
    place = F.create_map(*[x for i, k in enumerate((*KINDS, ADDED)) for x in (F.lit(k), F.lit(i))])
    by = F.array_sort(F.transform(column, lambda s: F.struct(s["start"].alias("start"), place[s["kind"]].alias("place"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.transform(by, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))


def mask(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", chars: str | None = "n_chars") -> DataFrame:
    """``docs`` with every span of its text replaced by its kind in brackets (overlapping spans
    by that of the first), and the length column, if there is one, updated."""
    found = spans(docs, doc_id, text)
    some = found.filter((F.size("base") > 0) | (F.size("added") > 0)).select(F.col("row").alias("_row_"), _ordered(F.concat("base", "added")).alias("_spans_")).dropDuplicates(["_row_"])
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    columns = docs.columns
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_doc_"), F.xxhash64(body).alias("_row_")).join(some.hint("merge"), "_row_", "left")
    t = F.col(f"_doc_.`{text}`")
    # (place, text so far), over the spans in order
    cut = F.aggregate("_spans_", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), lambda a, s: F.when(s["start"] < a["at"], F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out"))).otherwise(
        F.struct(s["end"].alias("at"), F.concat(a["out"], F.substring(t, a["at"] + 1, s["start"] - a["at"]), F.format_string(MASK.format("%s"), F.upper(s["kind"]))).alias("out"))))
    new = F.when(F.col("_spans_").isNull(), t).otherwise(F.concat(F.col("_cut_.out"), F.substring(t, F.col("_cut_.at") + 1, F.char_length(t))))
    out = keyed.withColumn("_cut_", F.when(F.col("_spans_").isNotNull(), cut)).withColumn("_text_", new)

    def column(c):
        if c == text:
            return F.col("_text_").alias(c)
        if c == chars:
            kind = docs.schema[c].dataType
            return F.when(F.col("_spans_").isNull(), F.col(f"_doc_.`{c}`")).otherwise(F.char_length("_text_").cast(kind)).alias(c)
        return F.col(f"_doc_.`{c}`").alias(c)

    return out.select(*[column(c) for c in columns])


def _count(kind: str):
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


def op1_pii(spark, sf_dir: str) -> DataFrame:
    """Contract rows of op1 over the whole ``documents`` table; n_* count the base spans."""
    found = spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    count = [_count(k).alias(f"n_{k}") for k in KINDS]
    return found.select(F.col("doc").alias("doc_id"), *count, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
                        _listed(_ordered(F.concat("base", "added"))).alias("spans"), F.size("added").cast("long").alias("n_added"))
