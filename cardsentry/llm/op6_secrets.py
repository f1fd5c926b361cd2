"""Secret scan with multipart credential linking (built-in functions only).

Base findings are regular-expression matches of three kinds.  Beside them the
scan collects weak parts: short assigned values, short access identifiers,
short hexadecimal runs and endpoints (URLs).  Each part has a role
(identifier, secret, endpoint).  An interval join finds, within ``scope`` code
points in the same text, parts of a complementary role; a weak part is reported
only if there is one.  A part may be of any length and is met through its two
ends; parts of a kind do not overlap, so a scope holds a bounded number of ends
and the join grows with the parts.

Spans are code points, end exclusive.  Defined cases: null or empty text has no
span; rows that repeat an id and text get the same spans; rows that repeat an id
with another text are scanned on their own; a null id is an id of its own; an
empty table gives an empty result; the columns a row came with pass through
``redact`` and are not touched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, free_names

# The patterns of the findings, in the order in which kinds are listed.
ASSIGN = (r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{12,}"
ENDPOINT = r"https?://[A-Za-z0-9.-]+(?::[0-9]+)?(?:/[A-Za-z0-9._~/-]*)?"
KINDS = ("assign", "access", "hex", "weak_assign", "weak_access", "weak_hex", "endpoint")
ROLES = ("secret", "identifier", "secret", "secret", "identifier", "secret", "endpoint")
COMPLEMENTS = {"secret": ("identifier", "endpoint"), "identifier": ("secret",), "endpoint": ("secret",)}
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 12, 18, 16
WEAK_ASSIGN, WEAK_ACCESS = 6, 12
SCOPE = 120
#: Entries of a block of running sums; code points of a piece of text that is redacted at a time.
SUM_BLOCK, PIECE = 64, 8192


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _before(lengths: Column) -> Column:
    """For every entry of an integer array the sum of those before it.

    Sums run inside blocks and over the blocks, so the time follows the array's length.
    """
    add = lambda x: F.aggregate(x, F.lit(0), lambda a, b: a + b)
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))

    def over_blocks(blocks):
        starts = F.aggregate(blocks, zero, lambda a, b: F.struct(
            (a["at"] + add(b)).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")), lambda a: a["out"])
        return F.flatten(F.zip_with(blocks, starts, lambda b, at: F.transform(
            b, lambda _, i: at + add(F.slice(b, F.lit(1), i)))))

    return _let(lengths, lambda x: _let(
        F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / SUM_BLOCK).cast("int")),
                    lambda c: F.slice(x, c * SUM_BLOCK + 1, F.lit(SUM_BLOCK))), over_blocks))


def _matches(text: Column, pattern: str, kind: Column) -> Column:
    """Array of ``(s, e, kind)`` of a pattern's matches, leftmost and non-overlapping.

    The pieces between matches give the positions.  ``kind`` maps a match (a
    column) to its place in KINDS, null to drop it.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    # the piece after the last match comes with a null match, and is dropped
    pairs = F.zip_with(gaps, found, lambda g, m: F.struct(
        F.length(g).alias("g"), F.length(m).alias("m"),
        F.when(m.isNotNull(), kind(m)).cast("int").alias("kind")))

    def placed(ps):
        return F.zip_with(ps, _before(F.transform(ps, lambda p: p["g"] + p["m"])), lambda p, at: F.struct(
            (at + p["g"]).alias("s"), (at + p["g"] + p["m"]).alias("e"), p["kind"].alias("kind")))

    empty = F.array().cast("array<struct<s:int,e:int,kind:int>>")
    return F.when(F.regexp_like(text, F.lit(pattern)),
                  F.filter(_let(pairs, placed), lambda p: p["kind"].isNotNull())).otherwise(empty)


def _by_length(length, strong: int, strong_kind: int, weak: int, weak_kind: int) -> Column:
    return F.when(length >= strong, F.lit(strong_kind)).when(length >= weak, F.lit(weak_kind))


def parts(text: Column) -> Column:
    """All parts of a text, strong and weak, by start and kind."""
    value = lambda m: F.length(F.regexp_extract(m, ASSIGN, 2))
    none = F.array().cast("array<struct<s:int,e:int,kind:int>>")
    each = [
        F.when(F.regexp_like(text, F.lit(r"[:=]")),
               _matches(text, ASSIGN, lambda m: _by_length(value(m), MIN_ASSIGN, 0, WEAK_ASSIGN, 3))).otherwise(none),
        F.when(F.contains(text, F.lit("AKIA")),
               _matches(text, ACCESS, lambda m: _by_length(F.length(m), MIN_ACCESS, 1, WEAK_ACCESS, 4))).otherwise(none),
        _matches(text, HEX, lambda m: _by_length(F.length(m), MIN_HEX, 2, 0, 5)),
        F.when(F.contains(text, F.lit("://")), _matches(text, ENDPOINT, lambda m: F.lit(6))).otherwise(none),
    ]
    return F.array_sort(F.concat(*each), lambda a, b: F.when(a["s"] != b["s"], a["s"] - b["s"]).otherwise(a["kind"] - b["kind"]))


def row_key(doc_id: Column, text: Column) -> Column:
    return F.sha2(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))), 256)


def _of_role(role: str) -> list[int]:
    return [k for k, r in enumerate(ROLES) if r == role]


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``(key, linked)``: the weak parts with a complementary part within ``scope``.

    Ends of parts are laid in cells of ``scope`` code points; a weak part meets the
    parts with an end in the cells from its start back and from its end on.
    """
    cell = lambda at: F.floor(at / scope)
    weak_kinds = [k for k, n in enumerate(KINDS) if k > 2]
    own = (found.select("key", F.explode("parts").alias("w")).filter(F.col("w.kind").isin(weak_kinds))
           .withColumn("cell", F.explode(F.array(cell(F.col("w.s") - scope), cell(F.col("w.s")),
                                                 cell(F.col("w.e")), cell(F.col("w.e") + scope)))).distinct())
    other = (found.filter(F.exists("parts", lambda p: p["kind"] > 2))
             .select("key", F.explode("parts").alias("p"))
             .withColumn("cell", F.explode(F.array(cell(F.col("p.s")), cell(F.col("p.e"))))).distinct())
    complementary = F.lit(False)
    for role, partners in COMPLEMENTS.items():
        complementary = complementary | (F.col("w.kind").isin(_of_role(role))
                                         & F.col("p.kind").isin([k for r in partners for k in _of_role(r)]))
    # a partner behind is met through its start, one in front through its end
    near = (F.col("p.s") - F.col("w.e") <= scope) & (F.col("w.s") - F.col("p.e") <= scope)
    apart = (F.col("p.s") >= F.col("w.e")) | (F.col("w.s") >= F.col("p.e"))
    return (own.join(other, ["key", "cell"]).filter(complementary & near & apart)
            .groupBy("key").agg(F.collect_set("w").alias("linked")))


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``(doc_id, key, spans)`` per row: base findings and linked weak parts.

    The findings are written once to the checkpoint folder (no text), so the
    expressions run once over the texts.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = checkpointed(docs.select("doc_id", row_key(F.col("doc_id"), text).alias("key"), parts(text).alias("parts")))
    base = F.filter("parts", lambda p: p["kind"] <= 2)
    spans = F.array_sort(F.concat(base, F.coalesce(F.col("linked"), F.array().cast("array<struct<s:int,e:int,kind:int>>"))),
                         lambda a, b: F.when(a["s"] != b["s"], a["s"] - b["s"]).otherwise(a["kind"] - b["kind"]))
    return found.join(linked(found, scope), "key", "left").select("doc_id", "key", spans.alias("spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda p: F.concat_ws(
        ":", F.get(names, p["kind"]), p["s"].cast("string"), p["e"].cast("string"))))


def report(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Counts by kind, digest of the base spans and all spans as text, per row."""
    out = scan(docs, scope)
    count = lambda k: F.size(F.filter("spans", lambda p: p["kind"] == k)).cast("long")
    base = span_text(F.filter("spans", lambda p: p["kind"] <= 2))
    return out.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                      F.sha2(base, 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, mark: str = "[secret]", scope: int = SCOPE) -> DataFrame:
    """The rows with every span (overlapping ones as one) replaced by ``mark``.

    A text is worked on piece by piece, so the time follows its length and its spans.
    """
    key, own, spans = free_names(docs.columns, "key", "own", "spans")
    hits = (scan(docs.select("doc_id", "text"), scope).filter(F.size("spans") > 0).groupBy(F.col("key").alias(own))
            .agg(F.first("spans").alias(spans)))
    text = F.col("text").cast("string")

    def clean(piece, number):
        begin = number * PIECE
        covered = F.aggregate(F.filter(spans, lambda p: p["s"] < begin), begin, lambda a, p: F.greatest(a, p["e"]))
        inside = F.filter(spans, lambda p: (p["s"] >= begin) & (p["s"] < begin + PIECE))
        zero = F.struct(covered.alias("at"), F.lit("").alias("out"))

        def step(acc, p):
            more = F.when(p["s"] >= acc["at"], F.concat(
                F.substring(piece, acc["at"] - begin + 1, p["s"] - acc["at"]), F.lit(mark))).otherwise(F.lit(""))
            return F.struct(F.greatest(acc["at"], p["e"]).alias("at"), F.concat(acc["out"], more).alias("out"))

        return F.aggregate(inside, zero, step, lambda a: F.concat(
            a["out"], F.substring(piece, a["at"] - begin + 1, F.lit(PIECE))))

    pieces = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % PIECE), F.lit(0))
    return (docs.withColumn(key, row_key(F.col("doc_id"), text)).join(hits, F.col(key) == F.col(own), "left")
            .withColumn("text", F.when(F.col(spans).isNotNull(), F.array_join(F.transform(pieces, clean), ""))
                        .otherwise(F.col("text")))
            .select(*docs.columns))
