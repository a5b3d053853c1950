"""Secret scan (operator 9), in DataFrame functions only.

Base spans are the leftmost non-overlapping matches of three patterns. The
method adds high-entropy strings: over each candidate run a window of
``WINDOW`` characters slides, its character counts are kept incrementally (the
character that leaves is taken off, the one that enters added), and so is
sum(c * log2 c), from which the Shannon entropy follows. A candidate belongs to
the class hex or base64, each with its own threshold; its span runs from the
first window at the threshold or over to the end of the last. An allow-list suppresses
what only looks random: words and numbers joined by separators, UUIDs, data
with a checksum prefix of its own, and placeholders.

Positions are code points: a text is split by a pattern, and the running
lengths of pieces and matches are the starts. All in one row expression: no
shuffle. Null and empty texts have no spans; repeated rows are scanned each.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import running_starts

# The contract's patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"   # a shorter run can't hold a match either
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
THRESHOLDS = {"hex": 3.0, "base64": 3.7}
#: Strings that may look random but are none: joined words and numbers, UUIDs, digests named as such, placeholders.
ALLOWED = (r"^(?:[A-Za-z]+|[0-9]+)(?:[-_/=+]+(?:[A-Za-z]+|[0-9]+))*[-_/=+]*$",
           r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
           r"^(?:sha(?:1|256|384|512)|md5)[-=]", r"(?i)example|placeholder|x{6,}|0123456789|abcdefgh")


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _located(pieces: Column, found: Column, starts: Column) -> Column:
    """(start, end) of each match, from the running starts of (piece + match)."""
    return F.transform(starts, lambda s, i: F.struct(
        (s + F.length(pieces[i])).alias("start"), (s + F.length(pieces[i]) + F.length(found[i])).alias("end")))


def _positions(df: DataFrame, name: str, pattern: str, text: str, values: int = 0) -> DataFrame:
    """Adds array<struct<start, end, value>> of all matches of ``pattern``; value is group ``values``."""
    hit = F.col(text).rlike(pattern)
    none = F.array().cast("array<string>")
    out = df.withColumn("_p", F.when(hit, F.split(text, pattern, -1)).otherwise(none)).withColumn(
        "_m", F.when(F.size("_p") > 0, _matches(F.col(text), pattern)).otherwise(none)).withColumn(
        "_v", F.when(F.size("_p") > 0, _matches(F.col(text), pattern, values)).otherwise(none) if values else F.col("_m"))
    steps = F.transform("_m", lambda m, i: (F.length(F.col("_p")[i]) + F.length(m)).cast("long"))
    out = out.withColumn("_s", steps).withColumn("_s", running_starts(F.col("_s")))
    spans = F.zip_with(_located(F.col("_p"), F.col("_m"), F.col("_s")), "_v", lambda s, v: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), v.alias("value")))
    return out.withColumn(name, spans).drop("_p", "_m", "_v", "_s")


def _entropy_spans(df: DataFrame, name: str, text: str) -> DataFrame:
    """Adds array<struct<start, end>> of the high-entropy spans of ``text``."""
    df = _positions(df, "_c", CANDIDATE, text)
    allowed = lambda v: F.lit(False)
    for pattern in ALLOWED:
        allowed = (lambda v, a=allowed, p=pattern: a(v) | v.rlike(p))
    df = df.withColumn("_c", F.filter("_c", lambda c: ~allowed(c["value"])))
    zero = "0" * len(ALPHABET)
    logs = ", ".join(f"{c * math.log2(c) if c else 0.0!r}D" for c in range(WINDOW + 1))
    bounds = {k: WINDOW * (math.log2(WINDOW) - t) + 1e-9 for k, t in THRESHOLDS.items()}
    # Counts are a string with one character a letter of the alphabet ('0' + count), changed in place by overlay.
    count = "(ascii(substr(a.n, e.p, 1)) - 48)"
    total = f"(a.s + g[{count} + e.d] - g[{count}])"
    hot = f"(e.i >= {WINDOW - 1} AND {total} <= bound)"
    fold = f"""aggregate(
        flatten(transform(chars, (c, i) -> CASE WHEN i >= {WINDOW}
            THEN array(named_struct('d', -1, 'p', instr('{ALPHABET}', chars[i - {WINDOW}]), 'i', -1),
                       named_struct('d', 1, 'p', instr('{ALPHABET}', c), 'i', i))
            ELSE array(named_struct('d', 1, 'p', instr('{ALPHABET}', c), 'i', i)) END)),
        named_struct('n', '{zero}', 's', 0.0D, 'first', -1, 'last', -1),
        (a, e) -> named_struct('n', overlay(a.n, chr({count} + 48 + e.d), e.p, 1), 's', {total},
            'first', CASE WHEN {hot} AND a.first < 0 THEN e.i - {WINDOW - 1} ELSE a.first END,
            'last', CASE WHEN {hot} THEN e.i - {WINDOW - 1} ELSE a.last END))"""
    # transform over one-element arrays binds names to values (a let), inside the row.
    scored = F.expr(f"""transform(_c, s -> transform(array(named_struct(
            'chars', split(s.value, ''), 'g', array({logs}),
            'bound', CASE WHEN s.value RLIKE '^[0-9a-fA-F]+$' THEN {bounds['hex']!r}D ELSE {bounds['base64']!r}D END)), x ->
        named_struct('at', s.start, 'w', {fold.replace('chars', 'x.chars').replace('g[', 'x.g[').replace('bound', 'x.bound')}))[0])""")
    df = df.withColumn("_w", F.when(F.size("_c") > 0, scored))
    spans = F.transform(F.filter("_w", lambda w: w["w"]["first"] >= 0), lambda w: F.struct(
        (w["at"] + w["w"]["first"]).alias("start"), (w["at"] + w["w"]["last"] + WINDOW).alias("end")))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return df.withColumn(name, F.coalesce(spans, none)).drop("_c", "_w")


def with_spans(df: DataFrame, text_col: str = "text", name: str = "secret_spans") -> DataFrame:
    """Adds ``name``: array<struct<start, kind, end>> of all spans by start, then kind (a place in KINDS)."""
    df = df.withColumn("_t", F.coalesce(F.col(text_col), F.lit("")))
    df = _positions(df, "_assign", ASSIGN, "_t", 2)
    df = _positions(df, "_access", ACCESS, "_t")
    df = _positions(df, "_hex", HEX, "_t")
    df = _entropy_spans(df, "_entropy", "_t")
    spans = lambda c, k: F.transform(c, lambda s: F.struct(
        s["start"].cast("long").alias("start"), F.lit(k).alias("kind"), s["end"].cast("long").alias("end")))
    assign = F.filter("_assign", lambda s: F.length(s["value"]) >= 6)
    every = F.concat(spans(assign, 0), spans("_access", 1), spans("_hex", 2), spans("_entropy", 3))
    return df.withColumn(name, F.array_sort(every)).drop("_t", "_assign", "_access", "_hex", "_entropy")


def _joined(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"], s["end"])), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    rows = with_spans(docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")))
    count = lambda k: F.size(F.filter("secret_spans", lambda s: s["kind"] == k)).cast("long")
    return rows.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                       F.sha2(_joined(F.filter("secret_spans", lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
                       _joined(F.col("secret_spans")).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced by ``mark``; overlapping spans are one."""
    df = with_spans(docs, text_col, "_spans")
    merged = F.expr("""aggregate(_spans, cast(array() AS array<struct<start:bigint,end:bigint>>), (a, s) ->
        CASE WHEN size(a) > 0 AND s.start < a[size(a) - 1].end
             THEN concat(slice(a, 1, size(a) - 1), array(named_struct('start', a[size(a) - 1].start, 'end', greatest(a[size(a) - 1].end, s.end))))
             ELSE concat(a, array(named_struct('start', s.start, 'end', s.end))) END)""")
    df = df.withColumn("_cuts", merged)
    kept = F.expr(f"""array_join(transform(sequence(0, size(_cuts)), i ->
        CASE WHEN i = size(_cuts) THEN substring(`{text_col}`, cast(_cuts[i - 1].end AS int) + 1)
             ELSE substring(`{text_col}`, CASE WHEN i = 0 THEN 1 ELSE cast(_cuts[i - 1].end AS int) + 1 END,
                            cast(_cuts[i].start - CASE WHEN i = 0 THEN 0 ELSE _cuts[i - 1].end END AS int)) END), '{mark}')""")
    return df.withColumn(text_col, F.when(F.size("_cuts") > 0, kept).otherwise(F.col(text_col))).drop("_spans", "_cuts")
