"""Finding secrets in texts with DataFrame functions only.

Three kinds are patterns: assignments of a value to a telling name, access key ids,
and long runs of hexadecimal digits. The rest is found by entropy: strings of one
character class are slid over with a window whose Shannon entropy is kept up to
date from character counts, one character in and one out. Strings that look like
words, numbers or identifiers made for reading are on an allow-list.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- Fixed values: the pattern kinds, in their order. The value's length is tested on group `value`. ---
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
# A run of 32 or more is the same as a run whose length is tested afterwards.
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
PATTERNS = (("assign", ASSIGN, 2, 8), ("access", ACCESS, 0, 16), ("hex", HEX, 0, 32))
BASE_KINDS = tuple(p[0] for p in PATTERNS)


@dataclass(frozen=True)
class EntropyKind:
    """Strings over ``alphabet`` whose windows reach ``share`` of the most entropy a window can have."""

    name: str
    alphabet: str
    least: int
    window: int
    share: float

    @property
    def pattern(self) -> str:
        inside = "[" + self.alphabet.replace("-", r"\-") + "]"
        return f"(?<!{inside}){inside}{{{self.least},}}"


_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
# Window length is in characters; the most entropy is log2 of it, or of the alphabet's size if that is less.
ENTROPY_KINDS = (
    EntropyKind("entropy16", _DIGITS + "abcdef", 20, 24, 0.78),
    EntropyKind("entropy64", _DIGITS + _LOWER + _LOWER.upper() + "+/_-=", 20, 32, 0.84),
    # Too few different characters for the share of entropy64.
    EntropyKind("entropy16upper", _DIGITS + "ABCDEF", 20, 24, 0.78),
)
# Words (joined or not), numbers and dates, and UUIDs are no secrets. No group repeats: such
# a pattern would take a stack frame for each part of a long string.
ALLOWED = (
    r"^[A-Za-z][A-Za-z\-_/+=]*$",
    r"^[0-9][0-9\-_/+=]*$",
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
)
KINDS = BASE_KINDS + tuple(k.name for k in ENTROPY_KINDS)
REDACTED = "[REDACTED]"

_CHUNK = 64
_SPANS = "array<struct<start:int,rank:int,kind:string,end:int>>"


def _running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Per element the joined values of all elements before it (0 for the first).

    Two levels of chunks keep the work near linear in long arrays.
    """

    def fold(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), join)

    count = F.size(values)
    numbers = F.sequence(F.lit(0), F.floor((count - 1) / _CHUNK).cast("int"))
    folded = F.transform(numbers, lambda c: fold(F.slice(values, c * _CHUNK + 1, _CHUNK)))
    chunks = F.when(count > 0, folded).otherwise(F.array().cast("array<int>"))
    before = F.transform(chunks, lambda _, c: fold(F.slice(chunks, 1, c)))
    return F.transform(
        values,
        lambda _, i: join(
            F.get(before, F.floor(i / _CHUNK).cast("int")),
            fold(F.slice(values, F.floor(i / _CHUNK).cast("int") * _CHUNK + 1, i % _CHUNK)),
        ),
    )


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _starts(text: Column, pattern: str, found: Column) -> Column:
    """Where the matches start, in code points: gaps and matches before each, summed."""
    gaps = F.split(text, pattern, -1)
    steps = F.zip_with(gaps, found, lambda g, m: F.char_length(g) + F.coalesce(F.char_length(m), F.lit(0)))
    before = _running(F.slice(steps, 1, F.size(found)), lambda a, b: a + b)
    return F.zip_with(before, F.slice(gaps, 1, F.size(found)), lambda b, g: b + F.char_length(g))


def _span(kind: str, start: Column, end: Column) -> Column:
    rank = F.lit(KINDS.index(kind))
    return F.struct(start.alias("start"), rank.alias("rank"), F.lit(kind).alias("kind"), end.alias("end"))


def _f(count: Column, window: int) -> Column:
    """``count * log2(count)`` from a table."""
    table = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 1)])
    return F.get(table, count)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often and deeply it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _counted(counts: Column, place: Column, by: int) -> Column:
    """The counts with one of them changed."""
    changed = F.array(F.get(counts, place) + by)
    return F.concat(F.slice(counts, 1, place), changed, F.slice(counts, place + 2, F.size(counts)))


def _high_part(string: Column, kind: EntropyKind) -> Column:
    """Start and end of the part of a string covered by windows of high entropy; nulls if there is none.

    The entropy of a window of w characters with counts c is
    ``log2(w) - sum(c * log2(c)) / w``. The state keeps the counts and the sum, and
    each step changes at most two counts, so the time is linear in the string. A string
    shorter than the window is one window.
    """
    width = F.least(F.lit(kind.window), F.char_length(string))
    scan = F.struct(
        F.transform(F.split(string, ""), lambda c: F.instr(F.lit(kind.alphabet), c) - 1).alias("places"),
        width.alias("width"),
        (F.lit(kind.share) * F.least(F.log2(width), F.lit(math.log2(len(kind.alphabet))))).alias("needed"),
    )
    zero = F.struct(
        F.array_repeat(F.lit(0), len(kind.alphabet)).alias("counts"),
        F.lit(0.0).alias("sum"),
        F.lit(None).cast("int").alias("first"),
        F.lit(None).cast("int").alias("last"),
    )

    def slid(scan: Column) -> Column:
        places, width = scan["places"], scan["width"]

        def step(state: Column, at: Column) -> Column:
            full = at > width
            gone, come = F.get(places, at - width - 1), F.get(places, at - 1)
            left = F.when(full, _counted(state["counts"], gone, -1)).otherwise(state["counts"])
            down = F.get(state["counts"], gone)
            total = state["sum"] + F.when(full, _f(down - 1, kind.window) - _f(down, kind.window)).otherwise(0.0)

            def taken_in(held: Column) -> Column:
                up = F.get(held["counts"], come)
                total = held["sum"] + _f(up + 1, kind.window) - _f(up, kind.window)
                high = (at >= width) & (F.log2(width) - total / width >= scan["needed"])
                return F.struct(
                    _counted(held["counts"], come, 1).alias("counts"),
                    total.alias("sum"),
                    F.coalesce(state["first"], F.when(high, at - width)).alias("first"),
                    F.when(high, at).otherwise(state["last"]).alias("last"),
                )

            return _let(F.struct(left.alias("counts"), total.alias("sum")), taken_in)

        end = F.aggregate(F.sequence(F.lit(1), F.size(places)), zero, step)
        return _let(end, lambda e: F.struct(e["first"].alias("first"), e["last"].alias("last")))

    return _let(scan, slid)


def _suspicious(string: Column) -> Column:
    allowed = string.rlike(ALLOWED[0])
    for pattern in ALLOWED[1:]:
        allowed = allowed | string.rlike(pattern)
    return ~allowed


def _none() -> Column:
    return F.array().cast(_SPANS)


def _pattern_spans(value: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Spans of a pattern's matches, which lie in the column named after the kind."""
    whole = F.col(f"_{kind}")
    tested = _matches(value, pattern, group) if group else whole
    placed = F.zip_with(_starts(value, pattern, whole), whole, lambda s, m: _span(kind, s, s + F.char_length(m)))
    kept = F.filter(placed, lambda _, i: F.char_length(F.get(tested, i)) >= least)
    return F.when(F.size(whole) > 0, kept).otherwise(_none())


def _entropy_spans(value: Column, kind: EntropyKind) -> Column:
    """Spans of high entropy in the strings that lie in the column named after the kind."""
    strings = F.col(f"_{kind.name}")
    parts = F.transform(strings, lambda s: F.when(_suspicious(s), _high_part(s, kind)))
    starts = _starts(value, kind.pattern, strings)
    placed = F.zip_with(starts, parts, lambda s, p: _span(kind.name, s + p["first"], s + p["last"]))
    high = F.filter(placed, lambda p: p["start"].isNotNull())
    return F.when(F.exists(strings, _suspicious), high).otherwise(_none())


def with_spans(rows: DataFrame, text: str) -> DataFrame:
    """Adds ``_spans``: all secrets in the column, sorted by start, then by the order of ``KINDS``.

    Each element has start and end (code points, end exclusive) and kind. Pattern
    matches are leftmost and do not overlap within a kind; those with too short a
    value are dropped. Entropy spans that lie inside a pattern span are left out.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    found = {f"_{kind}": _matches(value, pattern) for kind, pattern, _, _ in PATTERNS}
    found |= {f"_{k.name}": _matches(value, k.pattern) for k in ENTROPY_KINDS}
    rows = rows.withColumns(found)
    spans = {}
    for pattern in PATTERNS:
        spans[f"_{pattern[0]}"] = _pattern_spans(value, *pattern)
    for kind in ENTROPY_KINDS:
        spans[f"_{kind.name}"] = _entropy_spans(value, kind)
    rows = rows.withColumns(spans)
    base = F.concat(*[F.col(f"_{k}") for k in BASE_KINDS])
    more = F.concat(*[F.col(f"_{k.name}") for k in ENTROPY_KINDS])
    news = F.filter(more, lambda m: ~F.exists(base, lambda b: (b["start"] <= m["start"]) & (m["end"] <= b["end"])))
    return rows.withColumn("_spans", F.array_sort(F.concat(base, news))).drop(*found)


def find_secrets(documents: DataFrame) -> DataFrame:
    """``doc_id, spans`` for every row of ``documents`` (doc_id, text).

    ``spans`` is an array of structs (start, rank, kind, end). The whole text is
    searched; null and empty texts have no spans. A null doc_id is carried through,
    repeated rows are searched each, other columns are ignored. No shuffle.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("_text"))
    return with_spans(rows, "_text").select("doc_id", F.col("_spans").alias("spans"))


def spans_as_text(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def redact(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` with every secret replaced; all columns are kept.

    Overlapping spans become one replacement. ``n_chars``, where present, follows the
    new text. Rows without secrets are unchanged, also null and empty texts.
    """
    rows = with_spans(documents.select(F.struct("*").alias("_row"), F.col("text").alias("_text")), "_text")
    spans = F.col("_spans")
    # End of all spans before each one; a span that starts before it continues the last replacement.
    covered = _running(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b))
    pieces = F.zip_with(
        spans,
        covered,
        lambda s, c: F.when(
            s["start"] >= c,
            F.concat(F.substring(F.col("_text"), c + 1, s["start"] - c), F.lit(REDACTED)),
        ).otherwise(""),
    )
    rest = F.substring(F.col("_text"), F.array_max(F.transform(spans, lambda s: s["end"])) + 1, F.char_length("_text"))
    rows = rows.withColumn("_new", F.concat(F.array_join(pieces, ""), rest))
    values = {"text": F.col("_new"), "n_chars": F.char_length("_new")}
    kinds = {f.name: f.dataType for f in documents.schema}

    def column(name: str) -> Column:
        given = F.col(f"_row.`{name}`")
        if name not in values:
            return given.alias(name)
        return F.when(F.size(spans) > 0, values[name].cast(kinds[name])).otherwise(given).alias(name)

    return rows.select(*map(column, documents.columns))
