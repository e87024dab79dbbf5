"""Secrets in texts, with DataFrame functions only.

Base spans come from three patterns. The method adds spans of high entropy: each run of characters
of a class (hexadecimal, base64) is a candidate, a window slides over it, and the window's Shannon
entropy is kept by adding the character that enters and taking off the one that leaves. Windows
above the class's threshold merge into spans, unless the candidate is on the allow-list.

Defined results: a null or empty text has no spans; positions are code points, ends exclusive;
repeated rows are scanned each; other columns are carried as they are; an empty table stays empty. Texts of any
length are scanned whole; matching takes time with the square of the matches in one text.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The kinds of the base patterns, in this order.
KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
ASSIGNED_LEAST = 12

SPANS = "array<struct<start:int,end:int>>"
#: Entropies are kept as whole numbers of this part of a bit, so that adding and taking off is exact.
UNIT = 1 << 20


def either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


ASSIGN = (
    "(" + "|".join(either_case(word) for word in KEYWORDS) + ")"
    + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


@dataclass(frozen=True)
class CharClass:
    """Characters, the window's length and the least entropy of a window in bits a character."""

    kind: str
    alphabet: str
    window: int
    least_bits: float

    @property
    def pattern(self) -> str:
        return "[" + self.alphabet.replace("-", r"\-") + "]{" + str(self.window) + ",}"


DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
CLASSES = (
    CharClass("entropy_hex", DIGITS + "abcdefABCDEF", 24, 3.0),
    CharClass("entropy_base64", LOWER + LOWER.upper() + DIGITS + "+/_=-", 24, 4.0),
)
#: Candidates that are no secrets: documented sample keys, the alphabet and digits in order, one
#: character over and over, and runs without a digit or without a letter.
ALLOWED = (
    "(?i)example|sample|dummy|changeme",
    "(?i)abcdefghij|0123456789",
    r"^(.)\1*$",
    "^[^0-9]*$",
    "^[^A-Za-z]*$",
)
KINDS = ("assign", "access", "hex", *(c.kind for c in CLASSES))


def matches(text: Column, pattern: str, value_group: int = 0, least: int = 0) -> Column:
    """(start, end, found) of each match, leftmost and not overlapping.

    Lengths of the matches and of the pieces between them give the positions. Matches whose
    ``value_group`` is shorter than ``least`` are passed over after matching.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(hits))
    none = F.array().cast("array<struct<start:int,end:int,found:string>>")
    start = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + F.length(x["gap"])
        end = begin + F.length(x["hit"])
        span = F.struct(begin.alias("start"), end.alias("end"), x["hit"].alias("found"))
        out = F.when(F.length(x["value"]) >= least, F.array_append(state["out"], span)).otherwise(state["out"])
        return F.struct(end.alias("at"), out.alias("out"))

    zipped = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), values.alias("value"))
    spans = F.aggregate(zipped, start, step, lambda state: state["out"])
    return F.when(text.rlike(pattern), spans).otherwise(none)


def _cost(n: int) -> int:
    return round(n * math.log2(n) * UNIT) if n else 0


def hot_windows(run: Column, cls: CharClass) -> Column:
    """(start, end) of the merged windows of ``run`` whose entropy is at least the class's."""
    size, width = len(cls.alphabet), cls.window
    # H = log2(w) - sum(n log2 n) / w, so a window is hot while the sum is at most this.
    most = math.floor(width * (math.log2(width) - cls.least_bits) * UNIT)
    costs = F.array(*(F.lit(_cost(n)).cast("long") for n in range(width + 2)))
    chars = F.split(run, "")
    chars = F.transform(F.filter(chars, lambda c: c != ""), lambda c: F.position(c, F.lit(cls.alphabet)))
    steps = F.arrays_zip(
        chars.alias("comes"),
        F.concat(F.array_repeat(F.lit(0), width), F.slice(chars, 1, F.greatest(F.size(chars) - width, F.lit(0)))).alias("goes"),
        F.sequence(F.lit(1), F.size(chars)).alias("end"),
    )
    zero = F.struct(
        F.array_repeat(F.lit(0), size).alias("counts"), F.lit(0).cast("long").alias("sum"), F.array().cast(SPANS).alias("out")
    )

    def step(state: Column, x: Column) -> Column:
        comes, goes, end = x["comes"], x["goes"], x["end"]
        counts = F.transform(
            state["counts"],
            lambda n, i: n + F.when(i + 1 == comes, 1).otherwise(0) - F.when(i + 1 == goes, 1).otherwise(0),
        )
        had = F.element_at(state["counts"], comes)
        total = state["sum"] + F.element_at(costs, had + 2) - F.element_at(costs, had + 1)
        # The character that leaves, counted after the other has come.
        held = F.element_at(state["counts"], F.greatest(goes, F.lit(1))) + F.when(goes == comes, 1).otherwise(0)
        total = total - F.when(
            goes > 0, F.element_at(costs, held + 1) - F.element_at(costs, F.greatest(held, F.lit(1)))
        ).otherwise(0)
        last = F.try_element_at(state["out"], F.lit(-1))
        grown = F.when(
            last["end"] >= end - width,
            F.concat(
                F.slice(state["out"], 1, F.size(state["out"]) - 1),
                F.array(F.struct(last["start"].alias("start"), end.alias("end"))),
            ),
        ).otherwise(F.array_append(state["out"], F.struct((end - width).alias("start"), end.alias("end"))))
        out = F.when((end >= width) & (total <= most), grown).otherwise(state["out"])
        return F.struct(counts.alias("counts"), total.alias("sum"), out.alias("out"))

    return F.aggregate(steps, zero, step, lambda state: state["out"])


def entropy_spans(text: Column, cls: CharClass, allowed: tuple[str, ...] = ALLOWED) -> Column:
    """(start, end) of the spans of high entropy in all candidates of a class that are not allowed."""
    fine = F.lit(False)
    candidates = matches(text, cls.pattern)
    kept = F.filter(candidates, lambda c: ~_any_of([c["found"].rlike(p) for p in allowed], fine))
    spans = F.transform(
        kept,
        lambda c: F.transform(
            hot_windows(c["found"], cls),
            lambda s: F.struct((c["start"] + s["start"]).alias("start"), (c["start"] + s["end"]).alias("end")),
        ),
    )
    return F.flatten(spans)


def _any_of(tests: list[Column], total: Column) -> Column:
    for test in tests:
        total = total | test
    return total


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``_spans``: (start, kind, end) of all spans by start, then kind; kind indexes ``KINDS``."""
    body = F.coalesce(F.col(text), F.lit(""))
    found = [
        matches(body, ASSIGN, 2, ASSIGNED_LEAST),
        matches(body, ACCESS),
        matches(body, HEX),
        *(entropy_spans(body, c) for c in CLASSES),
    ]

    def named(kind: int, spans: Column) -> Column:
        # The kind is not an argument of the lambda: Spark would pass the element's place for it.
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))

    return docs.withColumn("_spans", F.array_sort(F.concat(*(named(k, spans) for k, spans in enumerate(found)))))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    )


def redact(docs: DataFrame, mark: str = "[SECRET]", text: str = "text") -> DataFrame:
    """``docs`` with every found span replaced by ``mark``; overlapping spans get one mark."""
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    body = F.col(text)

    def step(done: Column, s: Column) -> Column:
        new = F.concat(done["out"], F.substr(body, done["at"] + 1, s["start"] - done["at"]), F.lit(mark))
        out = F.when(s["start"] >= done["at"], new).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), out.alias("out"))

    clean = F.aggregate("_spans", state, step, lambda done: F.concat(done["out"], F.substr(body, done["at"] + 1)))
    found = find_secrets(docs, text).withColumn(text, F.when(F.size("_spans") > 0, clean).otherwise(body))
    return found.drop("_spans")
