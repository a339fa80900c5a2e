"""License scans by ordered signature rules (op 10), on DataFrame functions only.

``license_rules.txt`` holds hand-written patterns over a text's words (ASCII
letters lower-cased, joined by single spaces), in order of priority, each with
a keyword that its matches must contain. One expression tests a text for any
keyword; only such texts are normalised, and only rules whose keyword is among
the text's words are matched. Matches are intervals of words. Of overlapping
ones, a match inside another is suppressed, and of two that cross the one whose
rule stands first stays.

Defined results: null is the empty text, without words, labels or places and
with score 0. Repeated rows get equal results. A rule's keyword is part of its
every match, so the gate loses nothing. Result columns replace columns of the
same name; others pass through; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import re
import string
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RULES_FILE = Path(__file__).with_name("license_rules.txt")
#: How much a match of a rule kind says that the text states a license.
TRUST = {"i": 0.95, "g": 0.9, "n": 0.6, "w": 0.3}
#: Phrases whose places are counted, and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_IN_RAW = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@functools.cache
def rules() -> list[tuple[str, str, str, str]]:
    """(label, kind, keyword, pattern) in order of priority."""
    lines = RULES_FILE.read_text(encoding="utf-8").splitlines()
    return [tuple(x.strip() for x in line.split(" | ", 3)) for line in lines if line and not line.startswith("#")]


def any_of(words: list[str]) -> str:
    """A pattern for any of the words, with common beginnings shared."""
    heads: dict[str, list[str]] = {}
    for w in sorted(set(words)):
        heads.setdefault(w[:1], []).append(w[1:])
    if list(heads) == [""]:
        return ""
    parts = [re.escape(h) + any_of(rest) for h, rest in heads.items() if h]
    return f"(?:{'|'.join(parts)}){'?' if '' in heads else ''}"


def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spaces(x: str) -> str:
    return f"(length({x}) - length(replace({x}, ' ', '')))"


def _places(pieces: str, matches: str, value: str) -> str:
    """SQL: for each match the struct ``value`` of its first word s and the word
    after its last e, from the pieces between the matches."""
    step = f"struct(a.n + {_spaces('x.p')} + {_spaces('x.m')} as n, array_append(a.out, {value}) as out)"
    start = f"a.n + {_spaces('x.p')} - 1"
    step = step.replace("$s", f"({start})").replace("$e", f"({start} + {_spaces('x.m')} + 1)")
    typed = "array(struct(cast(0 as int) as s, cast(0 as int) as e, cast(0 as int) as r))"
    zipped = f"transform({matches}, (m, i) -> struct({pieces}[i] as p, m as m))"
    return f"aggregate({zipped}, struct(cast(0 as int) as n, filter({typed}, y -> false) as out), (a, x) -> {step}, a -> a.out)"


def _resolved(found: str) -> str:
    """SQL: the intervals that stand, from an array of (s, e, r) structs."""
    order = "(l, r) -> case when l.s != r.s then l.s - r.s when l.e != r.e then r.e - l.e else l.r - r.r end"
    last = "element_at(a, -1)"
    step = (
        f"case when size(a) = 0 or x.s >= {last}.e then array_append(a, x) "
        f"when x.e <= {last}.e then a "
        f"when x.r < {last}.r then array_append(slice(a, 1, size(a) - 1), x) else a end"
    )
    return f"aggregate(array_sort({found}, {order}), filter({found}, y -> false), (a, x) -> {step})"


def scanned(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, n_base, first_word, last_word, base_labels, labels,
    score and ``detections``: (first word, word after the last, label, rule)."""
    raw = F.coalesce(F.col(text), F.lit(""))
    keywords = sorted({k for _, _, k, _ in rules()} | {p.rpartition(" ")[2] for p in BASE})
    gate = raw.rlike(f"(?i)(?<![0-9A-Za-z]){any_of(keywords)}")
    lowered = F.translate(raw, string.ascii_uppercase, string.ascii_lowercase)
    norm = F.when(gate, F.concat(F.lit(" "), F.trim(F.regexp_replace(lowered, SEPARATORS, " ")), F.lit(" ")))
    table = "array(" + ", ".join(f"struct({k} as r, {_literal(kw)} as k, {_literal(f'(?<= )(?:{rx})(?= )')} as rx)" for k, (_, _, kw, rx) in enumerate(rules())) + ")"
    base = _literal("(?<= )(?:" + "|".join(BASE) + ")(?= )")
    hits = f"transform(filter({table}, r -> array_contains(_words, r.k)), r -> struct(r.r as r, split(_norm, r.rx) as p, regexp_extract_all(_norm, r.rx, 0) as m))"
    by_rule = "flatten(transform(_hits, h -> " + _places("h.p", "h.m", "struct($s as s, $e as e, h.r as r)") + "))"
    labels = F.array(*[F.lit(x[0]) for x in rules()])
    doubt = F.array(*[F.lit(1 - TRUST[x[1]]) for x in rules()])
    base_of = F.create_map(*[F.lit(x) for pair in BASE.items() for x in pair])
    out = (
        docs.withColumn("n_words", F.regexp_count(raw, F.lit(WORD_IN_RAW)).cast("long"))
        .withColumn("_norm", norm)
        .withColumn("_words", F.when(F.col("_norm").isNotNull(), F.array_intersect(F.array(*[F.lit(k) for k in keywords]), F.split("_norm", " "))))
        .withColumn("_hits", F.expr(f"if(size(_words) > 0, {hits}, null)"))
        .withColumn("_hits", F.expr("filter(_hits, h -> size(h.m) > 0)"))
        .withColumn("_found", F.expr(by_rule))
        .withColumn("_stand", F.expr(_resolved("_found")))
        .withColumn("_pieces", F.expr(f"if(array_contains(_words, 'license'), split(_norm, {base}), null)"))
        .withColumn("_phrases", F.expr(f"if(size(_pieces) > 1, regexp_extract_all(_norm, {base}, 0), null)"))
        .withColumn("_starts", F.expr(_places("_pieces", "_phrases", "struct($s as s, $e as e, 0 as r)")))
    )
    base_labels = F.coalesce(F.array_sort(F.array_distinct(F.transform("_phrases", lambda p: base_of[p]))), F.array().cast("array<string>"))
    own = F.coalesce(F.transform("_stand", lambda x: F.get(labels, x["r"])), F.array().cast("array<string>"))
    return (
        out.withColumn("n_base", F.coalesce(F.size("_phrases"), F.lit(0)).cast("long"))
        .withColumn("n_base", F.greatest("n_base", F.lit(0).cast("long")))
        .withColumn("first_word", F.expr("cast(_starts[0].s as long)"))
        .withColumn("last_word", F.expr("cast(element_at(_starts, -1).s as long)"))
        .withColumn("base_labels", F.array_join(base_labels, ","))
        .withColumn("labels", F.array_join(F.array_sort(F.array_union(base_labels, own)), ","))
        .withColumn("score", F.lit(1.0) - F.coalesce(F.aggregate("_stand", F.lit(1.0), lambda p, x: p * F.get(doubt, x["r"])), F.lit(1.0)))
        .withColumn(
            "detections",
            F.coalesce(
                F.transform("_stand", lambda x: F.struct(x["s"].alias("first_word"), x["e"].alias("end_word"), F.get(labels, x["r"]).alias("label"), x["r"].alias("rule"))),
                F.array().cast("array<struct<first_word:int,end_word:int,label:string,rule:int>>"),
            ),
        )
        .drop("_norm", "_words", "_hits", "_found", "_stand", "_pieces", "_phrases", "_starts")
    )

