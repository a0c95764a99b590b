"""Licence scan: ordered signature rules behind keywords, with built-in functions only.

Texts are read as lower-case words with single spaces. One cheap search for the trigger
words lets most texts pass. In the others, a rule's regex runs where its keyword occurs.
Overlapping detections are resolved by priority and containment: a detection goes if one of
the same or a stronger level covers its interval, where the longer one, then the earlier
rule, wins. Everything about a text happens in its own row: no shuffle, nothing to skew.

Defined results: a null or empty text has no words, no places and score 0. Detections are
whole words; places of the base phrases are reported always, other rules cannot remove
them or their labels. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercatura.llm.common import UPPER
from mercatura.llm.license_rules import BASE, LEVELS, RULES, TRIGGERS, Rule

_SEPARATORS = "".join(
    chr(c) for c in range(128) if not (chr(c).isdigit() or chr(c).isascii() and chr(c).isalpha())
)


def spaced_words(text: Column) -> Column:
    """The text in lower case with a space for every ASCII character outside words."""
    to = UPPER.lower() + " " * len(_SEPARATORS)
    return F.translate(F.coalesce(text, F.lit("")), UPPER + _SEPARATORS, to)


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _whole_words(regex: str) -> str:
    return f"(?<= )(?:{regex})(?= )"


def rule_table(rules: Iterable[Rule]) -> Column:
    """The rules as a constant array of structs."""
    return F.array(
        *[
            F.struct(
                F.lit(number).alias("rule"),
                F.lit(r.label).alias("label"),
                F.lit(r.level).alias("level"),
                F.lit(r.keyword).alias("keyword"),
                F.lit(_whole_words(r.regex)).alias("regex"),
            )
            for number, r in enumerate(rules)
        ]
    )


_SPAN = "struct<start_word:int,end_word:int,level:int,rule:int,label:string>"


def _places(words: Column, rule: Column) -> Column:
    """All matches of a rule as spans of words, in order.

    The text before, between and after the matches counts the words up to each of them.
    """
    regex = rule["regex"]
    found = F.regexp_extract_all(words, regex, F.lit(0))
    between = F.slice(F.split(words, regex, -1), F.lit(1), F.size(found))

    def add(done: Column, pair: Column) -> Column:
        start = done["at"] + _spaces(pair["gap"])
        end = start + _spaces(pair["match"])
        span = F.struct(
            start.alias("start_word"),
            end.alias("end_word"),
            rule["level"].alias("level"),
            rule["rule"].alias("rule"),
            rule["label"].alias("label"),
        )
        return F.struct(end.alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

    return F.aggregate(
        F.zip_with(found, between, lambda m, g: F.struct(m.alias("match"), g.alias("gap"))),
        F.struct(F.lit(-1).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("spans")),
        add,
        lambda done: done["spans"],
    )


def _resolve(spans: Column) -> Column:
    """Spans without those covered by a span of the same or a stronger level.

    In order of start, longest first, a span is covered exactly if the furthest end seen
    so far at its level or above reaches its own end.
    """
    levels = sorted(LEVELS)
    ordered = F.array_sort(
        F.transform(
            spans,
            lambda s: F.struct(
                s["start_word"].alias("start_word"),
                (-s["end_word"]).alias("back"),
                s["level"].alias("level"),
                s["rule"].alias("rule"),
                s["label"].alias("label"),
            ),
        )
    )

    def add(done: Column, span: Column) -> Column:
        end = -span["back"]
        reach = F.lit(-1)
        for level in levels:
            reach = F.when(span["level"] >= level, F.greatest(reach, done[f"end_{level}"])).otherwise(reach)
        kept = F.struct(
            span["start_word"].alias("start_word"),
            end.alias("end_word"),
            span["level"].alias("level"),
            span["rule"].alias("rule"),
            span["label"].alias("label"),
        )
        ends = [
            F.when(span["level"] == level, F.greatest(end, done[f"end_{level}"]))
            .otherwise(done[f"end_{level}"])
            .alias(f"end_{level}")
            for level in levels
        ]
        spans = F.when(reach >= end, done["spans"]).otherwise(F.concat(done["spans"], F.array(kept)))
        return F.struct(*ends, spans.alias("spans"))

    empty = F.array().cast(f"array<{_SPAN}>").alias("spans")
    start = F.struct(*[F.lit(-1).alias(f"end_{level}") for level in levels], empty)
    return F.aggregate(ordered, start, add, lambda done: done["spans"])


def scan(docs: DataFrame, rules: Iterable[Rule] = RULES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, base (spans of the base phrases), spans (kept
    detections), each an array of (start_word, end_word, level, rule, label)."""
    triggers = "|".join(t.replace(" ", " +") for t in TRIGGERS)
    base = [Rule(label, 2, phrase, phrase) for label, phrase in BASE]
    spaced = docs.select("doc_id", spaced_words(F.col("text")).alias("spaced"))
    spaced = spaced.select(
        "doc_id",
        F.regexp_count("spaced", F.lit("[^ ]+")).cast("bigint").alias("n_words"),
        F.when(
            F.col("spaced").rlike(triggers),
            F.concat(F.lit(" "), F.trim(F.regexp_replace("spaced", " +", " ")), F.lit(" ")),
        ).alias("words"),
    )
    words = F.col("words")

    def places(table: Column) -> Column:
        applying = F.filter(table, lambda r: F.contains(words, r["keyword"]))
        return F.flatten(F.transform(applying, lambda r: _places(words, r)))

    none = F.array().cast(f"array<{_SPAN}>")
    return spaced.select(
        "doc_id",
        "n_words",
        F.coalesce(F.when(words.isNotNull(), places(rule_table(base))), none).alias("base"),
        F.coalesce(F.when(words.isNotNull(), _resolve(places(rule_table(rules)))), none).alias("spans"),
    )


def summary(scanned: DataFrame) -> DataFrame:
    """One row per document with counts, ends, labels and the score of its best detection."""
    starts = F.transform("base", lambda s: s["start_word"].cast("bigint"))

    def joined(*spans: str) -> Column:
        labels = F.concat(*[F.transform(s, lambda x: x["label"]) for s in spans])
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    found = F.transform(F.concat("base", "spans"), lambda s: s["level"])
    certainty = F.lit(0.0)
    for level in sorted(LEVELS, reverse=True):
        has_level = F.array_contains(found, F.lit(level))
        certainty = F.when(has_level, F.lit(LEVELS[level])).otherwise(certainty)
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined("base").alias("base_labels"),
        joined("base", "spans").alias("labels"),
        certainty.alias("score"),
    )
