"""The licence scan against every rule tried at every place."""

import random
import re
from re import _parser

import pytest

from mercatura.llm import licenses
from mercatura.llm.license_rules import BASE, LEVELS, RULES, TRIGGERS

SMALL = "/root/testdata/sf0.001"


def brute_force(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    base = []
    for label, phrase in BASE:
        parts = phrase.split()
        base += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    spaced = f" {' '.join(words)} "
    spans = []
    for number, rule in enumerate(RULES):
        for m in re.finditer(f"(?<= )(?:{rule.regex})(?= )", spaced):
            start = spaced[: m.start()].count(" ") - 1
            spans.append((start, start + m[0].count(" "), rule.level, number, rule.label))

    def covers(b, a):
        longer = (b[0], b[1]) != (a[0], a[1])
        return b[0] <= a[0] and b[1] >= a[1] and b[2] <= a[2] and (longer or b[2:4] < a[2:4])

    kept = [a for a in spans if not any(covers(b, a) for b in spans)]
    starts = [i for i, _ in base]
    levels = [2] * bool(base) + [s[2] for s in kept]
    return (
        len(words),
        len(base),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted({label for _, label in base})),
        ",".join(sorted({label for _, label in base} | {s[4] for s in kept})),
        max((LEVELS[level] for level in levels), default=0.0),
    )


def example(tree, rng):
    """A text that a parsed regex matches."""
    out = ""
    for op, value in tree:
        if op is _parser.LITERAL:
            out += chr(value)
        elif op is _parser.IN:
            kind, chosen = rng.choice(value)
            out += chr(chosen if kind is _parser.LITERAL else rng.randint(*chosen))
        elif op is _parser.SUBPATTERN:
            out += example(value[-1], rng)
        elif op is _parser.BRANCH:
            out += example(rng.choice(value[1]), rng)
        else:
            low, high, part = value
            for _ in range(rng.randint(low, min(high, low + 2))):
                out += example(part, rng)
    return out


def examples():
    rng = random.Random(3)
    return [example(_parser.parse(r.regex), rng) for r in RULES for _ in range(3)]


def test_keywords_and_triggers_are_in_every_match():
    rng = random.Random(1)
    for rule in RULES:
        parsed = _parser.parse(rule.regex)
        for _ in range(20):
            text = example(parsed, rng)
            assert rule.keyword in text and any(t in text for t in TRIGGERS), (rule, text)


def test_hundreds_of_rules_of_all_levels():
    assert len(RULES) > 200 and {r.level for r in RULES} == set(LEVELS)
    for _, phrase in BASE:
        assert any(t in phrase for t in TRIGGERS)


def test_equals_brute_force(spark):
    texts = [None, "", " \n", "mit", "Mit  LICENSE", "MIT License MIT-License x mit license", "é cc-by\x00by"]
    texts += [f"x {a.upper()}; {b},\n{a}" for a, b in zip(examples(), reversed(examples()))]
    texts += [" ".join(["word"] * 30_000 + ["Apache License, Version 2.0"] + ["cc by"] * 50)]
    texts += [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    rows = [(i, t, "a", 1) for i, t in enumerate(texts)] + [(None, "MIT license", "b", 2)]
    table = spark.createDataFrame(rows, "doc_id long, text string, words string, rule int")
    got = {r.doc_id: tuple(r)[1:] for r in licenses.summary(licenses.scan(table)).collect()}
    assert got == {r[0]: brute_force(r[1]) for r in rows}
    assert licenses.summary(licenses.scan(table.limit(0))).count() == 0


@pytest.mark.parametrize(
    "text, labels",
    [
        ("Licensed under the Apache License, Version 2.0.", "apache,apache-2.0"),
        ("SPDX-License-Identifier: GPL-3.0-only", "gpl-3.0"),
        ("GNU Lesser General Public License v2.1", "lgpl-2.1"),
        ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc-4.0"),
    ],
)
def test_labels(text, labels):
    assert brute_force(text)[5] == labels
