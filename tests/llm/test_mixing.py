"""Mixing: targets by repeated resharing, exact cuts, drawn rows."""

from collections import Counter
from fractions import Fraction

from pyspark.sql import functions as F

from mercatura.llm import mixing


def reshared(sizes, weights=(5, 2, 1), most=3):
    """Targets by resharing the excess until none is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    targets, pool, active = {}, Fraction(sum(sizes.values())), list(order)
    while active:
        total = sum(weight[s] for s in active)
        over = [s for s in active if pool * weight[s] / total > most * sizes[s]]
        if not over:
            return targets | {s: pool * weight[s] / total for s in active}
        for s in over:
            targets[s] = Fraction(most * sizes[s])
            pool -= targets[s]
        active = [s for s in active if s not in over]
    return targets


def rows():
    out = []
    for i in range(300):
        source = ["hot", "hot", "hot", "b", "c", "tiny", None, "é"][i % 8 if i % 5 else 0]
        out.append((i, "w " * (i % 17) + "end", source, "en", i))
    out += [(400, None, "empty", "en", 0), (401, "", "hot", "en", 0), (402, "x " * 9000, "b", "en", 0)]
    out += [(None, "no id", "c", "en", 1), (7, "w w again", "hot", "en", 1), (403, "one", "tiny", "en", 1)]
    return out + [(403, "one", "tiny", "en", 1)]


SCHEMA = "doc_id long, text string, source string, size string, n_chars int"


def table(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(4)


def test_targets_and_exact_budgets(spark):
    mixed = mixing.mix(table(spark)).collect()
    assert len(mixed) == len(rows())
    sizes, taken = Counter(), Counter()
    for r in mixed:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size
    expected = reshared(dict(sizes))
    for r in mixed:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - float(expected[r.source])) < 1e-6
    for source, target in expected.items():
        assert taken[source] == int(target)


def test_reruns_and_partitions_agree(spark):
    plain = [sorted(map(str, mixing.mix(table(spark).repartition(n)).collect())) for n in (1, 5)]
    assert plain[0] == plain[1]


def test_drawn_rows_are_whole_and_near_the_taken_words(spark):
    """Every drawn text is one of the table; the cut document is there if that is nearer."""
    docs = table(spark)
    drawn = mixing.draw(docs)
    assert drawn.columns == docs.columns and dict(drawn.dtypes) == dict(docs.dtypes)
    assert {tuple(r) for r in drawn.collect()} <= set(rows())
    copies = Counter((r.doc_id, r.source, r.text) for r in drawn.collect())
    taken, size = Counter(), {}
    for r in mixing.mix(docs.withColumn("body", F.col("text")), keep=["body"]).collect():
        taken[r.doc_id, r.source, r.body] += r.taken
        size[r.doc_id, r.source, r.body] = r["size"]
    for row, words in taken.items():
        assert abs(copies[row] * size[row] - words) <= size[row] / 2
        assert words or not copies[row]
    cut = [row for row, words in taken.items() if size[row] and words % size[row]]
    assert 0 < len(cut) <= 7


def test_empty_and_wordless_tables(spark):
    assert mixing.mix(table(spark).limit(0)).count() == 0
    assert mixing.draw(table(spark).limit(0)).count() == 0
    wordless = spark.createDataFrame([(1, None, None, "", 0), (2, " ", "a", "", 1)], SCHEMA)
    assert {(r.doc_id, r.taken, r.target) for r in mixing.mix(wordless).collect()} == {
        (1, 0, 0.0),
        (2, 0, 0.0),
    }
    assert mixing.draw(wordless).count() == 0
