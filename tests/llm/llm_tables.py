"""Tables that the tests of the training-data operators share."""

import random

from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"
# names that operators use for their own columns
CLASHES = ["row", "ord", "mark", "rid", "fp0", "host", "n_words", "kept", "text_", "found", "component_id", "place"]


def prose(seed, n):
    rng = random.Random(seed)
    return [rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(rng.randrange(40)) for _ in range(n)]


def awkward():
    """(doc_id, text, source): nulls, empty and very long texts, ties, repeats, near copies."""
    passage = prose(1, 120)
    edited = [*passage[:57], "changed", *passage[58:]]
    line = "This Line has more than forty characters in it, certainly. "
    mixed = "Ünïcode ßtraße 日本語 𝒳 \u00a0nbsp\u3000wide \x1c sep \x85 nel # * $ 100%"
    return [
        (0, None, "a"),
        (1, "", "a"),
        (2, " \n\t ", None),
        (3, "short text", "a"),
        (4, " ".join(passage), "a"),
        (5, " ".join(passage), "a"),
        (5, " ".join(passage), "a"),
        (6, " ".join(edited), "b"),
        (7, " ".join(prose(2, 60) + passage[20:100] + prose(3, 60)), "b"),
        (None, " ".join(passage[:80]), "b"),
        (8, "\n".join([line, line.upper(), "own words here", line]), "a"),
        (9, "\n".join(["  " + line, "another ending"]), "a"),
        (10, line, "b"),
        (11, line + "\n" + mixed, "b"),
        (12, "\n".join([line] * 3), None),
        (13, line + "\n" + " ".join(prose(4, 40)), "a"),
        (14, "same " * 20000, "a"),
        (15, " ".join(prose(5, 9000)), "b"),
        (16, mixed * 3, "a"),
        (17, "x" * 100_000, "a"),
        (18, "one two three four five six seven eight nine ten " * 2, "a"),
    ]


def docs_of(spark, rows):
    """The rows with further columns, among them names that operators use themselves."""
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType())]
    fields += [T.StructField(name, T.StringType()) for name in CLASHES]
    return spark.createDataFrame([(*r, *[f"x{i}" for i in range(len(CLASHES))]) for r in rows], T.StructType(fields))


def pairs(rows):
    return [(r[0], r[1]) for r in rows]


def by_repr(rows):
    return sorted(map(tuple, rows), key=repr)
