"""Documents with every awkward case, and plain versions of what the operators compute."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Extra columns carry names that operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, label int, h string, block long, n long, kept boolean, comp long, norm string, rank long"


def prose(seed, n):
    words = "the of and river stone bright walking under mountain quiet lantern garden winter paper harbour letters yellow simple morning engine".split()
    return " ".join(words[(seed * 7 + i * i * (seed % 5 + 1) + i // 3) % len(words)] + ("." if i % 11 == 10 else "") for i in range(n))


def rows():
    long_word, repeated = "x" * 150_000, "same line again\n" * 400
    texts = [
        prose(1, 200), prose(1, 200), prose(1, 200).upper(), prose(2, 300), prose(2, 300) + " tail words here", None, "", "   \t\n", "one", "ONE", "a b c", "a b c", long_word, repeated, "Ünïcödé — ñandú 漢字 ÀÈ's don't 12345 !!",
        prose(3, 120) + " " + prose(4, 80), prose(5, 60) + " " + prose(4, 80), prose(4, 90), "\n\n\n", "Licensed under the MIT License. Apache License, Version 2.0 cc by-nc", prose(6, 1200), "# * $ % & | < >" * 20, "l'été s'en va\r\nvoilà ça", prose(7, 51),
    ]
    out = [(k * 3 + 1, t, ("en", "fr", None)[k % 3], (None, "b", "a", "ß")[k % 4], len(t or "")) for k, t in enumerate(texts)]
    out += [out[3], out[3], (None, prose(2, 300), "en", "a", 1), (None, None, None, None, None)]
    return [r + (1, 2, "x", 3, 4, True, 5, "y", 6) for r in out]


def documents(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_text(result):
    return sorted(result.collect(), key=str)
