"""Small fixture tables: nulls, empty and very long texts, ties, repeated rows, clashing columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SHARED = " ".join(f"common{i}" for i in range(60))


def documents(spark, seed=5, n=60):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 90))) for _ in range(n)]
    for k in range(0, n, 7):  # a shared passage, cut at various places
        a, b = sorted(rnd.sample(range(61), 2))
        texts[k] += "\n" + " ".join(SHARED.split()[a:b]) + "\t tail " + rnd.choice(words)
    for k in range(0, n, 9):  # near copies
        texts[k] = texts[k - 1].replace(" w7 ", " w8 ") + " x"
    rows = [(i * 3 + 1, t, rnd.choice(["en", "fr"]), "src0", len(t)) for i, t in enumerate(texts)]
    long_text = " ".join(rnd.choice(words) for _ in range(30000))
    rows += [(1000, texts[4], "en", "src1", 1), (2, texts[4].upper(), "en", "src1", 1), rows[5], rows[5],
             (1001, None, None, None, None), (1002, "", "en", None, 0), (1003, " \t\n ", "fr", "src2", 4),
             (1004, "é Ünï  ñ　x 😀 1", "fr", "src2", 9), (1005, long_text, "en", "src3", 5), (1006, long_text + " end", "en", "src3", 5),
             (1007, "same " * 40, "en", "src3", 5), (1008, "same " * 40, "en", "src3", 5),
             (None, texts[6], "en", "src4", 7), (None, None, None, None, None), (-4, texts[6], "fr", "src4", 7)]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark, schema=SCHEMA):
    return spark.createDataFrame([], schema)
