"""Small corpora for the tests: random prose with copies, near copies and shared passages."""

import random

WORDS = [a + b for a in ("ba", "den", "fo", "gri", "lu", "mar", "no", "pel") for b in ("", "ka", "sto", "ri", "ven", "ulo")]
SCHEMA = "doc_id bigint, text string, lang string, source string, node string, a bigint, doc string"


def prose(rnd, n):
    return " ".join(rnd.choice(WORDS) + str(rnd.randint(0, 60)) for _ in range(n))


def texts(seed=1, n=60):
    """Texts by number, with every kind of trouble."""
    rnd = random.Random(seed)
    made = [None, "", " ", "\n\t", "one", "Two words", "a b c d", "A  B\tc d", "a a a a a a a a", "é ü ß 日本", "x" * 300]
    base = [prose(rnd, rnd.randint(20, 120)) for _ in range(n)]
    passage = prose(rnd, 30)
    for i, text in enumerate(base):
        words = text.split()
        made.append(text)
        if i % 3 == 0:
            made.append(text.replace(" ", "  ", 3))
        if i % 4 == 0:
            for _ in range(3):
                near = words.copy()
                near[rnd.randrange(len(near))] = "changed" + str(rnd.randint(0, 9))
                made.append(" ".join(near))
        if i % 5 == 0:
            made.append(" ".join(words[:10]) + " " + passage + "\n" + " ".join(words[10:]))
    rnd.shuffle(made)
    return made


def frame(spark, rows):
    """Documents of (id, text), with extra columns whose names clash with those the operators use inside."""
    return spark.createDataFrame([(i, t, "en", "src", "n", 1, "d") for i, t in rows], SCHEMA)
