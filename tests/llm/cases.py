"""Small tables with the cases that every operator must stand."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and to in that was with for on river stone light wind bread house music paper north winter".split()


def prose(rng: random.Random, n: int) -> str:
    out = [rng.choice(WORDS) for _ in range(n)]
    for i in range(12, n, 13):
        out[i] += ".\n"
    return " ".join(out)


def rows(n: int = 40, seed: int = 1) -> list[tuple]:
    """Documents with copies, near copies, nulls, empty and white texts, symbols, other scripts and repeated rows."""
    rng = random.Random(seed)
    made = [[i, prose(rng, rng.choice([2, 30, 70, 160])), "en", f"src{i % 3}", None] for i in range(n)]
    for i in range(3, n, 7):
        made[i][1] = made[i - 3][1]
    for i in range(5, n, 9):
        w = made[i - 5][1].split(" ")
        w[len(w) // 2] = "changed"
        made[i][1] = " ".join(w)
    made[1][1] = None
    made[2][1] = ""
    made[4][1] = " \t\n "
    made[6][1] = "naïve ÉCOLE größer — Привет мир 漢字 \U0001f600 $$$ ### 100%"
    made[8][2] = None
    made[9][3] = None
    made.append(list(made[0]))
    made.append([None, made[0][1], None, None, None])
    made.append([10_000, "word " * 3000, "en", "src0", 15000])
    return [tuple(r[:4] + [len(r[1]) if r[1] else None]) for r in made]


def table(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
