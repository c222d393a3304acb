"""Small tables with the cases every operator must stand."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed: int, n: int, vocabulary: int = 400) -> list[str]:
    pick = random.Random(seed)
    return ["w" + "abcdefghij"[k % 10] * (k % 3 + 1) + str(k) for k in (pick.randrange(vocabulary) for _ in range(n))]


def corpus(n: int = 60) -> list[tuple]:
    """Texts with exact copies, near copies, shared passages, odd white space and odd letters."""
    passage = " ".join(words(999, 30))
    rows = []
    for k in range(n):
        text = words(k, 20 + 7 * k % 90)
        if k % 5 == 1:  # a near copy of the one before, with a word changed
            text = rows[-1][1].split()
            text[len(text) // 2] = f"changed{k}"
        if k % 7 == 3:
            text = text[:9] + passage.split() + text[9:]
        joined = " ".join(text)
        if k % 6 == 2:
            joined = joined.replace(" w", "\n\tw", 3).replace("wa", "Wé", 2) + "  \x0b\x0c end"
        if k % 11 == 4 and k > 20:
            joined = rows[k - 20][1]
        rows.append((k * 3, joined, "xy"[k % 2], f"src{k % 3}", len(joined)))
    return rows


EDGES = [
    (1000, None, "x", None, None),
    (1001, "", None, "s", 0),
    (1002, "   \n ", "x", "s", 5),
    (1003, "one two", "y", "s", 7),
    (1004, "one two", "y", "s", 7),
    (1004, "one two", "y", "s", 7),  # a repeated row
    (None, "no id here at all but words enough to count", "x", "s", 1),
    (1005, "1234 5678 !!", "x", "s", 1),
    (1006, " ".join(words(5, 30_000, 9000)), "x", "s", 1),  # very long
    (1007, "x" * 20_000, "y", "s", 1),  # one very long word
]


def frame(spark, rows, extra=()):
    """documents, with extra columns whose names operators use themselves."""
    from pyspark.sql import functions as F

    made = spark.createDataFrame(rows, SCHEMA)
    return made.withColumns({name: F.lit(7) for name in extra})
