"""Small documents with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing columns."""
import random
import string

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def sentence(r: random.Random, n: int) -> str:
    return " ".join("".join(r.choice("abcdeiou") for _ in range(r.randint(1, 6))) for _ in range(n))


def documents(seed: int = 1, n: int = 60) -> list[tuple]:
    r = random.Random(seed)
    shared = sentence(r, 30)
    rows = []
    for i in range(n):
        lines = [sentence(r, r.randint(1, 40)) for _ in range(r.randint(1, 5))]
        if i % 4 == 0:
            lines.insert(r.randrange(len(lines) + 1), shared)
        if i % 7 == 3:
            words = shared.split()
            words[r.randrange(30)] = "other"
            lines.append(" ".join(words))
        rows.append((i * 3, "\n".join(lines), "en", f"s{i % 5}" if i % 11 else None))
    rows[7] = (21, None, None, None)
    rows[8] = (24, "", "en", "s1")
    rows[9] = (27, " \t\n ", "en", "s1")
    rows[10] = (30, rows[4][1], "en", "s0")          # an exact copy
    rows[11] = (33, rows[12][1] + " more", "en", "s0")  # a near copy
    rows += [rows[5], rows[5]]                        # repeated rows
    rows += [(rows[6][0], "same id, other text " + shared, "en", "s2")]
    rows += [(None, "a text without an id " + shared, "en", "s3"), (None, None, None, None)]
    rows += [(10_001, sentence(r, 9000), "en", "s1"), (10_002, "x" * 60_000, "en", "s1"), (-5, "tiny", "en", "s2")]
    return [(a, t, la, s, None if t is None else len(t)) for a, t, la, s in rows]


def frame(spark, rows=None, extra: str = ""):
    """Documents as a DataFrame; ``extra``: more columns (name type), all null."""
    df = spark.createDataFrame(documents() if rows is None else rows, SCHEMA)
    for column in filter(None, extra.split(",")):
        name, kind = column.split()
        df = df.selectExpr("*", f"CAST(NULL AS {kind}) AS `{name}`")
    return df.repartition(3)


def words(text) -> list[bytes]:
    return (text or "").encode().split()


PRINTABLE = string.printable
