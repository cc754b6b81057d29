from pyspark.sql import functions as F

from recordlog.llm import fingerprints

from .cases import documents, frame, words


def test_edited_texts(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 7)
    rows = list({r[0]: r for r in documents() if r[0] is not None}.values())
    got = {r["id"]: r for r in fingerprints.compare(frame(spark, rows, extra="next string,range int,sketch int")).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    assert len(got) == len(rows)
    for k, (i, t, *_) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        third = len(t) // 3
        assert got[i]["edited"] == t[:len(t) - third] + following[:third]
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1


def test_odd_rows_each_have_a_result(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 5)
    rows = documents()
    got = fingerprints.with_next(frame(spark, rows)).collect()
    assert len(got) == len(rows) and all(r["next"] is not None for r in got)
    # each text is the next of exactly one row
    assert sorted(r["next"] for r in got) == sorted(r["text"] for r in got)


def test_sketches(spark):
    long = " ".join(f"w{k}" for k in range(4000))
    texts = ["", "  ", "one", "one two three", "a b c d e", long, long + " and more", " ".join(f"w{k}" for k in range(2000)), "a  b\nc d e"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").select("id", fingerprints.sketch(F.col("text")).alias("s"))
    got = {r["id"]: r["s"] for r in df.collect()}
    assert got[0] == got[1] == [] and all(got[k] for k in range(2, 9)) and got[4] == got[8]
    n = len(words(long)) - 4
    assert abs(len(got[5]) / n - 1 / 4) < 0.05  # the fixed fraction of the shingles
    assert set(got[7]) <= set(got[5]) | {min(got[7])}
    near = spark.createDataFrame([(got[5], got[7], got[0], got[3])], "a array<bigint>, b array<bigint>, e array<bigint>, f array<bigint>") \
        .select(fingerprints.containment(F.col("a"), F.col("b")), fingerprints.containment(F.col("e"), F.col("e")),
                fingerprints.containment(F.col("e"), F.col("f")), fingerprints.containment(F.col("a"), F.col("a")),
                fingerprints.merged(F.col("a"), F.col("b"))).first()
    assert near[0] > 0.98 and near[1] == 1 and near[2] == 0 and near[3] == 1
    assert near[4] == sorted(set(got[5]) | set(got[7]))


def test_one_row_and_empty_table(spark):
    one = fingerprints.compare(frame(spark, [(1, "abcdef", "en", "s", 6)])).collect()
    assert [r["edited"] for r in one] == ["abcdab"]
    assert fingerprints.compare(frame(spark, [])).count() == 0
