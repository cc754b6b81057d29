import re

from pyspark.sql import functions as F

from recordlog.llm import personal

from .cases import documents, frame

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
TEXTS = [
    "mail a.b_c%+-d@x-y.example.com, or q@z@w.org; no@dot .x@a.b x@y..z a@b.c_d@e.f é𝒳 ü@ü.de m@n.o@p.q",
    "hosts 10.0.0.1 256.1.1.1 1.2.3.4.5 001.002.003.004 1.2.3 99999999999.1.1.1 7.7.7.7x 1.2.3.4.5.6.7.8",
    "cards 4111 1111 1111 1111, 4111-1111-1111-1111 4111111111111112 378282246310005 123 45 6789012345678901234567890",
    "call +1 (555) 123-4567 or +44 20 7946 0958 4111111111111111 and +12 +1-2-3 +49..30.(12)34567-",
    "+1 (555) 123-4567 4539 1488 0343 6467 write to joe [at] example [dot] com or 2001:0db8:85a3:0000:0000:8a2e:0370:7334",
    "", None, " ", "😀 +1 555 123 4567 😀 a@b.co 😀", "a" * 50_000 + "@", "1" * 50_000, "a@" + "b." * 20_000 + "c", "1.1.1.1 " * 3000,
    "+1" + "(" * 30_000, "x@y" * 9000,
]


def luhn(digits: str) -> bool:
    twice = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(x - 9 * (x > 9) for x in twice) % 10 == 0


def base(text: str) -> list[tuple[int, int, int]]:
    out = []
    for n, (kind, p) in enumerate(PATTERNS.items()):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")),
                    "card": lambda: 12 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]():
                out.append((m.start(), n, m.end()))
    return sorted(out)


def test_base_spans_equal_the_contract(spark):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(TEXTS)] + documents()
    got = personal.find(frame(spark, rows, extra="kind int,row int,base string")).collect()
    want = sorted((str(i), base(t or "")) for i, t, *_ in rows)
    assert sorted((str(r["id"]), [tuple(s) for s in r["base"]]) for r in got) == want
    length = {}
    for i, t, *_ in rows:
        length[i] = max(length.get(i, 0), len(t or ""))
    for r in got:  # what the method adds touches no base span
        for s in r["added"]:
            assert all(s["end"] <= b["start"] or b["end"] <= s["start"] for b in r["base"])
            assert 0 <= s["start"] < s["end"] <= length[r["id"]]


def test_adds_what_runs_together_and_no_plain_numbers(spark):
    r = [(k, f"word {k} call +1 (555) 123-45{k:02d} then 10.0.{k}.1 mail u{k}@mail.example.com card 4111111111111111 x") for k in range(40)]
    r += [(100 + k, f"order 41111111111111{k:02d} and page {k}") for k in range(12, 30) if not luhn(f"41111111111111{k}")]
    r += [(200, "reach me +1 (555) 123-4567 4539148803436467 now")]
    got = {x["id"]: x for x in personal.find(spark.createDataFrame(r, "doc_id bigint, text string")).collect()}
    assert [(s["kind"], s["start"], s["end"]) for s in got[200]["added"]] == [(3, 9, 26), (2, 27, 43)]
    assert not any(got[k]["added"] for k in got if k < 200)


def test_reliabilities_find_the_good_labelers():
    counts = {(1, 1, 1, 1, 2, 1): 400, (2, 1, 0, 0, 0, 0): 90, (2, 0, 0, 1, 2, 0): 100, (1, 1, 1, 0, 1, 1): 60}
    post, share, rates = personal.reliabilities(counts)
    assert post[1, 1, 1, 1, 2, 1] > 0.95 and post[2, 0, 0, 1, 2, 0] < 0.05 and 0.6 < share < 0.8
    assert rates[2][0] > 0.9 and rates[2][1] < 0.1


def test_text_form_and_empty_table(spark):
    got = personal.find(frame(spark, [(1, "a@b.co 1.2.3.4", "en", "s", 0)])).select(personal.as_text(F.col("base")), personal.count_of(F.col("base"), "ip"))
    assert got.first()[0] == "email:0:6,ip:7:14" and got.first()[1] == 1
    assert personal.find(frame(spark, [])).count() == 0


def test_windows_only_grow(spark):
    plan = personal._voted(personal._spans(frame(spark), "doc_id", "text"))._jdf.queryExecution().analyzed().toString()
    assert "unboundedpreceding$()" in plan and "unboundedfollowing$()" not in plan


def test_candidates_between_base_spans(spark):
    text = "".join(f"a{k}@b.co (555) 123-4567 +1 555 123 4567 " for k in range(400))
    got = personal.find(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), threshold=1e-9).first()
    assert len(got["base"]) == 800 and [tuple(s) for s in got["base"]] == base(text)
    free = [m.span() for m in re.finditer(r"\(555\) 123-4567", text)]
    assert [(s["start"], s["end"]) for s in got["added"]] == free


def test_main_path_is_native(spark):
    plan = personal.find(frame(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
