from collections import Counter, defaultdict

import pytest

from recordlog.llm import mixing

from .cases import SCHEMA, documents, frame, words


def targets(sizes: dict, share=1.5, passes=2, weights=(5, 2, 1)):
    """Water filling, one capped source after another."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, full = share * sum(sizes.values()), {}
    while True:
        rest = total - sum(full.values())
        open_w = sum(w[s] for s in names if s not in full)
        got = {s: rest * w[s] / open_w for s in names if s not in full}
        over = [s for s, t in got.items() if t > passes * sizes[s]]
        if not over:
            return full | got
        full |= {s: passes * sizes[s] for s in over}


@pytest.mark.parametrize("bucket", [4096, 3])
def test_targets_and_taken(spark, monkeypatch, bucket):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket)
    rows = mixing.mix(frame(spark, extra="size int,Target string,_row int")).collect()
    given = documents()
    assert len(rows) == len(given)
    sizes = defaultdict(int)
    for _, t, _, s, _ in given:
        sizes[s] += len(words(t))
    want = targets(sizes)
    took = defaultdict(int)
    for r in rows:
        assert r["size"] == len(words(r["text"])) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] and r["copies"] in (0, 1, 2)
        took[r["source"]] += r["taken"]
    longest = max(len(words(t)) for _, t, *_ in given)
    assert all(abs(took[s] - want[s]) <= longest for s in want)
    assert sum(took.values()) <= 1.5 * sum(sizes.values()) + 1


def test_order_is_by_finish_time_and_bucket_size_changes_nothing(spark, monkeypatch):
    def run():
        return Counter((r["doc_id"], r["size"], r["taken"], round(r["finish_time"], 9)) for r in mixing.mix(frame(spark), share=0.6).collect())
    first = run()
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 2)
    assert run() == first
    cut = min(t for _, size, taken, t in first if size and not taken)
    assert all(taken for _, size, taken, t in first if size and t < cut)


def test_mixed_documents_repeat_rows(spark):
    docs = frame(spark, extra="copies int,_size int")
    got = mixing.mixed_documents(docs)
    assert "text" in got.columns and "_size" in got.columns
    took = Counter()
    for r in mixing.mix(docs).collect():
        took[r["doc_id"]] += r["copies"]
    assert Counter(r["doc_id"] for r in got.collect()) == +took


def test_empty_table(spark):
    assert mixing.mix(frame(spark, []), ).count() == 0
    assert mixing.mixed_documents(spark.createDataFrame([], SCHEMA)).count() == 0
