"""Every stage of the pipeline against brute force on its own input."""
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from recordlog.llm import mixing, quality
from recordlog.llm.common import store
from recordlog.llm.queries import QUERIES, tokenizer_path

from .test_lines import brute as brute_lines
from .test_lines import brute_short
from .test_simhash import components, fingerprint

SF = "/root/testdata/sf0.001"


def test_registered():
    names = __spark_entry__.queries()
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert names["pipeline"] is corpus_pipeline.run and len(QUERIES) == 13
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["keep_quality", "drop_lines", "drop_near_copies", "mix_sources", "pack"]


@pytest.fixture(scope="module")
def kept(spark):
    """Input and output of every stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        after = store(stage(spark, docs, SF), "stage")
        out.append((docs, after))
        docs = after
    for before, after in out[:-1]:
        assert after.columns == before.columns
    return out


def test_quality_stage(spark, kept):
    before, after = kept[0]
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    wanted = {r["id"] for r in quality.classify(before, labels).collect() if r["predicted"]}
    assert {r[0] for r in after.select("doc_id").collect()} == wanted
    truth = {r[0]: r[1] for r in labels.collect()}
    assert np.mean([(i in wanted) == bool(q) for i, q in truth.items()]) > 0.95


def test_line_stage(kept):
    before, after = kept[1]
    rows = [tuple(r) for r in before.select("doc_id", "text").collect()]
    gone = brute_short(rows)
    want = {i: "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone.get((i, t), [])) for i, t in rows}
    assert {r["doc_id"]: r["text"] for r in after.collect()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())
    assert sum(map(len, gone.values())) > sum(map(len, brute_lines(rows).values()))


def test_near_copy_stage(kept):
    before, after = kept[2]
    fp = {r["doc_id"]: fingerprint(r["text"]) for r in before.collect()}
    root = components(sorted(set(fp.values())), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for i in sorted(fp):
        least.setdefault(root[fp[i]], i)
    assert sorted(r[0] for r in after.select("doc_id").collect()) == sorted(least.values())


def test_mixing_stage(kept):
    before, after = kept[3]
    want = {r["doc_id"]: r["copies"] for r in mixing.mix(before).collect() if r["copies"]}
    assert Counter(r[0] for r in after.select("doc_id").collect()) == want


def test_packing_stage(kept):
    before, after = kept[4]
    tokenizer, want = Tokenizer.from_file(tokenizer_path()), Counter()
    for r in before.select("doc_id", "text").collect():
        ids = np.array(tokenizer.encode(r["text"], add_special_tokens=False).ids + [1], dtype="<u4")
        for at in range(0, len(ids), 4096):
            want[r["doc_id"], at // 4096, at, len(ids[at:at + 4096]), zlib.crc32(ids[at:at + 4096].tobytes())] += 1
    rows = after.collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    ends = Counter()
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends[r["sequence_id"]]
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= 4096 and len(ends) <= -(-sum(ends.values()) // 4096) + 1
