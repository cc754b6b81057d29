import random
import subprocess
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from recordlog.llm import packing

from .cases import documents, frame

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_part_tokens_equal_the_whole_texts():
    tokenizer = Tokenizer.from_file(PATH)
    texts = ["", "A.B, it's. <|endoftext|> x <|ENDOFTEXT|>, don't, 3.5, a0b, É., Y. ''. .,. ,", "Ünï, ,, 'S. 0 00 x², we've. '"]
    texts += [t for _, t, *_ in documents() if t]
    got = packing.TokenBytes(PATH, most=50, at_once=7).of(iter([t.encode() for t in texts]))
    for t, ids in zip(texts, got):
        assert np.frombuffer(ids, dtype="<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_capitals_before_a_mark_are_not_lowered():
    tokenizer = Tokenizer.from_file(PATH)
    texts = ["J\u030c", "H\u0331abc", "T\u0308", "W\u030a", "Y\u030a", "a J\u030c, H\u0331ABC. Plain ÉCOLE, e\u0301 E\u0301"]
    texts += [t.lower() for t in texts]
    for t, ids in zip(texts, packing.TokenBytes(PATH).of(iter([t.encode() for t in texts]))):
        assert np.frombuffer(ids, dtype="<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_documents_round_trip(spark):
    rows = documents()
    docs = frame(spark, rows, extra="length int,piece string")
    packed = packing.pack_documents(docs, PATH, capacity=256)
    got = packed.collect()
    tokenizer = Tokenizer.from_file(PATH)
    want = Counter()
    for i, t, *_ in rows:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4")
        for k in range(0, len(ids), 256):
            want[i, k // 256, k, len(ids[k:k + 256]), zlib.crc32(ids[k:k + 256].tobytes())] += 1
    assert Counter((r["id"], r["piece"], r["start"], r["length"], r["crc32"]) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r["sequence_id"]].append((r["offset"], r["length"], r["crc32"]))
    full = {r["sequence_id"]: r["ids"] for r in packing.sequences(docs, packed, PATH, capacity=256).collect()}
    assert full.keys() == places.keys()
    for k, parts in places.items():
        at = 0
        for offset, length, crc in sorted(parts):
            assert offset == at and zlib.crc32(full[k][4 * at:4 * (at + length)]) == crc
            at += length
        assert at <= 256 and len(full[k]) == 4 * at


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_everything(seed):
    r = random.Random(seed)
    capacity = r.choice([16, 100, 4096])
    counts = Counter(min(capacity, int(r.paretovariate(0.7) * capacity / 40) + 1) for _ in range(r.choice([1, 30, 3000])))
    for found in (packing.best_fit(counts, capacity), packing.plan(counts, capacity)):
        used = Counter()
        for filling, bins in found.items():
            assert bins > 0 and sum(a * n for a, n in filling) <= capacity
            for a, n in filling:
                used[a] += n * bins
        assert used == counts
    least = -(-sum(a * n for a, n in counts.items()) // capacity)
    assert least <= sum(packing.plan(counts, capacity).values()) <= sum(packing.best_fit(counts, capacity).values())


def best(lengths, capacity):
    """Fewest bins, by trying everything."""
    found = [len(lengths)]

    def place(k, rooms):
        if len(rooms) >= found[0]:
            return
        if k == len(lengths):
            found[0] = len(rooms)
            return
        for j in range(len(rooms)):
            if rooms[j] >= lengths[k] and rooms[j] not in rooms[:j]:
                place(k + 1, rooms[:j] + [rooms[j] - lengths[k]] + rooms[j + 1:])
        place(k + 1, [*rooms, capacity - lengths[k]])
    place(0, [])
    return found[0]


def test_plan_is_optimal_on_small_cases():
    r = random.Random(5)
    for _ in range(25):
        lengths = sorted((r.randint(3, 14) for _ in range(9)), reverse=True)
        assert sum(packing.plan(Counter(lengths), 20).values()) == best(lengths, 20)
        assert sum(packing.plan(Counter(lengths), 20, None).values()) == best(lengths, 20)


def test_hot_length_is_dealt_in_buckets(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_ROWS", 8)
    items = spark.createDataFrame([(i, 5 if i % 3 else 7) for i in range(900)], "id bigint, length bigint")
    got = packing.pack(items, ["id"], 24).collect()
    seqs = defaultdict(list)
    for r in got:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    assert len(got) == 900
    for parts in seqs.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= 24
    assert len(seqs) <= 226  # 150 of 7 + 7 + 5 + 5, the other 300 pieces of 5 by fours, and one to spare


def test_empty_table(spark):
    assert packing.pack_documents(frame(spark, []), PATH).count() == 0


@pytest.mark.parametrize("capacity, want, lengths", [
    (1000, 5, [129, 152, 168, 170, 198, 239, 264, 315, 323, 419, 425, 469, 496, 537, 662]),
    (100, 5, [11, 13, 15, 21, 22, 23, 26, 27, 30, 38, 40, 42, 50, 65, 66]),
    (1000, 6, [198, 210, 224, 234, 240, 262, 286, 328, 354, 366, 383, 479, 521, 564, 615, 658])])
def test_plan_looks_beyond_the_promising_fillings(capacity, want, lengths):
    found = packing.plan(Counter(lengths), capacity)
    assert sum(found.values()) == want == -(-sum(lengths) // capacity)
    assert all(sum(a * n for a, n in f) <= capacity for f in found)
    assert sum((Counter({a: n * bins for a, n in f}) for f, bins in found.items()), Counter()) == Counter(lengths)


def test_every_filling_is_enumerated():
    counts = {3: 2, 4: 2, 5: 1, 7: 1}
    found = {f for x in packing._every_filling(counts, [3, 4, 5, 7], 11) if x for f in [x[1]]}
    assert found == {((7, 1), (4, 1)), ((5, 1), (3, 2)), ((4, 2), (3, 1))}


@pytest.mark.parametrize("most, at_once", [(3, 1), (40, 64), (160_000, 1 << 20)])
def test_pieces_of_parts_equal_the_tokenizers(most, at_once):
    """Letters up to U+00FF, digits and other signs in any order, with parts that only the tokenizer itself can take."""
    r = random.Random(11)
    signs = [*"abcXYZ.,!$'0189_-@()<|/>w", *map(chr, range(0xA0, 0x100)), "\u0301", "\u017f", "\u0130", "\u00b2", "\u4e00", "\x1f", "\x85", "\0"]
    texts = ["".join(r.choice(signs) for _ in range(r.randrange(12))) for _ in range(400)]
    texts = [" ".join(r.choice(texts) for _ in range(r.randrange(20))) for _ in range(80)] + ["", " ", "\t\n a  b\x0b", "</w> a</w>b"]
    tokens = packing.TokenBytes(PATH, most=most, at_once=at_once)
    assert tokens.bare is not None
    tokenizer = Tokenizer.from_file(PATH)
    got = list(tokens.of(iter([t.encode() for t in texts])))
    assert len(got) == len(texts)
    for t, ids in zip(texts, got):
        assert np.frombuffer(ids, dtype="<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_few_parts_go_to_the_whole_tokenizer(monkeypatch):
    """Signs, capitals, numbers and accents do not make a part go through normalizing and splitting."""
    tokens, asked = packing.TokenBytes(PATH), []
    encode = tokens._encode
    monkeypatch.setattr(tokens, "_encode", lambda parts: asked.extend(parts) or encode(parts))
    list(tokens.of(iter(["Été, HENTST!! 555-0499 mkck.02@mail3.example.com naïve$$$ don't".encode()])))
    assert asked == ["don't"]


def test_one_call_of_the_model_takes_a_bounded_number_of_parts():
    tokens = packing.TokenBytes(PATH)
    texts = [" ".join(f"{a}{b}{c}{d}" for a in "abcdefghij" for b in "klmnopqrst" for c in "uvwxyzabcd" for d in "aeioudklmnrst"),
             " ".join(f"don't{k}" for k in range(10_000))]

    class Calls:
        def __init__(self, of):
            self.of, self.sizes = of, []

        def encode_batch_fast(self, parts, add_special_tokens):
            self.sizes.append(sum(p.count(" ") + 1 for p in parts))
            return self.of.encode_batch_fast(parts, add_special_tokens=add_special_tokens)

    whole, tokens.bare, tokens.tokenizer = tokens.tokenizer, Calls(tokens.bare), Calls(tokens.tokenizer)
    for t, ids in zip(texts, tokens.of(iter([t.encode() for t in texts]))):
        assert np.frombuffer(ids, dtype="<u4").tolist() == whole.encode(t, add_special_tokens=False).ids
    for calls, parts in ((tokens.bare, 13_000), (tokens.tokenizer, 10_000)):
        assert max(calls.sizes) <= 8192 and sum(calls.sizes) == parts


HELD = """
import random, re, sys
from pathlib import Path
from recordlog.llm import packing
def held():
    return sum(map(int, re.findall(r"Pss_Anon: +([0-9]+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024
r = random.Random(5)
words = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randrange(3, 9))).encode() for _ in range(60_000)]
tokens = packing.TokenBytes(sys.argv[1])
texts = [b" ".join(r.choices(words, k=2_000)) for _ in range(1_600)]
before = held()
for _ in tokens.of(iter(texts)):
    pass
print(held() - before)
"""


def test_a_worker_does_not_hold_what_a_block_took():
    """20 MB of text, 60,000 different words: what stays after it is the parts that are kept."""
    done = subprocess.run([sys.executable, "-c", HELD, PATH], cwd=Path(__file__).parents[2], capture_output=True, text=True, check=True)
    assert float(done.stdout) < 100
