import random

import xxhash

from recordlog.llm import simhash

from .cases import documents, frame


def fingerprint(text) -> int:
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = text.encode().split()
    parts = [b" ".join(w[k:k + 3]) for k in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes: list, linked) -> dict:
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_groups_equal_brute_force(spark):
    rows = documents()
    got = simhash.groups(frame(spark, extra="fp bigint,component int")).collect()
    assert len(got) == len(rows)
    fps = sorted({fingerprint(t) for _, t, *_ in rows})
    root = components(fps, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for i, t, *_ in rows:
        r = root[fingerprint(t)]
        if i is not None and (r not in least or i < least[r]):
            least[r] = i
    want = sorted((str(i), fingerprint(t), str(least.get(root[fingerprint(t)]))) for i, t, *_ in rows)
    assert want == sorted((str(r["id"]), r["fp"] & (1 << 64) - 1, str(r["component"])) for r in got)


def test_links_at_any_distance_equal_brute_force(spark):
    r = random.Random(3)
    fps = [r.getrandbits(64) for _ in range(4)]
    for _ in range(300):
        f = r.choice(fps)
        for _ in range(r.randint(1, 3)):
            f ^= 1 << r.randrange(64)
        fps.append(f)
    fps = sorted(set(fps))
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp bigint")
    for bits in (1, 2, 3):
        pairs = [(a & (1 << 64) - 1, b & (1 << 64) - 1) for a, b in simhash.links(df, bits).collect()]
        assert all((a ^ b).bit_count() <= bits for a, b in pairs)
        found = set(pairs) | {(b, a) for a, b in pairs}
        assert components(fps, lambda a, b: (a, b) in found) == components(fps, lambda a, b: (a ^ b).bit_count() <= bits)


def test_bucket_of_near_copies_stays_small(spark):
    fps = [0] + [1 << i for i in range(63)] + [1 << i | 1 << j for i in range(63) for j in range(i)]
    assert simhash.links(spark.createDataFrame([(f,) for f in fps], "fp bigint"), 2).count() <= 65 * len(fps)


def test_dedup_keeps_the_smallest_id_of_each_group(spark):
    docs = frame(spark, extra="_key int,fp int")
    kept = simhash.dedup(docs)
    assert kept.columns == docs.columns
    rows = documents()
    fps = sorted({fingerprint(t) for _, t, *_ in rows})
    root = components(fps, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for i, t, *_ in rows:
        least.setdefault(root[fingerprint(t)], []).append((i is None, i))
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(min(x)[1]) for x in least.values())


def test_empty_table(spark):
    assert simhash.groups(frame(spark, [])).count() == 0
    assert simhash.dedup(frame(spark, [])).count() == 0
