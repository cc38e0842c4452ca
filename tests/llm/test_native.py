"""Fingerprints and shards against plain Python on small, awkward tables."""

import hashlib
import itertools
import random
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from kinrank.llm import minhash, sharding

SCHEMA = "doc_id long, text string, fp string, _k int"


def write(spark, tmp_path, rows, parts=3):
    df = spark.createDataFrame([(i, t, "clash", 5) for i, t in rows], SCHEMA).repartition(parts)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def long_of(x):
    return x - (1 << 64) if x >> 63 else x


def xx(data, seed):
    return xxhash.xxh64_intdigest(data, seed & ((1 << 64) - 1))


def fingerprint(text):
    words = [w for w in (text or "").encode().split() if w]
    h = [xx(w, 42) for w in words]
    runs = [h] if 0 < len(h) < 5 else [h[i:i + 5] for i in range(len(h) - 4)]
    bins = [None] * 256
    for r in runs:
        s = 42
        for x in r:
            s = xx(x.to_bytes(8, "little"), s)
        b, v = s >> 56, s & minhash.MARK
        bins[b] = v if bins[b] is None else min(v, bins[b])
    bins = bins[128:] + bins[:128]                 # signed order
    if not runs:
        return "0" * 256
    start = [(b * 0x9E3779B1 >> 7) % 256 for b in range(256)]
    step = [((b + 1) * 0x85EBCA6B >> 9) % 256 | 1 for b in range(256)]
    full = [v if v is not None else next(bins[(start[i] + t * step[i]) % 256] for t in range(256)
                                         if bins[(start[i] + t * step[i]) % 256] is not None) for i, v in enumerate(bins)]
    return "".join("%x" % (v & 15) for v in full)


def alike(a, b):
    same = sum(x == y for x, y in zip(a, b))
    return max(0.0, (same / 256 - 1 / 16) / (1 - 1 / 16))


def texts(seed, n=60):
    r = random.Random(seed)
    say = lambda k: " ".join("".join(r.choice("abcdeé漢😀") for _ in range(r.randint(1, 6))) for _ in range(k))
    out = [None, "", " ", "x", "one two three four", "\t a  b\nc\x0bd\x0ce\rf ", "é" * 50, "z " * 5000, say(9000)]
    return out + [say(r.randint(1, 400)) for _ in range(n)] + out[4:5] * 3


def test_fingerprints_match_plain_python(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(minhash, "BUCKET_BYTES", 20_000)
    rows = list(zip(random.Random(1).sample(range(-99, 999), 72), texts(1)))
    got = {r.doc_id: r for r in minhash.op3(spark, write(spark, tmp_path, rows)).collect()}
    order = sorted(rows)
    assert len(got) == len(rows)
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        t, nxt = t or "", nxt or ""
        cut = len(t) // 4
        edited = t[:len(t) - cut] + nxt[:cut]
        r = got[i]
        assert r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == fingerprint(t), i
        assert r.edited_fingerprint == fingerprint(edited)
        assert r.near_edited == pytest.approx(alike(fingerprint(t), fingerprint(edited)))
        assert r.near_next == pytest.approx(alike(fingerprint(t), fingerprint(nxt)))


def test_likeness_estimates_the_share_of_common_shingles(spark):
    r = random.Random(5)
    rows, want = [], []
    for n, keep in itertools.product((300, 1000), (0.2, 0.5, 0.8, 0.95)):
        for _ in range(6):
            a = [str(r.random()) for _ in range(n)]
            b = a[:int(n * keep)] + [str(r.random()) for _ in range(n - int(n * keep))]
            s, t = ({tuple(x[i:i + 5]) for i in range(n - 4)} for x in (a, b))
            rows.append((" ".join(a), " ".join(b)))
            want.append(len(s & t) / len(s | t))
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(rows)], "i int, a string, b string")
    got = [x.v for x in df.select("i", minhash.likeness(minhash.fingerprint(F.col("a")), minhash.fingerprint(F.col("b"))).alias("v"))
           .orderBy("i").collect()]
    assert max(abs(g - w) for g, w in zip(got, want)) < 0.12
    assert abs(sum(got) - sum(want)) / len(want) < 0.02            # no bias


def test_fingerprints_of_awkward_tables(spark):
    df = spark.createDataFrame([(None, "a b"), (None, None), (1, "a b"), (1, "a b"), (1, "c")], "doc_id long, text string")
    out = minhash.fingerprint_pairs(df).collect()
    assert len(out) == 5
    assert len({tuple(r.fp) for r in out if r.n_chars == 3}) == 1
    assert minhash.fingerprint_pairs(df.where("false")).count() == 0
    one = minhash.fingerprint_pairs(df.where("text = 'c'")).collect()
    assert [(r.near_next, r.edited) for r in one] == [(1.0, "c")]


def best_capacity(sizes, shards):
    lo, hi = max(sizes), sum(sizes)
    while lo < hi:
        mid, n, have = (lo + hi) // 2, 1, 0
        for s in sizes:
            if have + s > mid:
                n, have = n + 1, 0
            have += s
        lo, hi = (lo, mid) if n <= shards else (mid + 1, hi)
    return lo


@pytest.mark.parametrize("points", [4096, 3])
@pytest.mark.parametrize("hot", [0, 200])
def test_shards_reach_the_least_capacity(spark, tmp_path, monkeypatch, points, hot):
    monkeypatch.setattr(sharding, "POINTS", points)
    monkeypatch.setattr(sharding, "SALT_ROWS", 50)
    rows = list(enumerate(texts(2, 250) + ["hot text " * 30] * hot))
    got = sharding.op6(spark, write(spark, tmp_path, rows)).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(rows)))
    of = dict(rows)
    size, where = {}, {}
    for r in got:
        b = (of[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(b) + 1, zlib.crc32(b), "bytes", None)
        size[r.shard] = size.get(r.shard, 0) + r.size
        assert where.setdefault(b, r.shard) == r.shard             # copies stay together
    for s in size:
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    whole = {}
    for _, t in rows:
        h = hashlib.sha256((t or "").encode()).digest()
        whole[h] = whole.get(h, 0) + len((t or "").encode()) + 1
    assert max(size.values()) == best_capacity([whole[h] for h in sorted(whole)], 8)


def test_shards_of_awkward_tables(spark):
    df = spark.createDataFrame([(None, "a"), (None, None), (1, ""), (1, ""), (2, "bb")], "doc_id long, text string")
    out = sharding.shard(df).collect()
    assert len(out) == 5
    assert sharding.shard(df.where("false")).count() == 0
    assert sorted((r.shard, r.slot) for r in out) == sorted(set((r.shard, r.slot) for r in out))


def test_no_python_on_the_main_path(spark, tmp_path):
    d = write(spark, tmp_path, list(enumerate(texts(3, 10))))
    for op in (minhash.op3, sharding.op6):
        plan = op(spark, d)._jdf.queryExecution().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
