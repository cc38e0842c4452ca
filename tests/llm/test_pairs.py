"""SimHash components and benchmark decontamination against plain Python."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from kinrank.llm import decontaminate, simhash

SCHEMA = "doc_id long, text string, fp string, matches int"


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def plain_fingerprint(t):
    w = re.findall("[^\x20\x09-\x0D]+", lower(t))
    runs = [" ".join(w)] if 0 < len(w) < 3 else [" ".join(w[i:i + 3]) for i in range(len(w) - 2)]
    h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps, bits=2):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def corpus(seed):
    r = random.Random(seed)
    say = lambda n: [r.choice(["Red", "fox", "ÉTÉ", "it", "runs", "so", "42", "x" * r.randint(1, 4)]) for _ in range(n)]
    rows = [None, "", " \n", "one", "One two", "a b c", "A B C", "x " * 3000]
    for _ in range(60):
        w = say(r.randint(3, 300))
        rows.append(" ".join(w))
        for _ in range(r.randint(0, 4)):
            v = list(w)
            v[r.randrange(len(v))] = "edit"
            rows.append("  ".join(v))
    return rows + rows[-5:]


@pytest.mark.parametrize("leaf", [simhash.LEAF, 5])
def test_components_match_all_pairs(spark, tmp_path, leaf):
    rows = corpus(3)
    ids = random.Random(4).sample(range(-99, 9999), len(rows))
    order = sorted(zip(ids, rows))
    spark.createDataFrame([(i, t, "clash", 1) for i, t in order], SCHEMA).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    fps = [plain_fingerprint(t) for _, t in order]
    want = {order[i][0]: ("%016x" % fps[i], order[c][0]) for i, c in enumerate(plain_components(fps))}
    if leaf == simhash.LEAF:
        got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op4(spark, str(tmp_path)).collect()}
    else:
        out = simhash.near_duplicates(spark.read.parquet(f"{tmp_path}/documents.parquet"), leaf=leaf).collect()
        got = {r.doc_id: ("%016x" % (r.fp & (1 << 64) - 1), r.component_id) for r in out}
    assert got == want
    assert len({c for _, c in want.values()}) < len(want) - 20


@pytest.mark.parametrize("seed", range(4))
def test_walk_finds_every_pair(seed):
    r = np.random.default_rng(seed)
    base = r.integers(0, 2**64, 30, dtype=np.uint64)
    flip = np.uint64(1) << r.integers(0, 64, (300, 4)).astype(np.uint64)
    a = np.unique(np.concatenate([base, base[r.integers(0, 30, 300)] ^ flip[:, 0] ^ flip[:, 1] ^ (flip[:, 2] * np.uint64(seed % 2))]))
    x, y = simhash.walk(a, a, 0)
    want = {(i, j) for i in range(len(a)) for j in range(len(a)) if bin(int(a[i] ^ a[j])).count("1") <= 2}
    assert set(zip(x.tolist(), y.tolist())) == want and len(x) == len(want)


def test_crowded_corners_and_long_chains(spark):
    r = np.random.default_rng(1)
    tight = np.uint64(0xABCD) + (np.arange(700, dtype=np.uint64) << np.uint64(40))
    chain = [np.uint64(0xFFFF << 40)]
    for b in range(0, 40):
        chain.append(chain[-1] ^ np.uint64(1 << b))
    points = np.unique(np.concatenate([tight, np.array(chain), r.integers(0, 2**64, 300, dtype=np.uint64)]))
    df = spark.createDataFrame([(int(x),) for x in points.view(np.int64)], "fp long")
    found = {(q.node, q.root) for q in simhash.components(simhash.links(df, leaf=64)).collect()}
    label = plain_components([int(x) for x in points])
    groups, mine = {}, {}
    for x, c in zip(points.view(np.int64).tolist(), label):
        groups.setdefault(c, set()).add(x)
    roots = dict(found)
    for x in points.view(np.int64).tolist():
        mine.setdefault(roots.get(x, x), set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_near_duplicates_of_awkward_tables(spark):
    df = spark.createDataFrame([(None, "a b c d"), (None, ""), (4, "a b c d"), (4, "a b c d"), (9, None)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id) for r in simhash.near_duplicates(df).collect())
    assert got == [(0, 4), (0, 9), (4, 4), (4, 4), (9, 9)]
    assert simhash.near_duplicates(df.where("false")).count() == 0
    alone = simhash.near_duplicates(df.where("doc_id is null")).collect()
    assert [r.component_id for r in alone] == [None, None]


def plain_contamination(docs, items, window=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    out = {}
    for i, t in docs:
        w, hit, names = words(t), set(), set()
        for name, s in items:
            v = words(s)
            for j in range(max(1, len(v) - window + 1)) if v else ():
                x = v[j:j + window]
                for p in range(len(w) - len(x) + 1):
                    if w[p:p + len(x)] == x:
                        hit.update(range(p, p + len(x)))
                        names.add("" if name is None else str(name))
        out[i] = (len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit))
    return out


@pytest.mark.parametrize("size", [1 << 23, 300])
def test_contamination_matches_plain_search(spark, tmp_path, monkeypatch, size):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", size)
    monkeypatch.setattr(decontaminate.blocks, "__defaults__", (decontaminate.WINDOW, size))
    r = random.Random(7)
    say = lambda n: [r.choice(["Alpha", "beta", "Ünï", "x1", "go", "to", "漢字"]) for _ in range(n)]
    items = [(k, " ".join(say(n))) for k, n in enumerate([25, 12, 10, 9, 3, 40, 11, 0, 10])]
    items += [(20, None), (21, "..."), (22, items[0][1]), (None, "solitary"), (23, items[5][1][20:])]
    docs = [(0, None), (1, ""), (2, "?!"), (3, "Solitary!"), (4, "go " * 3000)]
    for i in range(5, 60):
        parts = say(r.randint(0, 60))
        for _ in range(r.randint(0, 2)):
            v = (r.choice(items)[1] or "").upper().split()
            parts += v[r.randint(0, 5):] + say(3)
        docs.append((i, r.choice([" ", ", ", "\n--"]).join(parts)))
    spark.createDataFrame([(i, t, "clash", 1) for i, t in docs], SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, t, 1) for k, t in items], "item_id long, text string, doc_id int").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = decontaminate.op2(spark, str(tmp_path)).collect()
    got = {q.doc_id: (q.n_words, q.n_hit, q.n_items, q.items_sha256, q.contaminated) for q in out}
    assert got == plain_contamination(docs, items)
    assert sum(x[4] for x in got.values()) > 10


def test_longest_matches_and_awkward_tables(spark):
    item = " ".join(f"w{i}" for i in range(30))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = spark.createDataFrame([(None, f"a b {item} c"), (2, " ".join(item.split()[4:17])), (2, "w1 w2"), (2, "w1 w2")],
                                 "doc_id long, text string")
    out = decontaminate.find_contamination(docs, bench, carry=("text",)).collect()
    found = sorted([(m.item_id, m.item_start, m.doc_start, m.n_words) for q in out for m in q.matches])
    assert found == [("1", 0, 2, 30), ("1", 4, 0, 13)]
    assert decontaminate.find_contamination(docs.where("false"), bench).count() == 0
    none = decontaminate.find_contamination(docs, bench.where("false"))
    assert none.where("contaminated").count() == 0 and none.count() == 4
    assert none.agg(F.sum("n_words")).first()[0] == 33 + 13 + 4


def alignments(doc, items, window):
    """Words hit and maximal runs of every alignment, by comparing word for word."""
    hit, runs = set(), set()
    for name, own in items:
        least = min(window, len(own))
        for d in range(-len(own), len(doc) + 1) if own else ():
            first = None
            for i in range(len(own) + 1):
                same = i < len(own) and 0 <= d + i < len(doc) and doc[d + i] == own[i]
                if same and first is None:
                    first = i
                elif not same and first is not None:
                    if i - first >= least:
                        runs.add((name, first, d + first, i - first))
                        hit |= set(range(d + first, d + i))
                    first = None
    return len(hit), runs


def test_matches_are_the_runs_of_every_alignment():
    r = random.Random(2)
    for _ in range(400):
        text = lambda n: [r.choice("abcx"[:r.randint(1, 4)]) for _ in range(n)]
        items = [(f"i{j}", text(r.choice([0, 1, 2, 3, 4, 6, 9, 12]))) for j in range(3)]
        docs = [text(r.randint(0, 25)) for _ in range(3)]
        _, hits, matches = decontaminate.Suffixes([(k, " ".join(v).encode()) for k, v in items], 3).search([" ".join(d).encode() for d in docs])
        for d, h, m in zip(docs, hits, matches):
            want_h, want = alignments(d, items, 3)
            got = [(x["item_id"], x["item_start"], x["doc_start"], x["n_words"]) for x in m]
            assert h == want_h and set(got) == want and len(got) == len(want)


def test_texts_that_repeat_themselves_take_little_memory():
    import tracemalloc

    suffixes = decontaminate.Suffixes([("i", b"word " * 20_000)])
    tracemalloc.start()
    _, hits, matches = suffixes.search([b"word " * 20_000])
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert hits == [20_000] and len(matches[0]) < 40_000 and most < 1 << 28


def test_blocks_of_the_benchmark_and_clean_rows(spark):
    docs = spark.createDataFrame([(i, f"start {i} " + " ".join(f"w{j}" for j in range(i, i + 14)), "c") for i in range(0, 60, 3)]
                                 + [(None, None, "c"), (5, "", "c"), (5, "w3 " * 3000, "c")], "doc_id long, text string, matches string")
    bench = spark.createDataFrame([(f"i{k}", " ".join(f"w{j}" for j in range(k * 5, k * 5 + 11))) for k in range(9)] + [(None, None)],
                                  "item_id string, text string")
    one = decontaminate.find_contamination(docs, bench, carry=("matches",))
    many = decontaminate.find_contamination(docs, bench, carry=("matches",), size=200)
    key = lambda r: (str(r.doc_id), r.n_words, r.n_hit, sorted(map(tuple, r.matches)))
    assert sorted(map(key, one.collect())) == sorted(map(key, many.collect())) and one.where("contaminated").count() > 0
    clean = decontaminate.find_contamination(docs, bench, carry=("doc_id", "text"), clean_only=True)
    assert clean.count() == one.where("not contaminated").count()


def test_node_pairs_have_no_nested_loop(spark):
    r = np.random.default_rng(4)
    fps = spark.createDataFrame([(int(x),) for x in r.integers(-2**63, 2**63 - 1, 3000)], "fp long")
    at = simhash.leaves(fps, 20)
    nodes = at.select("node", "depth").distinct().cache()
    seen = []
    keep = simhash.materialize
    simhash.materialize = lambda df: seen.append(df._jdf.queryExecution().executedPlan().toString()) or keep(df)
    try:
        pairs = [tuple(x) for x in simhash.node_pairs(nodes).collect()]
    finally:
        simhash.materialize = keep
    assert seen and not any("NestedLoop" in p or "CartesianProduct" in p for p in seen)
    own = [tuple(x) for x in nodes.collect()]
    near = lambda a, da, b, db: bin(((a ^ b) & (2**64 - 1)) >> (64 - min(da, db))).count("1") <= 2 if min(da, db) else True
    want = {(a, da, b, db) for a, da in own for b, db in own if a <= b and near(a, da, b, db)}
    assert set(pairs) == want
