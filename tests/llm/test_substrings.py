"""Both substring operators against brute force on small, awkward tables."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from kinrank.llm import substring_dedup, suffix_dedup

SCHEMA = "doc_id long, text string, n_bytes string, _k int"


def corpus(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 7)))
    say = lambda n: " ".join(word() for _ in range(n))
    shared = [say(60), say(36), say(200)]
    rows = [None, "", "x", "a " * 400, "ab" * 300, "a" * 99, "a" * 100, "a" * 101, "same " * 36, "\n\t  ", "é" * 120]
    for _ in range(40):
        parts = [say(r.randint(1, 50))]
        for _ in range(r.randint(0, 2)):
            s = r.choice(shared)
            i = r.randint(0, 40)
            parts += [s[i:], say(r.randint(0, 20))]
        rows.append(r.choice([" ", "  ", "\n"]).join(parts))
    rows += [rows[20], rows[20], rows[25], rows[25] + " x", "y " + rows[25], "p q r " * 50, "q r p " * 50]
    ids = r.sample(range(-50, 500), len(rows))
    return list(zip(ids, rows))


def brute_bytes(rows, width=100):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda x: x[0]):
        b = (t or "").encode()
        hit = bytearray(len(b))
        for s in range(len(b) - width + 1):
            w = b[s:s + width]
            if w in seen:
                hit[s:s + width] = b"\1" * width
            seen.add(w)
        runs = len([1 for j in range(len(b)) if hit[j] and (j == 0 or not hit[j - 1])])
        kept = bytes(x for x, h in zip(b, hit) if not h)
        out[i] = (len(b), sum(hit), runs, hashlib.sha256(kept).hexdigest())
    return out


def brute_words(rows, width=35):
    places = {}
    docs = {i: [w.decode() for w in (t or "").encode().split()] for i, t in rows}
    for i, w in docs.items():
        for s in range(len(w) - width + 1):
            places.setdefault(tuple(w[s:s + width]), []).append((i, s))
    hit = {i: [0] * len(w) for i, w in docs.items()}
    for p in places.values():
        if len(p) > 1:
            for i, s in p:
                hit[i][s:s + width] = [1] * width
    return {i: (len(w), sum(hit[i]), hashlib.sha256(" ".join(x for x, h in zip(w, hit[i]) if not h).encode()).hexdigest())
            for i, w in docs.items()}


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("parts", [1, 7])
def test_bytes_match_brute_force(spark, tmp_path, seed, parts):
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, "clash", 5) for i, t in rows], SCHEMA).repartition(parts)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.op1(spark, str(tmp_path)).collect()}
    assert got == brute_bytes(rows)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("parts", [1, 7])
def test_words_match_brute_force(spark, tmp_path, seed, parts):
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, "clash", 5) for i, t in rows], SCHEMA).repartition(parts)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.op10(spark, str(tmp_path)).collect()}
    assert got == brute_words(rows)


def test_periodic_texts_agree_with_brute_force(spark, tmp_path):
    rows = [(n, ("u v " * 100).strip()[: 2 * n]) for n in range(60, 100)] + [(n, "z " * (n - 70)) for n in range(104, 112)]
    spark.createDataFrame([(i, t, "c", 1) for i, t in rows], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.op10(spark, str(tmp_path)).collect()}
    assert got == brute_words(rows)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.op1(spark, str(tmp_path)).collect()}
    assert got == brute_bytes(rows)


def test_null_and_repeated_ids_and_empty_table(spark):
    long = " ".join(f"w{i}" for i in range(80))
    df = spark.createDataFrame([(None, long), (None, "other"), (3, long), (3, long), (3, "z " + long)], "doc_id long, text string")
    for op in (suffix_dedup.remove_repeated_strings, substring_dedup.remove_repeated_passages):
        out = op(df, carry=("text",)).collect()
        assert len(out) == 5
        same = [r for r in out if r.doc_id == 3 and r.carried.text == long]
        assert same[0].kept == same[1].kept
        assert op(df.where("false")).count() == 0
    lost = {(r.doc_id, r.carried.text): bool(r.removed) for r in suffix_dedup.remove_repeated_strings(df, carry=("text",)).collect()}
    assert lost[(None, long)] and not lost[(None, "other")]


def test_a_row_repeated_over_batches_keeps_its_text(spark, monkeypatch):
    sized = suffix_dedup.arrow_sized
    monkeypatch.setattr(suffix_dedup, "arrow_sized", lambda df: sized(df, 1))
    long = " ".join(f"w{i}" for i in range(120))
    part = "before it " + long[50:400] + " and an end"
    rows = [(3, long), (5, part), (3, long), (7, long), (3, long), (5, part), (7, long), (3, long)]
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, len(rows)), "doc_id long, text string")
    out = suffix_dedup.remove_repeated_strings(df).collect()
    assert sorted((r.doc_id, bytes(r.kept).decode()) for r in out) == sorted(
        [(3, long)] * 4 + [(5, "before it and an end")] * 2 + [(7, "")] * 2)


def test_the_cover_is_a_perfect_difference_set():
    d = {(a - b) % substring_dedup.PERIOD for a in substring_dedup.COVER for b in substring_dedup.COVER}
    assert d == set(range(substring_dedup.PERIOD))
    assert substring_dedup.PERIOD - 1 + substring_dedup.CORE == substring_dedup.WIDTH


def test_batches_settle_before_the_shuffle(spark):
    text = " ".join(f"w{i}" for i in range(300))
    df = spark.createDataFrame([(i, text) for i in range(500)], "doc_id long, text string").coalesce(1)
    out = substring_dedup.remove_repeated_passages(df)
    assert out.where(F.length("kept") > 0).count() == 0
