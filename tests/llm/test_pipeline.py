"""The pipeline against a plain version of its stages, and on awkward tables."""

import random
import re
from collections import Counter

import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from kinrank.llm import packing, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, carried string, matches string, fp long"


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain_fingerprint(text):
    w = words(lowered(text))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_representatives(docs):
    """One row for each group of linked fingerprints: the least doc_id."""
    fps = [plain_fingerprint(t) for _, t in docs]
    group = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 2:
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    return [min(d for d, g in zip(docs, group) if g == k) for k in sorted(set(group))]


def plain_passages(docs):
    met = Counter(tuple(w[i:i + 35]) for w in (words(t) for _, t in docs) for i in range(len(w) - 34))
    out = []
    for d, t in docs:
        w = words(t)
        gone = {i + k for i in range(len(w) - 34) if met[tuple(w[i:i + 35])] > 1 for k in range(35)}
        out.append((d, " ".join(x for i, x in enumerate(w) if i not in gone) if gone else t or ""))
    return out


def plain_clean(docs, items):
    tokens = lambda t: re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(t))
    windows = set()
    for t in items:
        w = tokens(t)
        windows |= {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(w) for w in windows}
    return [(d, t) for d, t in docs if not any(tuple(w[i:i + n]) in windows for w in [tokens(t)] for n in sizes for i in range(len(w) - n + 1))]


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(6)
    vocabulary = ["".join(r.choice("abcdefghiklmnoprstuw") for _ in range(r.randint(2, 8))) for _ in range(400)]
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    passage, item, short = text(50), text(14), "Only Seven words, in this item here"
    docs = [(i, text(r.randint(60, 160))) for i in range(0, 80, 2)]
    docs += [(101 + i, docs[i][1]) for i in range(5)] + [(120, docs[9][1] + " also"), (121, docs[9][1].upper())]
    docs += [(130 + i, f"{text(20)} {passage} {text(20)}") for i in range(3)]
    docs += [(140, f"{text(30)} {item} {text(3)}"), (141, f"{text(9)} only seven  WORDS in this item, here? {text(30)}")]
    docs += [(150 + i, f"{text(12)} you horrible moron, you stupid idiot {text(12)}") for i in range(16)]
    docs += [(170, None), (171, ""), (172, " \n "), (173, text(3000))]
    labels = [(d, 1, int("moron" in (t or ""))) for d, t in docs]
    return docs, labels, [("a", item), ("b", short), (None, None), ("e", "")]


def write(spark, folder, docs, labels, items):
    spark.createDataFrame([(d, t, "en", "s", len(t or ""), "x", "y", "z", 7) for d, t in docs], SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_stages_equal_their_plain_versions(spark, tmp_path, corpus):
    docs, labels, items = corpus
    sf = write(spark, tmp_path, docs, labels, items)
    at, given = spark.read.parquet(f"{sf}/documents.parquet"), [*docs]
    columns = at.columns
    model = toxicity.fit(at, spark.read.parquet(f"{sf}/labels.parquet"))
    scores = dict(zip([d for d, _ in docs], model.score([t or "" for _, t in docs], {})))
    wants = [lambda x: [(d, t) for d, t in x if scores[d] < toxicity.THRESHOLD], plain_representatives_of, plain_passages,
             lambda x: plain_clean(x, [t for _, t in items])]
    for (name, stage), want in zip(corpus_pipeline.STAGES, wants):
        out = stage(spark, at, sf)
        assert out.columns == columns, name
        out.write.parquet(f"{tmp_path}/{name}")
        at = spark.read.parquet(f"{tmp_path}/{name}")
        given = want(given)
        assert sorted((r.doc_id, r.text) for r in at.collect()) == sorted(given, key=lambda x: x[0]), name
        assert at.where("score = 'x' and carried = 'y' and matches = 'z' and fp = 7").count() == len(given)
    assert {170, 171, 172} & {d for d, _ in given} and 173 in {d for d, _ in given}
    tok = Tokenizer.from_file(packing.vocabulary())
    total = {d: len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for d, t in given}
    got = Counter()
    for r in corpus_pipeline.STAGES[-1][1](spark, at, sf).collect():
        got[r.doc_id] += r.length
    assert got == Counter(total)


def plain_representatives_of(docs):
    keep = {d for d, _ in plain_representatives([(d, t or "") for d, t in docs])}
    return [(d, t) for d, t in docs if d in keep]


def test_empty_tables(spark, tmp_path):
    sf = write(spark, tmp_path, [], [], [])
    assert corpus_pipeline.run(spark, sf).count() == 0


def test_unlabelled_documents_all_stay(spark, tmp_path, corpus):
    docs, _, _ = corpus
    sf = write(spark, tmp_path, docs, [], [])
    at = spark.read.parquet(f"{sf}/documents.parquet")
    assert corpus_pipeline.drop_toxic(spark, at, sf).count() == len(docs)
