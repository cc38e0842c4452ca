"""Conversation repair, ranked search and byte-level BPE, each against a plain version."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash

from kinrank.llm import bpe, conversations, lexical, oracle

BLANKS = " \t\n\x0b\x0c\r"


def plain_repair(symbols):
    """(cost, audit) by the plain recurrence over rows, whole audits kept."""
    step = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}

    def better(table, state, value):
        if state not in table or value < table[state]:
            table[state] = value

    def insertions(table):
        for _ in range(4):
            for q, (cost, audit) in list(table.items()):
                for who, to in step[q].items():
                    if who != "s":
                        better(table, to, (cost + 3, audit + "I"))
        return table

    now = insertions({0: (0, "")})
    for s in symbols:
        fault, own = divmod(s, 4)
        new = {}
        for q, (cost, audit) in now.items():
            better(new, q, (cost + 4, audit + "D"))
            if fault < 2:
                for who, to in step[q].items():
                    if who == "sua?"[own]:
                        better(new, to, (cost + 3 * fault, audit + "K"))
                    if who != "s":
                        better(new, to, (cost + 3 * fault + 3, audit + "R"))
        now = insertions(new)
    return min(now[q] for q in (0, 3) if q in now)


def tie(role, text):
    """Spark's xxhash64(role, text), which orders rows of one turn and role."""
    h = xxhash.xxh64_intdigest(text.encode(), xxhash.xxh64_intdigest(role.encode(), 42))
    return h - (1 << 64) if h >> 63 else h


def plain_conversations(rows):
    told = defaultdict(list)
    text_of = lambda x: " " if x is None else str(x)
    for c, t, role, text in rows:
        h, own = zlib.crc32(f"{text_of(c)}:{text_of(t)}".encode()) % 20, told[c]
        role, text = text_of(role), text_of(text)
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        own += [(t, "user" if h == 4 else role, text)] * {0: 0, 3: 2}.get(h, 1)
    out = {}
    for c, own in told.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], tie(r[1], r[2])))
        seen, symbols, count = set(), [], Counter()
        for _, role, text in own:
            end = text.rstrip(BLANKS)[-1:]
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else ""
            count[fault] += 1
            seen.add((role, text))
            symbols.append(4 * {"": 0, "truncated": 1}.get(fault, 2) + {"s": 0, "u": 1, "a": 2}.get(role[:1], 3))
        who, turns = [r[1][:1] for r in own], [r[0] for r in own if r[0] is not None]
        cost, audit = plain_repair(symbols)
        left, at = [], iter(own)
        for letter in audit:
            row = None if letter == "I" else next(at)
            if letter != "D":
                left.append((row[1] if letter == "K" else None, row[2] if row else ""))
        roles = ["system"] * (len(left) % 2) + ["user", "assistant"] * (len(left) // 2)
        said = "\n".join((role or r) + ":" + text for (role, text), r in zip(left, roles))
        out[c] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, count["blank"], count["duplicate"], count["truncated"],
                  sum(a + b not in ("su", "ua", "au") for a, b in zip(who, who[1:])), cost, audit, hashlib.sha256(said.encode()).hexdigest())
    return out


@pytest.mark.parametrize("seed", range(4))
def test_cheapest_edits_and_first_audit(seed):
    r = random.Random(seed)
    for _ in range(1500):
        s = bytes(r.choice([0, 1, 2, 1, 2, 1, 2, 3, 5, 6, 9, 10, 11, 4, 7]) for _ in range(r.randint(0, 14)))
        assert conversations.repair(s) == plain_repair(s), list(s)
    s = bytes(r.choice([1, 2, 1, 2, 5, 6, 9]) for _ in range(3000))
    assert conversations.repair(s) == plain_repair(s)


CHAT = "conv_id long, turn long, role string, text string, audit string, _c string"


def chat_rows(seed, n=900):
    r = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]
    texts = ["Hello.", "Hello.", "yes", "No!", "", " \n\t", None, "what?  ", "a" * 3000 + ".", "été…", "line\nbreak.", ".  ", "x.\x1c"]
    rows = {}
    for _ in range(n):                                     # one row for each (turn, role): their order is told
        c, t, role = r.choice([*range(60), None]), r.choice([*range(12), None, -5, 90]), r.choice(roles)
        rows[c, t, role] = (c, t, role, r.choice(texts), "clash", "clash")
    return list(rows.values())


@pytest.mark.parametrize("seed", range(2))
def test_conversations_equal_the_plain_version(spark, seed):
    rows = chat_rows(seed) + [(7, 7, "user", "again.", "c", "c")] * 5
    df = spark.createDataFrame(rows, CHAT).repartition(5)
    got = conversations.repair_conversations(conversations.damage(df)).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == plain_conversations([x[:4] for x in rows])
    assert len(got) == len({x[0] for x in rows})


def test_registered_conversations(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {r.conv_id: tuple(r)[1:] for r in conversations.op11(spark, sf).collect()} == plain_conversations(rows)


def test_awkward_conversations(spark):
    df = spark.createDataFrame([], CHAT)
    assert conversations.repair_conversations(conversations.damage(df)).count() == 0
    dropped = next(t for t in range(999) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(1, dropped, "user", "gone.", "", "")], CHAT)
    row = conversations.repair_conversations(conversations.damage(df)).first()
    assert tuple(row) == (1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    long = [(5, t, ("user", "assistant")[t % 2], f"turn {t // 3}.", "", "") for t in range(4000)]      # one conversation, whole
    got = conversations.repair_conversations(conversations.damage(spark.createDataFrame(long, CHAT))).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == plain_conversations([x[:4] for x in long])


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_ranking(docs, items, k):
    words = [Counter(plain_terms(t)) for _, t in docs]
    n = [sum(w.values()) for w in words]
    texts, total = sum(x > 0 for x in n), sum(n)
    df = Counter(x for w in words for x in w)
    out = []
    for item, text in items:
        scores = []
        for (doc, _), w, size in zip(docs, words, n):
            score = 0
            for x in set(plain_terms(text)) & set(w):
                m = 100 - 50 + (50 * size * texts) // total
                score += math.floor(1000 * math.log((2 * texts + 2) / (2 * df[x] + 1))) * ((1000000000 * w[x]) // (1000 * w[x] + 20 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:k])]
    return out


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


DOCS, ITEMS = "doc_id long, text string, score string, n long", "item_id string, text string, rank int"


@pytest.mark.parametrize("seed", range(2))
def test_ranking_equals_the_plain_version(spark, seed, monkeypatch):
    monkeypatch.setattr(lexical, "INDEX_ROWS", 40)
    monkeypatch.setattr(lexical, "STRETCH", 2)
    r = random.Random(seed)
    words = [f"w{i}" for i in range(30)] + ["É", "É", "Ab-c", "x_y", "ab", "日本", "the", "the", "the"]
    text = lambda most: r.choice([None, "", "... !", "solo"]) if r.random() < 0.1 else " ".join(r.choice(words) for _ in range(r.randint(1, most)))
    docs = [(i, text(60)) for i in range(400)] + [(3, "w1 w2 the")] * 9 + [(None, "w1 w2")] * 2 + [(1000, "w3 " * 30000)]
    items = [(f"i{i % 18}", text(90)) for i in range(20)] + [(None, "w1 ab"), ("none", "absent words")]
    found = lexical.rank(spark.createDataFrame([(i, t, "c", 1) for i, t in docs], DOCS).repartition(4),
                         spark.createDataFrame([(i, t, 1) for i, t in items], ITEMS), k=7, block=300 if seed else 1 << 20)
    assert rows_of(found) == sorted(plain_ranking(docs, items, 7), key=str)


def test_reading_stops_with_final_scores(monkeypatch):
    monkeypatch.setattr(lexical, "STRETCH", 4)
    r = np.random.default_rng(5)
    n = 3000
    doc, term = np.divmod(np.unique(r.integers(0, n * 90, 40000)), 90)
    tf = r.integers(1, 40, len(doc))
    weight = r.integers(0, 4000, 90)
    size = r.integers(1, 900, n)
    index = lexical.Index(size, doc, term, tf, weight, n, int(size.sum()))
    for _ in range(60):
        own = sorted(set(r.integers(0, 90, r.integers(1, 80)).tolist()))
        scores = np.zeros(n, np.int64)
        for t in own:
            a, b = index.start[t], index.start[t + 1]
            scores[index.doc[a:b]] += index.impact[a:b]
        bar = int(r.choice([0, int(np.sort(scores)[-3])]))
        met, got = index.search(own, 11, bar)
        least = max(bar, 1, int(np.sort(scores)[-11]))
        assert sorted(met.tolist()) == np.flatnonzero(scores >= least).tolist()
        assert got.tolist() == scores[met].tolist()


def test_ranking_of_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b", "", 1)], DOCS), spark.createDataFrame([("i", "a", 1)], ITEMS)
    assert lexical.rank(docs.where("false"), items).count() == 0
    assert lexical.rank(docs, items.where("false")).count() == 0
    assert lexical.rank(docs, items).count() == 1


def test_registered_ranking_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    found = lexical.op12(spark, sf)
    res = con.execute(oracle.oracle_sql()["op12_ranked_lexical_search"])
    assert found.columns == [d[0] for d in res.description]
    assert rows_of(found) == sorted(res.fetchall(), key=str)


PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def bpe_texts(seed, n):
    r = random.Random(seed)
    parts = ["a", "b", "the", "ing", " ", "  ", "\n", "é", "日本", "\U0001f600", "'s", "1", "22", "!", "?!", "-", "=", "\t", "ation", "zz",
             "<|endoftext|>", "\x00", "ß", "İ", " ", "…"]
    return (["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(n)]
            + ["".join(r.choice("abcdefghilmnoprstuy") for _ in range(r.randint(1, 60))) for _ in range(n)])


def test_merges_are_reproduced(library):
    own = bpe.tokenizer(PATH, public_tokenizers.PATTERN)
    for t in bpe_texts(1, 3000) + ["a" * 501, " " * 1000, "=" * 777, "the" * 300, "-" * 300 + "=" * 50, "  \n" * 50, "é" * 200, "日" * 99]:
        ids = own.encode(t)
        assert ids.tolist() == library.encode_ordinary(t), t
        assert own.decode(ids) == t.encode()


def test_a_small_vocabulary_with_tokens_that_no_merge_forms():
    ranks = {bytes([b]): i for i, b in enumerate(b"abc")} | {b"ab": 3, b"bc": 4, b"abc": 5, b"cab": 6, b"bcb": 9, b"aa": 7, b"aaaa": 8, b"abcabc": 10}
    own = bpe.Bpe(ranks, r"[a-c]+")
    ref = tiktoken.Encoding("small", pat_str=r"[a-c]+", mergeable_ranks=ranks, special_tokens={})
    r = random.Random(4)
    for _ in range(4000):
        t = "".join(r.choice("abc") for _ in range(r.randint(1, 25)))
        assert own.encode(t).tolist() == ref.encode_ordinary(t), t


def test_long_pieces_take_linear_time():
    import time

    own = bpe.tokenizer(PATH, public_tokenizers.PATTERN)
    for t in ("ab" * 200_000, "x" + " " * 300_000 + "y", "a" * 400_000, "word " * 400_000):
        start = time.process_time()
        ids = own.encode(t)
        assert own.decode(ids) == t.encode() and time.process_time() - start < 20


def test_documents_are_encoded_and_decoded(spark, library, tmp_path):
    texts = [None, "", " ", "x y " * 3000] + bpe_texts(2, 100)
    rows = [(i if i % 9 else None, t, "ids", "decoded") for i, t in enumerate(texts)] + [(5, "twice", "", "")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded string").repartition(3)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in bpe.op13(spark, str(tmp_path)).collect()), key=str)
    want = []
    for i, t, _, _ in rows:
        ids = np.array(library.encode_ordinary(t or ""), "<u4")
        want.append((i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    coded = bpe.encode_documents(df, PATH, public_tokenizers.PATTERN, carry=("ids", "text"))
    assert coded.where("carried.ids = 'ids'").count() == len(texts)
    assert bpe.decode_documents(bpe.encode_documents(df.where("false"), PATH, public_tokenizers.PATTERN), PATH, public_tokenizers.PATTERN).count() == 0
