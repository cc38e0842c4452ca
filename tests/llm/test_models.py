"""Packing, token files, page text, toxicity and the pipeline."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from kinrank.llm import html_extract, packing, token_store, toxicity
from kinrank.llm.common import lowest
from kinrank.llm.tokens import encoder

TINY = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string"


def odd_texts(seed, n=150):
    r = random.Random(seed)
    parts = ["a", "Word", "été", " ", "  ", "\n", "\t", " ", "　", "'s", "1", "23", "!", "?!", "<|endoftext|>", "İ",
             "日本", "\U0001f600", "\x1c", "\x85", "don't", "é"]
    return [None, "", " ", "x y " * 3000] + ["".join(r.choice(parts) for _ in range(r.randint(0, 60))) for _ in range(n)]


def fresh(name="word_bpe_49k.json"):
    """The tokenizer as its file has it."""
    return Tokenizer.from_file(packing.vocabulary(name))


def test_special_tokens_in_texts_are_the_librarys():
    enc = encoder(packing.vocabulary())
    texts = ["a <|endoftext|> b", "x<|startoftext|>", "plain words, here."]
    raw = [t.encode() for t in texts]
    ids, count = enc.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    assert count[0] == 3
    assert ids.tolist() == [i for t in texts for i in fresh().encode(t, add_special_tokens=False).ids]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_the_library(name, monkeypatch):
    enc, tok = encoder(packing.vocabulary(name)), fresh(name)
    texts = [t or "" for t in odd_texts(1, 3000)]
    raw = [t.encode() for t in texts]
    ids, count = enc.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    assert np.split(ids, np.cumsum(count)[:-1])[0].tolist() == tok.encode(texts[0], add_special_tokens=False).ids
    for t, part in zip(texts, np.split(ids, np.cumsum(count)[:-1])):
        assert part.tolist() == tok.encode(t, add_special_tokens=False).ids, t


def write(spark, tmp_path, rows):
    df = spark.createDataFrame([(i, t, "en", "s", 1, "clash") for i, t in rows], SCHEMA).repartition(3)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_packing_is_gapless_and_tight(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(packing, "SALT_ROWS", 20)
    rows = list(zip(random.Random(2).sample(range(-99, 999), 154), odd_texts(2)))
    got = packing.op5(spark, write(spark, tmp_path, rows)).collect()
    tok = fresh()
    want = set()
    total = 0
    for i, t in rows:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        total += len(ids)
        want |= {(i, p, s, len(ids[s:s + 2048]), zlib.crc32(ids[s:s + 2048].tobytes())) for p, s in enumerate(range(0, len(ids), 2048))}
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)
    seqs = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seqs.values():
        end = 0
        for o, n in sorted(parts):
            assert o == end
            end += n
        assert end <= 2048
    assert len(seqs) == -(-total // 2048)


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once(seed):
    r = random.Random(seed)
    counts = {r.randint(1, 64): r.randint(1, 40) for _ in range(r.randint(1, 60))}
    if seed == 5:
        counts = {40: 7, 33: 5}
    spans, ranks = {}, {}
    for n, rank, k, first, at in packing.plan(counts, 64):
        ranks.setdefault(n, []).append((rank, k))
        for i in range(k):
            spans.setdefault(first + i, []).append((at, n))
    for n, c in counts.items():
        end = 0
        for rank, k in sorted(ranks[n]):
            assert rank == end
            end += k
        assert end == c
    for parts in spans.values():
        end = 0
        for at, n in sorted(parts):
            assert at == end
            end += n
        assert end <= 64
    rooms = []                                                       # plain best fit, largest first
    for n in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        i = min((i for i, x in enumerate(rooms) if x >= n), key=lambda i: rooms[i], default=None)
        if i is None:
            rooms.append(64 - n)
        else:
            rooms[i] -= n
    assert len(spans) <= 1.01 * len(rooms) + 1


def test_packing_of_awkward_tables(spark):
    df = spark.createDataFrame([(None, "a"), (None, None), (1, "b"), (1, "b")], "doc_id long, text string")
    assert packing.pack_documents(df, packing.vocabulary()).count() == 4
    assert packing.pack_documents(df.where("false"), packing.vocabulary()).count() == 0


@pytest.mark.parametrize("top", [200, 60000, 2**32 - 1])
def test_codes_give_back_any_id(top):
    r = np.random.default_rng(top)
    ids = np.where(r.random(5000) < 0.5, r.integers(0, 200, 5000), r.integers(0, top + 1, 5000)).astype(np.uint32)
    image = token_store.Image(token_store.encode(ids, np.array([0, 0, 17, 1000, 5000])))
    assert image.all().tolist() == ids.tolist()
    places = r.integers(0, 5000, 3000)
    assert image.get(places).tolist() == ids[places].tolist()
    assert image.document(1).tolist() == ids[:17].tolist()
    empty = token_store.Image(token_store.encode(np.zeros(0, np.uint32), np.array([0])))
    assert empty.all().tolist() == [] and empty.get([]).tolist() == []


def test_token_files_read_back(spark, tmp_path):
    rows = list(zip(random.Random(3).sample(range(-99, 999), 154), odd_texts(3)))
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_store.op8(spark, write(spark, tmp_path, rows)).collect()}
    tok = fresh("byte_bpe_50k.json")
    want, start = {}, 0
    for i, t in sorted(rows, key=lambda x: x[0]):
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        want[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert got == want


def test_token_files_of_awkward_tables_and_lookup(spark):
    df = spark.createDataFrame([(None, "a b"), (5, None), (5, "b"), (5, "b"), (7, "one two three")], "doc_id long, text string")
    path = packing.vocabulary("byte_bpe_50k.json")
    folder = token_store.write_tokens(df, path)
    assert token_store.read_tokens(spark, folder).count() == 5
    want = fresh("byte_bpe_50k.json").encode("one two three", add_special_tokens=False).ids + [0]
    assert token_store.lookup(spark, folder, 7, [3, 0]) == [want[3], want[0]]
    empty = token_store.write_tokens(df.where("false"), path)
    assert token_store.read_tokens(spark, empty).count() == 0


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = toxicity.op9(spark, sf).join(labels, "doc_id").where("held_out").collect()
    pos, neg = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    wins = np.searchsorted(np.sort(neg), pos).mean() / len(neg)
    assert wins > 0.9
    assert np.mean([r.predicted for r in rows if r.toxic]) > 0.8
    assert np.mean([r.predicted for r in rows if not r.toxic]) < 0.05
    assert all(r.predicted == (r.score >= 0.3) for r in rows)


def test_toxicity_learns_from_few_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("toxic is not null")
    rows = toxicity.op9(spark, sf).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted for r in held if r.toxic]) > 0.5
    assert np.mean([r.predicted for r in held if not r.toxic]) < 0.25
    assert np.mean([r.predicted for r in rows if r.toxic and not r.held_out]) > 0.95


def test_a_word_of_one_document_teaches():
    texts = [f"plain{i} talk" for i in range(9)] + ["you dimwit"]
    model = toxicity.train(texts, [0] * 9 + [1])
    assert model.word("dimwit") > max(model.word(f"plain{i}") for i in range(9))


def test_toxicity_of_awkward_tables(spark):
    docs = spark.createDataFrame([(None, "x"), (1, None), (1, "you moron"), (2, "hello")] + [(i, f"nice {i % 9} day" if i % 2 else "you m0ron fool")
                                 for i in range(10, 60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 1 - i % 2, "c") for i in range(10, 60)] + [(None, 1, 1, "c"), (11, None, None, "c")],
                                   "doc_id long, quality int, toxic int, text string")
    model = toxicity.fit(docs, labels)
    out = {(r.doc_id, r.carried.text): r.score for r in toxicity.score(docs, model, carry=("text",)).collect()}
    assert out[(1, "you moron")] > 0.5 > out[(11, "nice 2 day")]
    assert toxicity.score(docs.where("false"), model).count() == 0
    assert 0 <= toxicity.score(docs, toxicity.fit(docs, labels.where("false"))).agg(F.max("score")).first()[0] <= 1


def test_only_labels_outside_the_held_out_fold_are_learned(spark):
    ids = spark.range(200).select(F.col("id").alias("doc_id"), toxicity.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in ids)


def plain_article(source):
    import html
    import re

    inner = source[source.index("<article>"):source.index("</article>")]
    blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inner)]
    return "\n".join(b for b in blocks if b)


def test_pages_of_the_table_and_of_other_make(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in html_extract.op7(spark, "/root/testdata/sf0.01").collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        assert got[r.page_id].text == plain_article(r.html)
        assert got[r.page_id].n_chars == len(got[r.page_id].text)
    model = html_extract.train([r.html for r in rows[:100]])
    odd = ('<body><div class="site-header">Site name</div><div class=layout><main><h1>Title of it</h1><p>First para &lt;b&gt; with words, and more. '
           'It goes on.<script>x="</p>"</script><div class="advertisement">Buy now. Really.</div><p>Second&nbsp;para: it is <i>he</i>re,<br>or not?'
           '<div class="share-buttons"><a href=x>Send</a></div></main><aside><p>Related text that is long. It is here too.</p></aside></div>'
           '<section id="comments"><p>I think this is great, thanks.</p></section><form>Mail <input></form><div class=footer>Copyright')
    df = spark.createDataFrame([(1, "u", odd, "c"), (1, None, None, "c"), (None, "u", "", "c"), (3, "v", "<p>", "c"), (4, "v", "<nav>Home</nav>", "c"),
                                (5, "w", "<p>" * 3000 + "deep", "c")], "page_id long, url string, html string, text string")
    out = {(r.page_id, r.url): r.text for r in html_extract.extract(df, model, carry=("text",)).collect()}
    assert out[(1, "u")] == "Title of it\nFirst para <b> with words, and more. It goes on.\nSecond para: it is here, or not?"
    assert out[(1, None)] == out[(None, "u")] == out[(3, "v")] == out[(4, "v")] == ""
    assert html_extract.extract(df.where("false"), model).count() == 0


def test_no_text_is_kept_under_a_dropped_node():
    page = html_extract.Page("<div><aside><p>good words</p></aside><p>more</p></div>")
    odds = np.array([9.0 if t == "#text" else -50.0 if t == "aside" else 1.0 for t in page.tag])
    assert page.decode(odds) == "more"


def test_pipeline_stages_follow_each_other(spark, tmp_path):
    passage = " ".join(f"shared{i}" for i in range(60))
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    base = docs.schema
    extra = [(100001, f"one alpha {passage} omega", "en", "x", 5), (100002, f"quite other words first {passage} and then an end", "en", "x", 5),
             (100003, None, "en", "x", 0), (100004, "", "en", "x", 0), (100001, f"one alpha {passage} omega", "en", "x", 5)]
    docs.unionByName(spark.createDataFrame(extra, base)).write.parquet(f"{tmp_path}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{TINY}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    at, ids = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, at, str(tmp_path))
        assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{name}")
        at = spark.read.parquet(f"{tmp_path}/{name}")
        ids.append({r.doc_id for r in at.collect()})
    assert len(ids[0]) > 150 and ids[0] >= ids[1] == ids[2] >= ids[3]
    texts = {r.doc_id: r.text for r in at.collect()}
    assert texts[100001] == "one alpha omega" and texts[100002] == "quite other words first and then an end"
    assert len({100003, 100004} & ids[1]) == 1                      # empty texts are near duplicates
    assert at.where("doc_id = 100001").count() == 1
    packed = corpus_pipeline.STAGES[-1][1](spark, at, str(tmp_path))
    assert {r.doc_id for r in packed.collect()} == ids[3]


def test_the_empty_text_scores_the_share_of_ones(spark):
    for sf in ("sf0.001", "sf0.01"):
        docs, labels = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
        odd = spark.createDataFrame([(1, None, "c"), (2, "", "c"), (3, " \n\t ", "c"), (4, "x " * 2_000_000, "c"), (4, None, "c")],
                                    "doc_id long, text string, score string")
        got = toxicity.score(odd, toxicity.fit(docs, labels), carry=("score",)).orderBy("doc_id").collect()
        assert got[0].score == got[1].score == got[2].score < 0.2 and len(got) == 5
        assert got[0].carried.score == "c"


def test_the_sample_is_one_row_for_each_of_the_lowest_hashes(spark):
    df = spark.range(40).select("id", F.explode(F.sequence(F.lit(1), F.lit(300))).alias("copy"))
    key = F.xxhash64("id")
    want = sorted(r[0] for r in df.select(key).distinct().collect())[:20]
    assert sorted(r[0] for r in lowest(df, key, 20).select(key).collect()) == want
    assert lowest(df, key, 60).count() == 40
    assert lowest(df.where("false"), key, 5).count() == 0


def test_the_training_texts_are_bounded(spark):
    docs = spark.createDataFrame([(i, f"word{i} " * 50) for i in range(40)] + [(1, "another text")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    seen = []
    keep = toxicity.train
    toxicity.train = lambda texts, y: seen.append(texts) or keep(texts, y)
    try:
        toxicity.fit(docs, labels, size=2000)
    finally:
        toxicity.train = keep
    assert 1 < len(seen[0]) and sum(map(len, seen[0])) <= 2000


def test_filtering_scores_equals_filtering_rows(spark):
    docs = spark.createDataFrame([(i, f"good {i}" if i % 3 else "bad idiot", "c") for i in range(60)], "doc_id long, text string, source string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    kept = toxicity.score(docs, model, carry=("doc_id", "text", "source"), below=0.3)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in toxicity.score(docs, model).where("score < 0.3").collect())


@pytest.fixture(scope="module")
def page_model(spark):
    return html_extract.train([r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").limit(150).collect()])


def text_of(model, source):
    page = html_extract.Page(source)
    return page.decode(model.odds(page.features()))


PROSE = ("This is the first paragraph of the text, which says something long enough. It goes on a little.",
         "And the second one follows, with more words in it, as articles have.")


@pytest.mark.parametrize("name", ["content", "", "content has-sidebar", "post comments-open", "entry-content share-enabled",
                                  "article-body no-ads", "main header-fixed", "post tag-news author-jane"])
@pytest.mark.parametrize("tag", ["div", "main", "article"])
def test_class_names_that_say_what_else_a_page_has(page_model, tag, name):
    source = ("<html><body><nav><ul><li><a href=x>Home</a></li><li><a href=y>About</a></li></ul></nav>"
              f"<{tag} class='{name}'><p>{PROSE[0]}</p><p>{PROSE[1]}</p></{tag}><footer>Copyright 2024 someone</footer></body></html>")
    assert text_of(page_model, source) == "\n".join(PROSE)


def test_formulas_and_fallback_texts_are_text(page_model):
    source = (f"<body><article><p>{PROSE[0]}</p><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> hold. It is so.</p>"
              f"<p>Here is <video src=v>the film in words</video> and more of it.</p><p>{PROSE[1]}</p></article></body>")
    assert text_of(page_model, source) == f"{PROSE[0]}\nLet x=2 hold. It is so.\nHere is the film in words and more of it.\n{PROSE[1]}"


def test_pages_of_very_many_tags(page_model):
    import time

    start = time.process_time()
    for source in ("<body><article>" + "<b>word <i>" * 100_000 + "</article>", "<body>" + "<b>" * 60_000 + "<h2>x</h2>" * 60_000,
                   "<body><ul>" + "<li>x" * 100_000, "<div>" * 50_000 + "deep", "<a href='" * 20_000):
        html_extract.Page(source).features()
    assert time.process_time() - start < 60


def test_the_kept_set_is_the_best_that_holds_every_ancestor():
    import itertools

    r = random.Random(8)
    for _ in range(60):
        source, depth = "", 0
        for _ in range(r.randint(1, 7)):
            if depth and r.random() < 0.4:
                source, depth = source + "</div>", depth - 1
            else:
                source, depth = source + r.choice(["<div>", "<div>", "<p>some words</p>"]), depth
                depth += source.endswith("<div>")
        page = html_extract.Page("<section>" + source + "</section>")
        n = len(page.parent)
        odds = np.array([r.choice([-2.5, -1.25, 0.75, 1.5, 3.25]) + r.random() / 100 for _ in range(n)])
        best, kept = None, None
        for bits in itertools.product((0, 1), repeat=n - 1):
            own = (1, *bits)
            if all(own[page.parent[i]] >= own[i] for i in range(1, n)):
                total = sum(odds[i] for i in range(1, n) if own[i])
                if best is None or total > best:
                    best, kept = total, own
        assert page.decode(odds) == "\n".join(page.text[i] for i in range(n) if kept[i] and page.text[i] is not None)


def test_a_page_repeated_thousands_of_times(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html")
    copies = pages.limit(1).select("page_id", "url", "html").crossJoin(spark.range(5000)).drop("id")
    docs = pages.unionByName(copies)
    model = html_extract.fit(docs)
    row = pages.first()
    assert text_of(model, row.html) == plain_article(row.html)
