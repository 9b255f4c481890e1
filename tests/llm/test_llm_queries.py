"""The registered queries: their SQL twins, their columns, pages and the pipeline."""

import html as entities
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import brute
import corpus_pipeline
from check import differences, oracle_frame
from creditmill.llm.html_text import extract_pages, main_text
from creditmill.llm.mixing import BLOCKS_PER_SHARD, SHARDS, mix_plan
from creditmill.llm.oracle import ORACLE
from creditmill.llm.queries import QUERIES, URL_RULES, vocabulary
from creditmill.llm.token_store import read_tokens, store_tokens
from creditmill.llm.url_filter import RULE_SCHEMA, judge_urls
from creditmill.operators.materialize import BATCH_SETTING

COLUMNS = {
    "op1_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op2_mixing": "doc_id size source_size target taken",
    "op3_html_text": "page_id url text n_chars",
    "op4_substring_dedup": "doc_id n_words n_removed kept_sha256",
    "op5_minhash": "doc_id n_shingles component_id kept",
    "op6_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op7_decontaminate": "doc_id item_id word_start n_edits",
    "op8_toxicity": "doc_id held_out score predicted",
    "op9_url_filter": "page_id host path rule verdict",
    "op10_token_store": "doc_id start n_tokens ids_crc32",
    "op11_vector_codes": "vec_id code error label_error codebooks_sha256",
    "op12_whitening": "vec_id component n deviation whitened explained identity_error",
    "op13_backoff_lm": "doc_id held_out n_tokens n_known train_tokens base_score score",
}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, small, name):
    found = QUERIES[name](spark, small).toPandas()
    assert differences(found, oracle_frame(ORACLE[name], small)) is None


def test_all_are_registered_with_their_columns(spark, small):
    assert set(QUERIES) == set(COLUMNS) and set(QUERIES) | {"pipeline"} <= set(contract.queries())
    rows = spark.read.parquet(f"{small}/documents.parquet").count()
    for name in ("op2_mixing", "op6_token_counts", "op8_toxicity", "op13_backoff_lm"):
        df = QUERIES[name](spark, small)
        assert set(COLUMNS[name].split()) <= set(df.columns) and df.count() == rows
    vectors = spark.read.parquet(f"{small}/embeddings.parquet").count()
    assert QUERIES["op11_vector_codes"](spark, small).count() == vectors
    whitened = QUERIES["op12_whitening"](spark, small)
    assert set(COLUMNS["op12_whitening"].split()) <= set(whitened.columns) and whitened.count() == vectors * 32


def test_leaks_query_against_brute_force(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    held = {r.doc_id for r in QUERIES["op7_decontaminate"](spark, small).collect()}
    plain = {i: " ".join(brute.words(t, lower=True)) for i, t in docs}
    assert held == {i for i, t in plain.items() if any(" ".join(brute.words(x, lower=True)) in t for _, x in items)}


# --- urls


def test_rules(spark):
    urls = {
        "http://a.com/x": "com/", "http://a.com": None, "http://example.com/en/1": "example.com/en/",
        "HTTP://WWW.Example.COM/en/?q": "www.example.com/en/", "http://m.www.example.com/en/": "www.example.com/en/",
        "http://notexample.com/en/": "com/", "http://x.net/es/": "net/es/", "http://x.net/es": None, "http://net/fr/a": "net/fr/",
        "x.com/y": None, "": None, None: None, "http://a.com:80/x": None, "a://b.com/c://d.net/es/": "com/",
        "http:///en/": None, "http://Ä.com/ü": "com/", "http://a\nb.com/x\ny#z": "com/",
    }
    pages = spark.createDataFrame([(i, u, "k", 1, "v") for i, u in enumerate([*urls, "http://a.com/x"])],
                                  "page_id int, url string, host string, _row int, verdict string")
    rules = spark.createDataFrame(list(URL_RULES), RULE_SCHEMA)
    found = {r.page_id: r for r in judge_urls(pages, rules).collect()}
    assert [found[i].rule for i in range(len(urls))] == list(urls.values()) and len(found) == len(urls) + 1
    assert all(r.verdict == ("block" if r.rule in ("example.com/en/", "net/es/", "net/fr/") else "allow") for r in found.values())
    assert (found[13].host, found[13].path) == ("b.com", "/c://d.net/es/")
    assert judge_urls(pages, rules.limit(0)).where("verdict = 'allow' and rule is null").count() == len(found)
    assert judge_urls(pages.limit(0), rules).count() == 0


# --- pages


def test_pages_against_their_articles(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    for r in extract_pages(pages).join(pages.select("page_id", "html"), "page_id").collect():
        article = r.html.split("<article>")[1].split("</article>")[0]
        for tag in ("<p>", "</p>", "<h1>", "</h1>"):
            article = article.replace(tag, "\n")
        article = article.replace("<br>", " ").replace("<b>", "").replace("</b>", "")
        lines = (" ".join(entities.unescape(x).split()) for x in article.split("\n"))
        assert r.text == "\n".join(x for x in lines if x) and r.n_chars == len(r.text)


def test_main_text_of_a_page_without_article():
    page = """<html><head><title>T</title></head><body><div id="top-menu"><a href=a>Home</a> <a href=b>News</a></div>
    <div class=content><h2>Head &amp; tail</h2><div><p>First   long paragraph with quite some words in it, and
    a <a href=x>link</a>.<p>Second <i>one</i> here, of good length as well, to be read.<ul><li>one<li>two</ul>
    <ul><li><a href=1>Previous</a><li><a href=2>Next</a></ul><form>Name <input></form>
    <table><tr><td>a<td>b</table></div></div><aside>Side</aside><section class="comments"><p>I disagree very much with all
    of this long text</p></section><div class="cookie-notice">We use cookies</div><footer>&copy;</footer>"""
    assert main_text(page) == "\n".join([
        "Head & tail", "First long paragraph with quite some words in it, and a link.",
        "Second one here, of good length as well, to be read.", "one", "two", "a", "b"])


@pytest.mark.parametrize("page, text", [
    ("<html><head><title>T</title><meta charset=utf-8><body><p>First<p>Second", "First\nSecond"),
    ("<head><title>T</title><style>p{}</style><p>First<p>Second", "First\nSecond"),
    ("<head><title>T</title>First<p>Second", "First\nSecond"),
    ("<article><p>First<p class=notice>Mind the gap<p>Second<p>Third</article>", "First\nSecond\nThird"),
    ("<article><p>First</p><ul><li>one<li class=share>tell<li>two</ul><p>Second</article>", "First\none\ntwo\nSecond"),
    ("<article><div><p>First</p><nav><a href=x>up</a></div><p>Second</article>", "First\nSecond"),
    ("<article><dl><dt hidden>a<dd>b</dl><table><tr><td hidden>c<td>d<tr><td>e</table></article>", "b\nd\ne"),
    ("<article><p>First</p><b><nav>menu</b> more</nav></b><ul><li>one<nav><li>x</nav> two</ul></article>", "First\none two"),
])
def test_dropped_elements_without_end_tags(page, text):
    assert main_text(page) == text


LONG = " ".join(["A sentence of the text with a good number of words in it."] * 5)


@pytest.mark.parametrize("page, text", [
    (f'<div class="content has-sidebar"><p>{LONG}</p><p>{LONG}</p></div><div class=sidebar><p>Side</p></div>', f"{LONG}\n{LONG}"),
    (f'<div id="content-sidebar-wrap"><div><p>{LONG}<p>{LONG}</div></div>', f"{LONG}\n{LONG}"),
    (f'<div class=widget><p>{LONG}</p><p>{LONG}</p></div><div class=widget><p>Other</p></div>', f"{LONG}\n{LONG}"),
    (f'<article><header class="entry-header"><h1>Head</h1></header><p>{LONG}</p></article>', f"Head\n{LONG}"),
    (f'<article><div class="article-header"><h1>Head</h1></div><p>{LONG}</p></article>', f"Head\n{LONG}"),
    (f'<article><h2 id="menu">Menu</h2><p>{LONG}</p><h2 id="social-impact">Impact</h2><p>{LONG}</p></article>', f"Menu\n{LONG}\nImpact\n{LONG}"),
    (f'<article><p>{LONG}</p><section id="related-work"><h2>Related work</h2><p>{LONG}</p></section></article>', f"{LONG}\nRelated work\n{LONG}"),
    (f'<article><p>{LONG}</p><div class="x ad">Buy</div></article><div class=comments><p>{LONG}<p>{LONG}<p>{LONG}</div>', LONG),
    (f'<article><p>More</p></article><div class=widget><p>{LONG}</p><p>{LONG}</p></div>', f"{LONG}\n{LONG}"),
])
def test_names_are_evidence_only(page, text):
    assert main_text(f"<html><head><title>T</title></head><body>{page}</body></html>") == text


@pytest.mark.parametrize("before, behind", [(3, 4), (4, 3), (1, 6), (6, 1)])
def test_blocks_beside_the_largest(before, behind):
    first, last = (f"<section><h2>Part</h2>{f'<p>{LONG}</p>' * n}</section>" for n in (before, behind))
    links = "".join(f"<li><a href={i}>Page number {i}</a></li>" for i in range(9))
    page = f"<body><ul>{links}</ul><h1>Head</h1><p>{LONG}</p>{first}<div>{last}</div>{LONG} <b>bold</b><ul>{links}</ul><div>Imprint</div></body>"
    assert main_text(page) == "\n".join(["Head", LONG, "Part", *[LONG] * before, "Part", *[LONG] * behind, f"{LONG} bold"])


def test_odd_pages(spark):
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    pages = [None, "", "   ", "plain text", "<p>open", "<script>var a = '<p>no</p>';</script>", "<!-- x -->", "</p></div>", "&am &quo; &lt;b&gt; &#x41;", deep, "<p>é\u00a0\u2003x</p>" * 5000]
    df = spark.createDataFrame([(i, None, h, "t", 1) for i, h in enumerate(pages)] + [(0, "u", None, "t", 1)],
                               "page_id int, url string, html string, text string, n_chars int")
    found = [(r.page_id, r.text) for r in extract_pages(df).orderBy("page_id").collect()]
    texts = ["", "", "", "", "plain text", "open", "", "", "", "&am &quo; <b> A", "deep", "\n".join(["é x"] * 5000)]
    assert [t for _, t in found] == texts and extract_pages(df.limit(0)).count() == 0


# --- the pipeline


def test_stages(spark, small):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "mixing", "token_output"] and corpus_pipeline.ORACLE_SQL is None
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, before = docs.columns, docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.computed_once(stage(spark, before, small))
        if name != "token_output":
            assert after.columns == columns
            kept[name] = (before, after)
        before = after
    ids = {n: ({r[0] for r in b.select("doc_id").collect()}, {r[0] for r in a.select("doc_id").collect()}) for n, (b, a) in kept.items()}

    toxic = {r.doc_id for r in spark.read.parquet(f"{small}/labels.parquet").where("toxic = 1").collect()}
    gone = ids["toxicity"][0] - ids["toxicity"][1]
    assert len(gone & toxic) >= 0.5 * len(toxic) and len(gone - toxic) <= 0.1 * docs.count()

    near = [(r.doc_id, r.text) for r in kept["near_duplicates"][0].collect()]
    assert ids["near_duplicates"][1] == {r for i, (n, r) in brute.components(near, 80).items()}

    leaked = ids["decontamination"][0] - ids["decontamination"][1]
    items = [brute.words(r.text, lower=True) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    texts = {r.doc_id: " ".join(brute.words(r.text, lower=True)) for r in kept["decontamination"][0].collect()}
    assert leaked == {i for i, t in texts.items() if any(" ".join(x) in t for x in items)}

    source_words = lambda df: {r[0]: r[1] for r in df.groupBy("source").agg(F.sum(F.regexp_count("text", F.lit(brute.WORD.pattern)))).collect()}
    goals, mixed = brute.targets(source_words(kept["mixing"][0])), source_words(kept["mixing"][1])
    assert all(abs(mixed.get(s, 0) - t) <= 1 for s, t in goals.items())
    assert before.count() == kept["mixing"][1].count()


def test_pipeline_stages_on_odd_and_empty_rows(spark, small, tmp_path):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, label int, kept string, passes int"
    rows = [(1, None, None, None, None), (2, "", "en", "", 0), (3, "a b c", "en", "s", 5), (3, "a b c", "en", "s", 5),
            (None, "no id", None, "s", None), (4, "w " * 30_000, "de", None, 1), (5, "Ü " + "x y z " * 5, "de", "s", 3)]
    odd = spark.createDataFrame([(*r, 1, "k", 2) for r in rows], schema)
    for docs in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.computed_once(stage(spark, docs, small))
        assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_quotas_of_the_mix_shape_the_token_output(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r.doc_id: brute.words(r.text) for r in docs.select("doc_id", "text").collect()}
    mixed = corpus_pipeline.computed_once(corpus_pipeline.mixing(spark, docs, small))
    parts = [(r.doc_id, p) for r in mix_plan(docs).collect() for p in r.parts]
    # Every shard has the words of its quotas: blocks of equal size, closed by less than
    # one a source in a shard, so no shard differs from the mean by more.
    shards = Counter()
    for _, p in parts:
        shards[p.shard] += p.words_to - p.words_from
    block = sum(shards.values()) / (SHARDS * BLOCKS_PER_SHARD)
    sources = docs.select("source").distinct().count()
    assert len(shards) == SHARDS and all(abs(n - BLOCKS_PER_SHARD * block) <= sources * (block + 2) for n in shards.values())
    wanted = sorted((i, tuple(texts[i][p.words_from : p.words_to])) for i, p in parts)
    assert sorted((r.doc_id, tuple(brute.words(r.text))) for r in mixed.collect()) == wanted
    stored = corpus_pipeline.token_output(spark, mixed, small)
    assert Counter(r.doc_id for r in stored.collect()) == Counter(i for i, _ in parts)


@pytest.mark.parametrize("name, operator", [("toxicity", "without_toxic"), ("near_duplicates", "one_of_each"), ("decontamination", "without_leaks")])
def test_stages_take_batches_of_bounded_bytes(spark, small, monkeypatch, name, operator):
    before = spark.conf.get(BATCH_SETTING)

    def measured(docs, *_):
        def bytes_of(batches):
            for batch in batches:
                yield pa.RecordBatch.from_pydict({"n": pa.array([batch.nbytes], pa.int64())})

        sizes = docs.select("text").mapInArrow(bytes_of, "n bigint")
        return corpus_pipeline.computed_once(sizes) if name == "near_duplicates" else sizes

    monkeypatch.setattr(corpus_pipeline, operator, measured)
    monkeypatch.setattr(corpus_pipeline, "fit", lambda *_: None)
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.repeat(F.lit("many words "), 10_000).alias("text")).coalesce(1)
    found = [r.n for r in getattr(corpus_pipeline, name)(spark, docs, small).collect()]
    # 44 MB of text, each row 110 kB: no row is left out, no batch is above 4 MB and a row.
    assert sum(found) >= 44_000_000 and max(found) <= (4 << 20) + 200_000
    assert spark.conf.get(BATCH_SETTING) == before


def test_smaller_chunks_store_the_same_ids(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    one, two = (sorted(map(tuple, read_tokens(store_tokens(docs, vocabulary(), chunk_bytes=n)).collect())) for n in (2 << 20, 1 << 16))
    assert one == two and len(one) == docs.count()


def test_stray_markup_raises_nothing_and_keeps_later_text(spark, small):
    import random

    pages = [r.html or "" for r in spark.read.parquet(f"{small}/pages.parquet").select("html").collect()]
    stray = ["<![", "<![x[", "<![foo[bar]]>", "]]>", "<![>", "<p", "\x00", "<![ y"]
    rng = random.Random(7)
    mutated = 0
    while mutated < 1000:
        page = pages[mutated % len(pages)]
        at = rng.randrange(len(page) + 1)
        main_text(page[:at] + rng.choice(stray) + page[at:])
        mutated += 1
    assert main_text("<p>a<![foo[bar]]>b</p><p>after the stray markup</p>") == "ab\nafter the stray markup"
