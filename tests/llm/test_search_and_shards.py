"""Top-k search, sharding, HTML extraction and chat formatting."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry_points
from brute_force import words
from corpus_fixtures import SMALL, documents  # noqa: F401
from stratamart.llm.bm25_search import Shard, bm25_topk
from stratamart.llm.chat_format import chat_examples, parsed_turns
from stratamart.llm import html_extract
from stratamart.llm.html_extract import _path_hash, Template, Page, extract_pages, main_text, slots_of, template_of
from stratamart.llm.sharding import place, shard_documents


def bm25(docs, queries, k):
    """Plain scores: rows (id, text) -> {query id: [(id, score)]}."""
    bags = [(i, Counter(words((t or "").lower()))) for i, t in docs]
    df = Counter(w for _, bag in bags for w in bag)
    mean = sum(sum(b.values()) for _, b in bags) / len(bags)
    out = {}
    for q, text in queries:
        scored = []
        for i, bag in bags:
            norm = 1.2 * (0.25 + 0.75 * sum(bag.values()) / mean)
            s = sum(math.log(1 + (len(bags) - df[w] + 0.5) / (df[w] + 0.5)) * bag[w] * 2.2 / (bag[w] + norm)
                    for w in set(words((text or "").lower())) if w in bag)
            if s > 0 and i is not None:
                scored.append((-round(s, 6), i))
        if scored:
            out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


@pytest.mark.parametrize("shard_docs", [7, 1000])
def test_topk_equals_plain_scores(documents, shard_docs):
    rng = random.Random(1)
    rows = [(i, " ".join(f"w{min(int(rng.paretovariate(0.5)), 300)}" for _ in range(rng.randint(1, 60)))) for i in range(600)]
    rows += [(1000 + i, rows[5][1]) for i in range(30)] + [(2000, None), (2001, ""), (2002, "long " * 5_000), (None, rows[5][1])]
    df = documents(rows).repartition(3)
    queries = [r for r in rows if r[0] is not None and r[0] % 50 == 0]
    got = defaultdict(list)
    for r in bm25_topk(df, df.where("doc_id % 50 = 0"), k=7, shard_docs=shard_docs).orderBy("query", "rank").collect():
        got[r["query"]].append((r["doc_id"], r["score"]))
        assert r["rank"] == len(got[r["query"]])
    expected = bm25(rows, queries, 7)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in expected.items()}
    assert all(abs(a[1] - b[1]) < 2e-6 for q in got for a, b in zip(got[q], expected[q]))
    assert bm25_topk(documents([]), df).count() == 0 and bm25_topk(df, documents([])).count() == 0


def test_pruning_skips_blocks_and_loses_nothing():
    rng = np.random.default_rng(2)
    vocabulary = np.arange(50, dtype=np.int64)
    docs = [rng.integers(0, 50, rng.integers(1, 40)) for _ in range(2_000)]
    shard = Shard(list(range(2_000)), docs, vocabulary, 1.2, 0.75, 20.0)
    scored = []
    plain, shard._scores = shard._scores, lambda e, w, wanted: scored.append(wanted.sum()) or plain(e, w, wanted)
    terms, weights = np.array([1, 2, 3]), np.array([5.0, 0.1, 0.1])
    scores, keys = shard.best(terms, weights, 5, 0.0)
    entries = sum(shard.entry_of[terms + 1] - shard.entry_of[terms])
    everything = np.round(plain(*(x := (np.concatenate([np.arange(shard.entry_of[t], shard.entry_of[t + 1]) for t in terms]),
                                        np.concatenate([np.full(shard.entry_of[t + 1] - shard.entry_of[t], w) for t, w in zip(terms, weights)]))),
                                np.ones(len(x[0]), bool)), 6)
    order = np.lexsort((shard.keys, -everything))[:5]
    best = np.lexsort((keys, -scores))[:5]
    assert keys[best].tolist() == shard.keys[order].tolist() and sum(scored) < entries


def test_sharding_law_and_slots(documents):
    rng = random.Random(3)
    rows = [(i, "word " * rng.randint(0, 60)) for i in range(900)] + [(i % 7, "a copy of one text") for i in range(600)]
    rows += [(None, None), (5000, ""), (5001, "x" * 2_000)]
    got = shard_documents(documents(rows), shards=4, cell_parts=100).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    bytes_, counts, slots = Counter(), Counter(), defaultdict(list)
    for r in got:
        bytes_[r["shard"]] += r["size"]
        counts[r["shard"]] += 1
        slots[r["shard"]].append(r["slot"])
    assert set(bytes_) == {0, 1, 2, 3} and max(bytes_.values()) < 1.03 * min(bytes_.values())
    assert max(counts.values()) < 1.2 * min(counts.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(r["law"] == "bytes" and r["grown_shard"] is None for r in got)
    assert shard_documents(documents([])).count() == 0


def test_equal_texts_stay_together_unless_they_are_many(documents):
    rows = [(i, f"text {i // 2} " + "w " * 40) for i in range(400)]
    where = defaultdict(set)
    for r in shard_documents(documents(rows), shards=4).collect():
        where[r["doc_id"] // 2].add(r["shard"])
    assert all(len(s) == 1 for s in where.values())


def test_placement_follows_the_dot_product():
    demands = np.array([[5.0, 1, 1], [4, 4, 1], [1, 6, 1], [1, 1, 1]])
    share, left, out = demands / demands.sum(axis=0), np.full((2, 3), 0.5), []
    for item in share:
        s = max((0, 1), key=lambda j: (sum(left[j] * item), -j))
        left[s] -= item
        out.append(s)
    assert place(demands, 2, (1.0, 1.0, 1.0)).tolist() == out


FRAME = ('<html><head><title>t</title><style>p{{}}</style><script>x("</p>")</script></head><body class="has-sidebar"><nav><ul><li><a>Home</a>'
         '<li>About</ul></nav><header>Site</header><div class="cookie-notice">We use cookies</div>{main}<aside>More</aside>'
         '<form><input value="x">Search</form><section id="comments"><article class="comment"><p>A reader says</p></article></section>'
         '<footer>&copy; site</footer></body></html>')
PAGES = [
    ("<article><h1>A&amp;B &lt;i&gt;</h1><p><b>First\n\n  one<br>line<p>Second &eacute; &#x41;<div class=ad>buy</div></article>", "A&B <i>\n\nFirst one line\n\nSecond é A"),
    ("<main><p>In main</p><nav>menu</nav><div><p>deep</main>", "In main\n\ndeep"),
    ('<div id="content"><p>In a container</p><script>no()</script></div>', "In a container"),
    ("<article><p>one<article><p>two</article><p>three <!-- no --> four</article><p>outside</p>", "one\n\ntwo\n\nthree four"),
    ("<article><table><tr><td>a<td>b<tr><td>c</table><ul><li>x<li>y</ul>1 < 2 & 3</article>", "a\n\nb\n\nc\n\nx\n\ny\n\n1 < 2 & 3"),
    ("<article></article>", ""),
]


def test_main_text_of_pages(spark):
    rows = [(i, f"https://Site.example:80/{i}?q", FRAME.format(main=m)) for i, (m, _) in enumerate(PAGES)]
    rows += [(90, None, None), (91, "", ""), (92, "http://site.example/x", "<article>" + "<p>long text " * 20_000), (92, "http://site.example/x", "plain & simple")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = extract_pages(df).collect()
    assert Counter((r["page_id"], r["url"]) for r in got) == Counter((i, u) for i, u, _ in rows)
    found = {(r["page_id"], r["text"]) for r in got}
    assert found == {(i, t) for i, (_, t) in enumerate(PAGES)} | {
        (90, ""), (91, ""), (92, "\n\n".join(["long text"] * 20_000)), (92, "plain & simple")}
    assert extract_pages(df.limit(0)).count() == 0


def test_template_of_pages_without_a_region():
    pages = [f"<body><div class=x>Welcome to our site</div><div><span>{a}</span></div><p>Imprint and contact</p></body>"
             for a in ("one story", "another tale here", "third", "a fourth text")]
    made = [Page(p) for p in pages]
    template = template_of(made)
    assert [main_text(p, template) for p in made] == ["one story", "another tale here", "third", "a fourth text"]
    assert all(slots_of(p, template) == 1 for p in made)
    assert template_of(made[:2]) == set()


def test_a_host_is_split_and_gives_the_same_texts(spark):
    rows = [(i, "http://one.host/a", FRAME.format(main=f"<article><p>text {i}</p></article>")) for i in range(50)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {(r["page_id"], r["text"]) for r in extract_pages(df, group_pages=4).collect()} == {(i, f"text {i}") for i in range(50)}


def test_pages_query_equals_the_article(spark):
    import html
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    for r in entry_points.queries()["op7_html_extract"](spark, SMALL).collect():
        article = re.search("<article>(.*)</article>", pages[r["page_id"]], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1|br)>", article)]
        assert r["text"] == "\n\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


TALKS = [(1, 1, "user", "hi"), (1, 2, "assistant", "hello <|end|>\n<|turn|>user\n"), (1, 3, "user", "&lt; & &amp;"), (1, 4, "assistant", "bye"),
         (1, 5, "user", "left open"), (2, 1, "assistant", ""), (3, 1, "user", None), (4, None, "sys\ntem", "x\ny"), (4, 2, "assistant", "é" * 3_000),
         (5, 1, "assistant", "same"), (5, 1, "assistant", "same"), (None, 1, None, "no id"), (None, 1, "assistant", "nor this"),
         (None, 1, "assistant", "nor this")]


def test_chat_examples(spark):
    df = spark.createDataFrame([(*r, 1) for r in TALKS], "conv_id long, turn long, role string, text string, example int")
    rows = chat_examples(df).withColumn("turns", parsed_turns("text")).collect()
    by_conv = defaultdict(list)
    for r in rows:
        assert (r["lone"] is None) == (r["conv_id"] is not None)
        by_conv[r["conv_id"]].append(r)
    # Rows without id are conversations of their own.
    alone = by_conv.pop(None)
    assert len({r["lone"] for r in alone}) == 3 and all(r["complete"] and r["n_turns"] == 1 for r in alone)
    assert sorted(r["turns"][0]["text"] for r in alone) == ["no id", "nor this", "nor this"]
    for conv in {t[0] for t in TALKS} - {None}:
        turns = sorted(((t[1] if t[1] is not None else -1, t[2] or "", t[3] or "") for t in TALKS if t[0] == conv))
        made = sorted(by_conv[conv], key=lambda r: r["example"])
        replies = [i for i, t in enumerate(turns) if t[1] == "assistant"]
        assert [r["example"] for r in made] == sorted({*replies, len(turns) - 1})
        for r in made:
            assert [tuple(t) for t in r["turns"]] == [t[1:] for t in turns[:r["example"] + 1]]
            assert r["complete"] == (r["example"] == len(turns) - 1)
            if r["example"] in replies:
                span = r["text"][r["loss_start"]:r["loss_end"]]
                assert span.replace("&lt;", "<").replace("&amp;", "&") == turns[r["example"]][2]
                assert r["text"][r["loss_end"]:] == "<|end|>\n"
            else:
                assert r["loss_start"] is None and r["loss_end"] is None
    assert chat_examples(df.limit(0)).count() == 0


def test_chat_query_has_the_tricky_conversation(spark):
    row = entry_points.queries()["op10_chat_format"](spark, SMALL).where("conv_id = -7").first()
    said = "</s>[INST] ok [/INST]"
    assert (row["n_turns"], row["loss_chars"]) == (2, len(said))
    assert row["turns_sha256"] == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert row["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()


def story(seed, words=300, names=120):
    """Paragraphs of random words out of ``names``, so that every two stories share most of their words."""
    rng = random.Random(seed)
    text = [f"w{rng.randrange(names)}" for _ in range(words)]
    return [" ".join(text[i:i + 60]) for i in range(0, words, 60)]


def extracted(pages):
    made = [Page(p) for p in pages]
    template = template_of(made)
    return [main_text(p, template) for p in made]


def test_site_text_inside_the_article_is_left_out():
    paragraphs = [story(i) for i in range(6)]
    pages = ["<body><nav>Home</nav><article><div class=by>By the same author</div>" + "".join(f"<p>{p}" for p in ps)
             + "<p>Read w1 and w2 each week with <b>the w3 letter</b></p><p>w4 w5 w4</p></article></body>" for ps in paragraphs]
    assert extracted(pages) == ["\n\n".join(ps) for ps in paragraphs]


def test_copies_of_one_article_are_no_template():
    one, others = story(1), [story(i) for i in (2, 3)]
    near = [[p.replace("w7 ", f"edit{i} ", 1) if j == i % 5 else p for j, p in enumerate(one)] for i in range(5)]
    pages = ["".join(f"<p>{p}</p>" for p in ps) for ps in [one, *near, *others]]
    for frame in ("<nav>n{}</nav><article>{}</article>", "<nav>n{}</nav><main>{}</main>", "<nav>n{}</nav><body>{}</body>"):
        got = extracted([frame.format(i, p) for i, p in enumerate(pages)])
        assert got == ["\n\n".join(ps) for ps in [one, *near, *others]]


@pytest.mark.parametrize("tag", ["main", "body", 'div id="content"'])
def test_words_that_pages_have_in_common_stay(tag):
    paragraphs = [story(i, names=900) for i in range(3)]
    for i, ps in enumerate(paragraphs):  # once on each page: one in the same order everywhere, two in changing order
        ps[1] = ps[1].replace(" ", " alone ", 1)
        ps[2 + i % 2] += " first"
        ps[3 - i % 2] += " second"
    pages = [f"<html><{tag}><p>Welcome to the site of w1 and w2</p><div class=tag><i>Share</i></div>" + "".join(f"<p>{p}</p>" for p in ps)
             + f"<p>Imprint and the contact</p></{tag.split()[0]}></html>" for ps in paragraphs]
    assert extracted(pages) == ["\n\n".join(ps) for ps in paragraphs]


def test_a_class_in_changing_order_loses_only_what_is_out_of_order():
    paragraphs = [story(i, names=900) for i in range(4)]
    boxes = ["<div class=a><b>Our shop</b></div>", "<div class=b><b>Our club</b></div>"]
    pages = [boxes[i % 2] + boxes[1 - i % 2] + "".join(f"<p>{p}</p>" for p in ps) for i, ps in enumerate(paragraphs)]
    made = [Page(f"<html><body>{p}</body></html>") for p in pages]
    template = template_of(made)
    body = _path_hash(_path_hash(0, "html"), "body")
    assert {("open", "body", body), ("open", "div", _path_hash(body, "div.a")), ("open", "div", _path_hash(body, "div.b"))} <= template
    assert [main_text(p, template) for p in made] == ["\n\n".join(ps) for ps in paragraphs]


def test_names_of_furniture_in_an_article_need_evidence():
    parts = ['<h2 id="related-work">Related work</h2><p>a', '<section id="search"><h2>On search</h2><p>b</section>', '<p class="notice">c',
             '<div class="social-policy"><p>d</p></div>', '<h3 class="banner">The banner</h3><p>e', '<div class="ad">buy</div><p>f']
    texts = ["Related work\n\na", "On search\n\nb", "c", "d", "The banner\n\ne", "f"]
    bodies = [(f"<{tag}>{part}{''.join(f'<p>{p}</p>' for p in story(i))}</{tag}>", "\n\n".join([text, *story(i)]))
              for tag in ("article", "main") for i, (part, text) in enumerate(zip(parts, texts))]
    for body, text in bodies:
        assert extracted([body]) == [text]
    half = len(bodies) // 2
    assert extracted([b for b, _ in bodies[:half]]) == [t for _, t in bodies[:half]]
    # The same container on most pages, with other links on each.
    pages = [b.replace("</article>", f'<div class="related"><ul><li>link {i}<li>more {i + 1}</ul></div></article>') for i, (b, _) in enumerate(bodies[:half])]
    assert extracted(pages) == [t for _, t in bodies[:half]]


FORMS = ['<div class="comments"><p>{}</p></div>', '<section class="comments"><article class="comment"><p>{}</p></article></section>',
         '<div class="newsletter">{}</div>', '<div class="cookie-notice">{}</div>', '<div class="sidebar"><p>{}</p></div>',
         '<div class="related"><ul><li>{}</li></ul></div>', '<ul class="share"><li>{}</li></ul>', '<div id="comments"><p>{}</p></div>',
         '<aside class="post-sidebar">{}</aside>', '<div class="RelatedPosts">{}</div>']


@pytest.mark.parametrize("region", ["article", "main"])
def test_certain_furniture_goes_without_evidence(region):
    alone = [f"<{region}><h1>T</h1><p>body {i}</p>{form.format('not this')}<p>end</p></{region}>" for i, form in enumerate(FORMS)]
    for i, page in enumerate(alone):
        assert extracted([page]) == [f"T\n\nbody {i}\n\nend"]
    # On one of six pages of a host, and other words each time.
    for i, page in enumerate(alone):
        others = [f"<{region}>" + "".join(f"<p>{p}" for p in story(j)) + f"</{region}>" for j in range(5)]
        assert extracted([page, *others])[0] == f"T\n\nbody {i}\n\nend"


def test_names_that_only_contain_a_word_of_furniture_stay():
    kept = ["related-work", "comment-policy", "share-price", "has-sidebar", "cookie-recipes", "newsletters-of-the-war"]
    page = "<article>" + "".join(f'<div class="{c}"><p>{c}</p></div>' for c in kept) + '<section id="comments"><p>on comments</p></section></article>'
    assert extracted([page]) == ["\n\n".join([*kept, "on comments"])]


MEGABYTE = 1_000_000
ODD_PAGES = ["<a ", "<", "<a href=\"", "<a href='x", "<!", "<!--", "<![CDATA[", "</", "<div>", "<div class=comments>", "<p><span>", "<li><b>", "<h1>", "<a \"'>",
             "<script", "<script>", "&amp;", "<a b='\">", "<div", "<td>", "</div>"]


@pytest.mark.parametrize("part", ODD_PAGES)
@pytest.mark.parametrize("end", ["", "x>", "\""])
def test_odd_pages_take_linear_time(part, end):
    page = "<article><p>words</p></article>" + part * (MEGABYTE // len(part)) + end
    started = time.process_time()
    text = main_text(Page(page), Template())
    assert text.startswith("words") and time.process_time() - started < 10


def test_groups_are_split_by_size(spark, monkeypatch):
    monkeypatch.setattr(html_extract, "GROUP_CHARS", 2_000)
    rows = [(i, "http://one.host/a", FRAME.format(main=f"<article><p>text {i}</p></article>")) for i in range(20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {(r["page_id"], r["text"]) for r in extract_pages(df).collect()} == {(i, f"text {i}") for i in range(20)}


def test_queries_in_batches_find_what_single_ones_find(monkeypatch):
    """Whole texts of two languages, with common and rare terms, over several shards; few documents, ties and queries without hits too."""
    from stratamart.llm import bm25_search
    from stratamart.llm.bm25_search import Results

    monkeypatch.setattr(bm25_search, "POSTINGS", 500)
    rng = np.random.default_rng(4)
    vocabulary = np.arange(600, dtype=np.int64) * 7
    draw = lambda n, low: low + np.minimum(rng.pareto(0.7, n).astype(np.int64), 290) * 7
    docs = [draw(rng.integers(1, 60), 0 if i % 3 else 2100) for i in range(900)] + [np.array([70, 4])] * 30 + [np.empty(0, np.int64)]
    keys = rng.permutation(len(docs)).tolist()
    queries = [np.unique(np.searchsorted(vocabulary, d)) for d in docs[:60]] + [np.array([599]), np.array([10])]
    weights, k = rng.uniform(0.1, 8.0, len(vocabulary)), 7
    term, query = np.concatenate(queries).astype(np.int32), np.repeat(np.arange(len(queries)), [len(q) for q in queries])
    found, single = Results(query, term, len(queries), k), [Results(np.zeros(len(q), int), q, 1, k) for q in queries]
    multiplied = 0
    for lo, hi in ((0, 400), (400, 900), (900, 903), (903, len(docs))):
        shard = Shard(keys[lo:hi], docs[lo:hi], vocabulary, 1.2, 0.75, 20.0)
        multiplied += len(shard.rows)
        for r in (found, *single):
            r.search(shard, weights)
    assert multiplied and max(len(r.query) for r in single) == k
    for i, r in enumerate(single):
        mine = found.query == i
        assert found.key[mine].tolist() == ([] if r.key is None else r.key.tolist())
        assert np.allclose(found.score[mine], r.score, atol=2e-6)


def test_a_shard_takes_few_steps_for_many_queries(documents, monkeypatch):
    """Queries are held against a shard in batches; one by one only where a batch has a single query."""
    rng = np.random.default_rng(5)
    docs = [rng.integers(0, 90, 40) for _ in range(300)]
    shard = Shard(list(range(300)), docs, np.arange(90, dtype=np.int64), 1.2, 0.75, 40.0)
    from stratamart.llm.bm25_search import Results, _batches

    monkeypatch.setattr(Shard, "best", None)
    terms = [np.unique(d) for d in docs]
    starts = np.append(0, np.cumsum([len(t) for t in terms]))
    ranges = list(_batches(starts))
    assert len(ranges) == 3 and [lo for lo, _ in ranges[1:]] == [hi for _, hi in ranges[:-1]] and ranges[-1][1] == 300
    for lo, hi in ranges:
        found = Results(np.repeat(np.arange(hi - lo), np.diff(starts[lo:hi + 1])), np.concatenate(terms[lo:hi]), hi - lo, 5)
        found.search(shard, np.ones(90))
        assert len(found.query) == 5 * (hi - lo)
