"""SentencePiece, HTML extraction, personal data, the classifiers and the pipeline."""

from __future__ import annotations

import hashlib
import html
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import op1_sentencepiece, op2_extract, op5_pii, op7_toxicity, op9_nbsvm, shared

SF = "/root/testdata/sf0.01"


# ------------------------------------------------------------------ SentencePiece


@pytest.fixture(scope="module")
def vocabulary():
    return op1_sentencepiece.load()


def plain_viterbi(run, v):
    """All pieces of a run by dynamic programming over characters and a dictionary."""
    pieces = {s.decode(): i for i, s in enumerate(v.surface) if s and i not in set(v.byte_ids.tolist())}
    best = [(0.0, [])] + [(-math.inf, [])] * len(run)
    for end in range(1, len(run) + 1):
        for start in range(end):
            piece = run[start:end]
            if piece in pieces:
                value = best[start][0] + v.scores[pieces[piece]]
                ids = [pieces[piece]]
            elif len(piece) == 1:
                value, ids = best[start][0] + v.unknown, [int(v.byte_ids[b]) for b in piece.encode()]
            else:
                continue
            if value > best[end][0]:
                best[end] = (value, best[start][1] + ids)
    return best[len(run)]


def cost(ids, run, v):
    total, at = 0.0, 0
    raw = run.encode()
    is_byte = set(v.byte_ids.tolist())
    while at < len(ids):
        if ids[at] in is_byte:
            first = v.surface[ids[at]][0]
            at += 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
            total += v.unknown
        else:
            total += v.scores[ids[at]]
            at += 1
    assert b"".join(v.surface[i] for i in ids) == raw
    return total


def test_best_paths(small, vocabulary):
    texts = [r[0] for r in small.select("text").limit(20).collect()] + ["日本語 x😀y \n\t z", "a" * 300, "   lead", "▁▁"]
    encoder = op1_sentencepiece.Encoder(vocabulary)
    runs = sorted({r for t in texts for r in op1_sentencepiece.runs(t, vocabulary)}, key=lambda r: (len(r), r))
    for run in runs[:300] + runs[-20:]:
        encoder.known.clear()
        encoder._learn({run})
        ids = np.frombuffer(encoder.known[run], np.int32).tolist()
        assert ids == op1_sentencepiece.segment(run.encode(), vocabulary)
        assert cost(ids, run, vocabulary) == pytest.approx(plain_viterbi(run, vocabulary)[0])


def test_trie_holds_exactly_the_pieces(vocabulary):
    v = vocabulary
    for i, s in enumerate(v.surface):
        if not s or i in set(v.byte_ids.tolist()):
            continue
        state = 0
        for c in s:
            following = v.base[state] + c
            assert v.check[following] == state
            state = following
        assert v.ends[state] == i
    assert (v.ends >= 0).sum() == sum(1 for s in v.surface if s) - 256


def test_round_trips(odd, empty, small):
    got = op1_sentencepiece.encoded(odd).collect()
    assert len(got) == odd.count() and all(r["round_trip"] for r in got)
    assert sum(r["ids"] is None for r in got) == 2
    assert all(r["n_pieces"] == len(r["ids"] or []) for r in got)
    assert op1_sentencepiece.encoded(small).where("NOT round_trip").count() == 0
    assert op1_sentencepiece.encoded(empty).count() == 0
    kept = op1_sentencepiece.encode_documents(odd.withColumn("ids", F.lit("clash")))
    assert kept.columns == [*odd.columns, "ids", "n_pieces", "round_trip"]


def test_stored_log_probabilities_are_used_as_they_are():
    assert op1_sentencepiece.log_scores([-1.5, -2.25]) == [-1.5, -2.25]
    ranks = op1_sentencepiece.log_scores([-0.0, -1.0, -2.0])
    assert sum(map(math.exp, ranks)) == pytest.approx(1) and ranks[0] > ranks[1] > ranks[2]


# ------------------------------------------------------------------ HTML


def article(page):
    inside = re.search(r"<article>(.*)</article>", page, re.S)[1]
    plain = re.sub(r"<[^>]+>", "", re.sub(r"</?(?:p|h1|br)>", " ", inside))
    return " ".join(html.unescape(plain).split())


def test_pages(spark):
    pages = shared.table(spark, SF, "pages")
    text = {r["page_id"]: r for r in op2_extract.main_texts(pages).collect()}
    for r in pages.collect():
        assert text[r["page_id"]]["text"] == article(r["html"])
        assert text[r["page_id"]]["n_chars"] == len(article(r["html"]))


def test_hard_pages():
    page = (
        "<title>T</title><body><header><a href=/>Site</a></header><div class='cookie-notice'>We use cookies. Please.</div>"
        "<nav><a>Home</a></nav><div id=wrap><div class=post-content><h2>Head</h2><p>One &lt;b&gt; <b>i</b>s&nbsp;here."
        "<ul><li>a<li>b</ul><div class=AdSlot>Buy!</div><script>if (a < b) '</p>'</script><p>Two.</div>"
        "<aside>Most read stories of the day, which are long.</aside><section id=comments><article><p>Great!</article>"
        "</section><form><label>Mail</label></form></div><footer>&copy;</footer>"
    )
    assert op2_extract.main_text(page) == "Head One <b> is here. a b Two."
    bare = "<body><ul><li><a>x</a><li><a>y</a></ul><p>" + "A long sentence of the story. " * 6 + "</p><p>Short end.</p>"
    assert op2_extract.main_text(bare).startswith("A long") and op2_extract.main_text(bare).endswith("Short end.")
    for broken in ("", "<", "<p", "<!--", "<script>", "<p class='x>text", "</p></div>", "<b>" * 3_000 + "x"):
        op2_extract.main_text(broken)


def test_left_out_end_tags():
    one, two = "The first sentence of the story.", "The second sentence of the story."
    story = f"<article><p>{one}</p><p>{two}</p></article>"
    whole = f"{one} {two}"
    script = "<script>var x = '<body><div>';</script>"
    assert op2_extract.main_text(f"<html><head><title>T</title>{script}<body>{story}") == whole
    assert op2_extract.main_text(f"<head><title>T</title><meta name=a>{story}") == whole
    assert op2_extract.main_text(f"<html><head><title>T</title></head><body>{story}</body></html>") == whole
    for name in ("button", "svg", "object", "iframe", "select", "noscript", "template"):
        for page in (
            f"<article><p>{one}<{name}>Silent</p><p>{two}</p></article>",
            f"<article><p>{one}<{name}>Silent<p>{two}</article>",
            f"<article><p>{one}<{name}>Silent</p><p>{two}</p></article><footer><{name}>Save</{name}></footer>",
            f"<article><p>{one}</p><{name}><div>Silent</div></{name}><p>{two}</p></article>",
            f"<article><{name}>Silent<p>{one}</p><p>{two}</p></article>",
        ):
            assert op2_extract.main_text(page) == whole, page
    assert op2_extract.main_text(f"<article><p>{one}</p><script>var silent;<p>{two}</p></article>") == one
    kept = f"<article><p>{one} <math><mi>x</mi></math></p><p hidden>{two}</p><p style='display:none'>End.</p></article>"
    assert op2_extract.main_text(kept) == f"{one} x {two} End."


P1 = "The council met on Tuesday to discuss the new bridge, and the debate went on until late at night."
P2 = "Nobody could say what it will cost, but most of those present were in favour of building it soon."
BOTH = f"<p>{P1}</p><p>{P2}</p>"
AROUND = "<header><a href=/>Site</a></header><nav><a>Home</a> <a>News</a></nav>{}<footer>&copy; 2026 Site Ltd.</footer>"


@pytest.mark.parametrize(
    "page",
    [
        f"<body class='no-sidebar'>{BOTH}",
        f"<body class='page login-page'>{BOTH}",
        f"<body class='post comments-open'><article>{BOTH}</article>",
        f"<div class='main-content with-sidebar'>{BOTH}</div>",
        f"<div class='wrapper has-header'>{BOTH}</div>",
        f"<form id=aspnetForm><div>{BOTH}</div></form>",
        f"<article class='share'>{BOTH}</article>",
        f"<body class='single single-post postid-7 has-sidebar'><div id=page class=hfeed><div id=content class='site-content'><main id=main class='site-main'><article id=post-7 class='post type-post'>{BOTH}</article></main></div><aside id=secondary class='widget-area sidebar'><section class=widget><h2>Recent posts</h2><ul><li><a>One of the stories of last week</a></ul></section></aside></div>",
        f"<body class='td-boxed-layout ad-enabled'><div class='td-main-content-wrap'><div class='td-post-content tagdiv-type'>{BOTH}<div class='td-a-rec ad-slot'>Advertisement: buy one of these fine watches today.</div></div></div>",
        f"<div class='l-page l-page--with-ads'><main class='article-page'><div class='article__body'>{BOTH}</div><div class='article__share'><a>Share</a> <a>Tweet</a></div></main></div>",
        f"<div class='sidebar-layout'><div class='social-page'><article itemprop=articleBody>{BOTH}</article></div></div>",
        f"<div id=notice-board><div class='newsletter-archive'><article>{BOTH}</article></div></div>",
        f"<table class=layout><tr><td class='menu'><a>Home</a><td class='text'>{BOTH}</table>",
        f"<div class='promo-site'><div class='story'>{BOTH}</div></div>",
        f"<main>{BOTH}<section class='related'><article><a>Bridge over the river: the story so far, in pictures and maps.</a></article></section></main>",
        f"<article>{BOTH}</article><div id=comments class='comments-area'><ol class=comment-list>" + "<li><article class=comment><p>I was there and I can tell you that this is not at all what happened.</p></article>" * 9 + "</ol></div>",
    ],
)
def test_names_of_classes_do_not_condemn_a_page(page):
    assert op2_extract.main_text(AROUND.format(page)) == f"{P1} {P2}"


def test_an_articles_own_header_stays():
    page = f"<article class=post><header class='entry-header'><h1 class='entry-title'>A bridge</h1></header><div class='entry-content'>{BOTH}</div><footer class='entry-footer'>Filed under: <a>News</a></footer></article>"
    assert op2_extract.main_text(AROUND.format(page)) == f"A bridge {P1} {P2}"


def test_a_page_of_boilerplate_only_is_empty(spark):
    assert op2_extract.main_text(AROUND.format("<aside>Most read: five stories of the day, which are long.</aside>")) == ""
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert op2_extract.main_texts(empty).count() == 0


def test_cut_against_all_labellings():
    rng = np.random.default_rng(1)
    for _ in range(40):
        n = 7
        costs = rng.normal(0, 2, n).tolist()
        edges = [(i, j, float(rng.random())) for i in range(n) for j in range(i) if rng.random() < 0.5]
        price = lambda keep: sum(abs(c) for c, k in zip(costs, keep, strict=True) if (c > 0) != k) + sum(
            w for u, v, w in edges if keep[u] != keep[v]
        )
        best = min(price([bool(m >> i & 1) for i in range(n)]) for m in range(2**n))
        assert price(op2_extract.minimum_cut(costs, edges)) == pytest.approx(best)


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (2, None, ""), (None, "u", "<p>" + "Text. " * 50_000)]
    got = op2_extract.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1)))
    assert sorted(r["n_chars"] for r in got.collect()) == [0, 0, 0, 299_999]


# ------------------------------------------------------------------ personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_base(text):
    def luhn(digits):
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0

    out = []
    for k, (name, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            fine = (
                name == "email"
                or (name == "ip" and all(int(p) <= 255 for p in m[0].split(".")))
                or (name == "card" and 14 <= len(digits) <= 19 and luhn(digits))
                or (name == "phone" and 10 <= len(digits) <= 15)
            )
            if fine:
                out.append((m.start(), k, m.end(), name))
    return ",".join(f"{name}:{a}:{b}" for a, _, b, name in sorted(out))


HARD = [
    "a@b.c@d.e", "a@b@c.d x@y", "1.2.3.4.5.6.7.8 300.1.1.1 1.2.3.255", "+1 (017) 555-7713--", "+12", "@@@a@b.c.",
    "4111 1111 1111 1111 4111-1111-1111-1111", "..1.2.3.4..", "x+1@y.z-.q", "+1 2 3 4 5 6 7 8 9 0 ) (", "0255.1.1.01",
]


def test_base_spans(spark, small, odd):
    texts = HARD + [r[0] or "" for r in small.select("text").union(odd.select("text")).collect()]
    automaton = op5_pii.anchors()
    for text in texts:
        base = [s for s in op5_pii.find_spans(text, automaton) if s[1] < op5_pii.BASE]
        assert op5_pii.joined(base) == plain_base(text)


def test_added_kinds_and_redaction(odd, empty):
    text = 'see https://a.example.com/x?y=1, token = "f3ef4d6b2755a36d", IBAN: GB82 WEST 1234 5698 7654 32 and account no. 12345678.'
    spans = op5_pii.find_spans(text, op5_pii.anchors())
    assert [op5_pii.KINDS[k] for _, k, _ in spans] == ["url", "secret", "account", "account"]
    assert op5_pii.redact(text, spans) == 'see [URL], token = "[SECRET]", IBAN: [ACCOUNT] and account no. [ACCOUNT].'
    got = op5_pii.personal_data(odd)
    assert got.count() == odd.count()
    blank = got.where("doc_id = 4").first()
    assert blank["base_sha256"] == hashlib.sha256(b"").hexdigest() and blank["spans"] == ""
    done = op5_pii.redact_documents(odd)
    assert done.columns == odd.columns and done.schema["n_chars"].dataType == odd.schema["n_chars"].dataType
    third = done.where("doc_id = 3").first()
    assert third["text"] == "Write to [EMAIL] or [PHONE], host [IP], [CARD]." and third["n_chars"] == len(third["text"])
    assert done.where("text IS NULL").count() == odd.where("text IS NULL").count()
    assert op5_pii.personal_data(empty).count() == 0


# ------------------------------------------------------------------ classifiers


def held_out_rows(spark, found, label):
    return found.join(shared.table(spark, "/root/testdata/sf0.1", "labels").select("doc_id", F.col(label).alias("y")), "doc_id").where(
        "held_out"
    )


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs = shared.table(spark, sf, "documents")
    found = op7_toxicity.toxicity(docs, shared.table(spark, sf, "labels"))
    rows = held_out_rows(spark, found, "toxic").collect()
    toxic, clean = ([r["predicted"] for r in rows if r["y"] == y] for y in (1, 0))
    assert sum(toxic) >= 0.7 * len(toxic) and sum(clean) <= 0.04 * len(clean)


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    found = op9_nbsvm.quality(shared.table(spark, sf, "documents"), shared.table(spark, sf, "labels"))
    rows = held_out_rows(spark, found, "quality").collect()
    assert sum(r["predicted"] == r["y"] for r in rows) >= 0.98 * len(rows)


def test_scores_are_those_of_the_models(small, labels):
    """Both classifiers' scores, recomputed text by text from the trained model alone."""
    rows = [r["text"] or "" for r in small.orderBy("doc_id").collect()]
    model = op7_toxicity.train(small, labels)
    ordinary, toxic = op7_toxicity.compressor(model.ordinary), op7_toxicity.compressor(model.toxic)
    low, high = op7_toxicity.GAIN_LOW, op7_toxicity.GAIN_HIGH
    plain = []
    for text in rows:
        ws = text.lower().split()
        cut = [" ".join(ws[i : i + 8]).encode() for i in range(0, len(ws), 8)] or [b""]
        total = 0.0
        for window in cut:
            gain = len(ordinary.compress(window)) - len(toxic.compress(window))
            total += model.evidence[min(max(gain, low), high) - low]
        total = min(max(total, -30.0), 30.0)
        plain.append(1 / (1 + math.exp(-(model.slope * total + model.intercept))))
    got = [r["s"] for r in small.orderBy("doc_id").select(op7_toxicity.score(F.col("text"), model).alias("s")).collect()]
    assert got == pytest.approx(plain, abs=1e-9)
    other = op9_nbsvm.train(small, labels)
    plain = []
    for text in rows:
        hit = [other.weights[f] for f in op9_nbsvm.features(text) if f in other.weights]
        margin = sum(hit) / math.sqrt(len(hit) + 1) + other.bias
        plain.append(1 / (1 + math.exp(-(other.slope * margin + other.intercept))))
    got = [r["s"] for r in small.orderBy("doc_id").select(op9_nbsvm.score(F.col("text"), other).alias("s")).collect()]
    assert got == pytest.approx(plain, abs=1e-9)


def test_dual_descent_reaches_the_primal_optimum():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 5))
    signs = np.where(x[:, 0] + 0.3 * rng.normal(size=60) > 0, 1.0, -1.0)
    costs = np.full(60, 0.7)
    at = np.arange(5)
    w = op9_nbsvm.dual_coordinate_descent([(at, row) for row in x], signs, costs, 5)
    loss = lambda v: v @ v / 2 + 0.7 * (np.maximum(0, 1 - signs * (x @ v)) ** 2).sum()
    assert all(loss(w) <= loss(w + 0.01 * rng.normal(size=5)) + 1e-3 for _ in range(200))


@pytest.mark.parametrize("run", [op7_toxicity.toxicity, op9_nbsvm.quality])
def test_classifiers_on_odd_and_empty_tables(spark, odd, empty, run):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (3, 0, 1), (None, 1, 1), (4, None, None), (6, 0, 0)], none.schema)
    for labels in (none, some):
        got = run(odd, labels).collect()
        assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
        assert all(r["predicted"] == int(r["score"] >= 0.3) for r in got)
        assert run(empty, labels).count() == 0


# ------------------------------------------------------------------ pipeline


def test_pipeline_stages(spark):
    docs = shared.table(spark, SF, "documents")
    columns = docs.columns
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = shared.staged(stage(spark, docs, SF), "test")
        steps[name] = docs
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    sizes = {name: df.count() for name, df in steps.items()}
    assert 0.85 * 1_000 < sizes["toxicity"] < 1_000 and 0.8 * sizes["toxicity"] < sizes["simhash near-dedup"] < sizes["toxicity"]
    assert sizes["pii"] == sizes["simhash near-dedup"] and sizes["sentencepiece"] == sizes["mixing"]
    texts = [r[0] for r in steps["pii"].select("text").collect()]
    automaton = op5_pii.anchors()
    assert not any(op5_pii.find_spans(t, automaton) for t in texts)
    assert {r[0] for r in steps["mixing"].select("text").collect()} <= set(texts)
    assert steps["sentencepiece"].where("NOT round_trip").count() == 0


def test_pipeline_of_an_odd_table(spark, odd, empty):
    for table in (odd, empty):
        docs = table
        for _, stage in corpus_pipeline.STAGES:
            docs = shared.staged(stage(spark, docs, SF), "test-odd")
        assert docs.columns[: len(table.columns)] == table.columns
