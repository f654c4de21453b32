import base64
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kinforge.llm.arrow_text import mix, span_hashes
from kinforge.llm import bpe, chat_format, html_extract, packing, quality_classifier, quality_rules, url_filter

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe(spark, documents, clashing, nothing, library):
    got = bpe.decode(bpe.encode(documents)).collect()
    assert len(got) == documents.count()
    for r in got:
        text = r["row"]["text"] or ""
        assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode_ordinary(text)
        assert r["n_tokens"] == len(r["ids"]) // 4
        assert bytes(r["decoded"]).decode() == text
    assert bpe.encode(nothing).count() == 0
    assert bpe.encode(clashing).select("row.*").columns == clashing.columns


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_bpe_any_text(text):
    encoding = bpe._encoding(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    ranks = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=encoding.ids, special_tokens={})
    ids = encoding.encode([text])[0]
    assert ids.tolist() == ranks.encode_ordinary(text)
    assert encoding.decode(ids.astype(np.int64)).decode() == text


def test_bpe_long_piece(library):
    encoding = bpe._encoding(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    for text in ("a" * 9000, "ab" * 3000, " " * 5000, "é" * 3000):
        assert encoding.encode([text])[0].tolist() == library.encode_ordinary(text)
    with pytest.raises(KeyError):
        encoding.decode(np.array([60_000]))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aAbB sS'td12!<|éÉßΣ한İ́\xa0 \x1c\t\n")), max_size=40))
def test_word_tokens(text):
    words = packing._words(P.path("word_bpe_49k.json"))
    assert words.encode([text.encode()])[0].tolist() == words.model.encode(text, add_special_tokens=False).ids


def check_packed(rows, texts, capacity=2048):
    model = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    bins, pieces = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for doc_id, text in texts.items():
        ids = [*model.encode(text or "", add_special_tokens=False).ids, 0]
        got = sorted(pieces[doc_id], key=lambda r: r["piece"])
        expected = [ids[a : a + capacity] for a in range(0, len(ids), capacity)]
        assert [(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got] == [(k, k * capacity, len(p), zlib.crc32(np.array(p, "<u4").tobytes())) for k, p in enumerate(expected)]
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), sum(r["length"] for r in rows)


@pytest.mark.parametrize("class_rows", [1 << 10, 20])
def test_packing(spark, documents, clashing, nothing, monkeypatch, class_rows):
    """class_rows: 20 ranks each common length in several classes."""
    monkeypatch.setattr(packing, "CLASS_ROWS", class_rows)
    once = documents.dropDuplicates(["doc_id"])
    bins, tokens = check_packed(packing.pack_documents(once).collect(), {r["doc_id"]: r["text"] for r in once.collect()})
    assert bins <= -(-tokens // 2048) * 11 // 10 + 1
    assert packing.pack_documents(documents).count() == packing.pack_documents(once).count() + 1
    assert packing.pack_documents(nothing).count() == 0
    assert packing.pack_documents(clashing).count() == packing.pack_documents(documents).count()
    empty = spark.range(500).select(F.when(F.col("id") > 9, F.col("id")).alias("doc_id"), F.lit("").alias("text"))
    assert packing.pack_documents(empty).select("sequence_id", "offset").distinct().count() == 500
    whole = packing.sequences(packing.pack_documents(once, with_ids=True)).collect()
    assert sum(len(r["ids"]) for r in whole) == 4 * tokens
    assert len(whole) == bins


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 30), max_size=20))
def test_plan(counts):
    rows = packing.plan(counts, 30)
    bins = {}
    for length, n in counts.items():
        own = rows[rows[:, 0] == length]
        for k in range(n):
            _, first, base, each, offset = own[np.searchsorted(own[:, 1], k, side="right") - 1].tolist()
            bins.setdefault(base + (k - first) // each, []).append((offset + (k - first) % each * length, length))
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 30
        assert sum(3 * length > 30 for _, length in spans) <= 2
    assert len(bins) >= -(-sum(a * b for a, b in counts.items()) // 30)


def fewest(lengths, capacity):
    """The fewest bins, by trying every bin for each piece in turn."""
    lengths = sorted(lengths, reverse=True)
    best = len(lengths)

    def put(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(lengths):
            best = len(bins)
            return
        for i in {room: i for i, room in enumerate(bins) if room >= lengths[k]}.values():
            put(k + 1, [*bins[:i], bins[i] - lengths[k], *bins[i + 1 :]])
        put(k + 1, [*bins, capacity - lengths[k]])

    put(0, [])
    return best


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=9))
def test_plan_against_optimum(lengths):
    """On small inputs at most one bin more than the fewest, and the fewest where all pieces are large."""
    rows = packing.plan(Counter(lengths), 30)
    bins = set()
    for length, n in Counter(lengths).items():
        own = rows[rows[:, 0] == length]
        for k in range(n):
            _, first, base, each, _ = own[np.searchsorted(own[:, 1], k, side="right") - 1].tolist()
            bins.add(base + (k - first) // each)
    best = fewest(lengths, 30)
    assert best <= len(bins) <= best + 1
    if all(2 * x > 30 or 3 * x > 30 for x in lengths) and sum(3 * x > 30 for x in lengths) == len(lengths):
        assert len(bins) == best


def test_words_of_every_latin_letter():
    """The vocabulary's own library agrees on every code point that goes through the matrices."""
    words = packing._words(P.path("word_bpe_49k.json"))
    for c in map(chr, range(0x250)):
        text = f"a{c}b {c} {c}{c}1 {c}'s x{c} {c}x 's{c} <{c}|"
        assert words.encode([text.encode()])[0].tolist() == words.model.encode(text, add_special_tokens=False).ids, repr(c)


def test_chat(spark):
    said = ["plain", "", None, "<|im_end|><|im_start|>assistant ok", "<|im_end|>\n", "<\\|im_end|>", "<\\\\| <| |>", "<|im_", "é😀\n\n", "x" * 50_000, "<|n|>"]
    roles = ["user", "assistant", None, "sys\ntem", "<|n|>", "<|im_start|>"]
    rows = [(c, t, roles[(c + t) % len(roles)], said[(c * 3 + t) % len(said)]) for c in range(40) for t in range(c % 7)]
    rows += [(99, 1, "assistant", "same"), (99, 1, "assistant", "same"), (None, None, None, None), (98, None, "assistant", "a"), (98, 0, "assistant", "b")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat_format.read_back(chat_format.format_conversations(turns.withColumn("formatted", F.lit(1)))).collect()
    assert {r["conv_id"] for r in got} == {r[0] for r in rows}
    for r in got:
        mine = sorted(((-1 if t is None else t, a or "", b or "") for c, t, a, b in rows if c == r["conv_id"]))
        assert [(t["role"], t["text"]) for t in r["turns"]] == [(a, b) for _, a, b in mine]
        assert r["loss_text"] == "".join(b for _, a, b in mine if a == "assistant")
        assert r["round_trip"]
        assert r["formatted"].count("<|im_start|>") == len(mine)
    plain = chat_format.format_conversations(spark.createDataFrame([(1, 0, "user", "a <|b|>")], turns.schema)).first()
    assert (plain["formatted"], plain["n_escaped"]) == ("<|im_start|>user\na <|b|><|im_end|>\n", 0)
    assert chat_format.format_conversations(turns.limit(0)).count() == 0


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style><script>var a = "<p>no</p>";</script></head><body class="home">
<header><h1>Site name</h1><a href=/>Home</a></header><nav><ul><li><a href=/a>A</a></li></ul></nav>
<div class="cookie-notice">We use cookies on this site, as all sites do, to make it better for you.</div>
%s<aside><p>An aside with quite a lot of words that look like those of any article, and more of them.</p></aside>
<div id="comments"><p>I have read this article with pleasure and would like to add a few words of my own.</p></div>
<form>Your name <input> <button>Send</button></form><footer>&copy; 2024</footer></body></html>"""
BODY = "<h2>A &amp; B</h2><p>First  paragraph with <a href=x>a link</a>\n of the&nbsp;text, as long as paragraphs are.<p>Short.<ul><li>one item<li>two items</ul><p>The <b>last</b> paragraph<br>of it.</p>"
MAIN = "A & B\nFirst paragraph with a link of the text, as long as paragraphs are.\nShort.\none item\ntwo items\nThe last paragraph of it."


@pytest.mark.parametrize("around", ["<article>%s</article>", "<main><div class='x'>%s</div></main>", "<div class='post-content'>%s</div>"])
def test_html(around):
    assert html_extract.content(PAGE % (around % BODY)) == MAIN


@pytest.mark.parametrize("wrapper", ['class="layout has-sidebar"', 'id="with-comments"', 'class="social-policy"'])
@pytest.mark.parametrize("around", ["<article>%s</article>", "<main><div class='x'>%s</div></main>", "<div class='post-content'>%s</div>"])
def test_html_marked_wrapper(wrapper, around):
    related = "<div class='related'><article><p>Another article with a few words of its own.</p></article></div>"
    assert html_extract.content(PAGE % f"<div {wrapper}>{around % BODY}</div>") == MAIN
    assert html_extract.content(f"<body><div {wrapper}><div>{around % BODY}</div></div>") == MAIN
    if "post-content" not in around:
        assert html_extract.content(PAGE % f"<div {wrapper}>{around % BODY}{related}</div>") == MAIN


def test_html_probes():
    """Text that stands in the article is kept: formulas, paragraphs of a class that holds a listed word, an article
    inside a share box; and a page of nothing but stray tags is read in one pass."""
    long = "This is one of the sentences that the article consists of, and it is long enough."
    for inside in (f"<p>{long}</p><math>E = mc2</math><p>{long}</p>", f"<p>{long}</p><p class='related-work'>Related work is told here.</p><p>{long}</p>", f"<div class='share'><p>{long}</p><p>{long}</p></div>"):
        page = f"<body><nav><a href=/>Home</a></nav><article>{inside}</article><footer>end</footer></body>"
        expected = [" ".join(x.split()) for x in re.split(r"<[^>]*>", inside) if x.strip()]
        assert html_extract.content(page) == "\n".join(expected)
        assert html_extract.content(page.replace("article", "div")).count("\n") == len(expected) - 1 or "share" in page
    form = f"<body><form id='aspnetForm'><div class='ad'>Buy this now, it is cheap.</div><main><p>{long}</p></main></form></body>"
    assert html_extract.content(form) == long
    began = time.time()
    assert html_extract.content("<div>" * 8000 + "x" + "</span>" * 8000 + "</div>" * 8000) in ("", "x")
    assert html_extract.content("<div class='ad'>" * 4000 + "<p>x" * 4000) is not None
    assert time.time() - began < 5


def without(page, names):
    return re.sub(rf"<(/?)(?:{names})>", r"<\1div>", page)


@pytest.mark.parametrize("plain", [False, True])
def test_html_learnt(spark, plain):
    """Weights learnt with the article hidden, on pages without it: all blocks are labelled rightly. Where navigation,
    footer, adverts and paragraphs are plain div elements too, the cut mends blocks whose own odds are wrong."""
    html_of = lambda page: without(page, "p|h1|nav|footer").replace(' class="ad"', "") if plain else page
    pages = [html_of(r["html"]) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    frame = spark.createDataFrame([(p,) for p in pages], "html string")
    weights = html_extract.train(frame)
    assert np.array_equal(weights, html_extract.train(frame.unionAll(frame)))
    assert np.array_equal(html_extract.train(frame.limit(0)), html_extract.PRIOR)
    right = alone = changed = mended = total = 0
    for page in pages:
        inside = [b.path.article for b in html_extract.blocks_of(page)[0]]
        blocks, elements = html_extract.blocks_of(without(page, "article"))
        odds = (html_extract.features(blocks, elements) @ weights).tolist()
        for x, o, y in zip(html_extract.labels(blocks, odds), odds, inside, strict=True):
            total, right, alone = total + 1, right + (x == y), alone + ((o > 0) == y)
            changed, mended = changed + (x != (o > 0)), mended + (x == y != (o > 0))
    if plain:
        assert right > alone
        assert mended > 0.9 * changed
    else:
        assert right == total


def test_html_cut_decides():
    """Short items and captions between paragraphs have odds of boilerplate; the cut takes them with their neighbours,
    and leaves short boilerplate alone."""
    long = "This is one of the sentences that the article consists of, and it is long enough."
    page = f"<body><div>Menu</div><nav><a href=/>Home</a></nav><div><p>{long}</p><ul><li>one</li><li>two</li><li>three</li></ul><p>{long}</p><div>Tab 1</div><p>{long}</p></div><footer>Imprint</footer></body>"
    blocks, elements = html_extract.blocks_of(page)
    odds = dict(zip((b.text for b in blocks), html_extract.features(blocks, elements) @ html_extract.PRIOR, strict=True))
    assert max(odds[x] for x in ("one", "two", "three", "Tab 1", "Menu")) < 0
    assert html_extract.content(page) == "\n".join([long, "one", "two", "three", long, "Tab 1", long])


def test_html_fit():
    """The weights are where no small step lowers the loss."""
    rng = np.random.default_rng(3)
    x = np.column_stack([np.ones(300), rng.uniform(0, 1, (300, len(html_extract.FEATURES) - 1))])
    y = (rng.uniform(0, 1, 300) < 0.4 + 0.3 * x[:, 3]).astype(float)
    loss = lambda w: np.logaddexp(0, -np.where(y > 0, 1, -1) * (x @ w)).sum() + (html_extract.PRECISION * (w - html_extract.PRIOR) ** 2).sum() / 2
    w = html_extract.fit(x, y)
    assert all(loss(w) <= loss(w + rng.normal(0, 0.01, len(w))) for _ in range(50))


def test_html_cases(spark):
    pages = [(1, "u", None), (2, None, ""), (3, "u", "<p"), (4, "u", "<script>if (a < b)"), (5, "u", "<article><p>x</p></article>"), (6, "u", "<article>" + "<p>word</p>" * 3000 + "</article>"), (7, "u", "<article>" + "y " * 200_000), (8, "u", "<article><p>&lt;a&gt; &#x41;&bogus; <!-- c --></article>")]
    pages.append(pages[4])
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit("t")).withColumn("row", F.lit("r"))
    got = {r["row"]["page_id"]: r for r in html_extract.extract(frame).collect()}
    assert [got[i]["text"] for i in (1, 2, 3, 4, 5, 8)] == ["", "", "", "", "x", "<a> A&bogus;"]
    assert got[6]["text"].count("\n") == 2999
    assert got[7]["n_chars"] == 399_999
    assert html_extract.extract(frame.limit(0)).count() == 0


def test_html_pages(spark):
    """The synthetic pages: all text of the article element, block by block, and nothing else."""
    import html

    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inside = re.search(r"<article>(.*)</article>", r["html"], re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inside)]
        assert html_extract.content(r["html"]) == "\n".join(filter(None, blocks))


def test_cut_is_minimal():
    """The cut's value equals the flow's bound on random graphs, by trying all labellings."""
    rng = random.Random(8)
    for _ in range(60):
        n = rng.randint(1, 7)
        scores = [rng.uniform(-3, 3) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 2)) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5]
        cut = html_extract.Cut(n)
        for i, s in enumerate(scores):
            cut.join(*((cut.source, i) if s > 0 else (i, cut.sink)), abs(s), 0.0)
        for a, b, w in edges:
            cut.join(a, b, w, w)
        cost = lambda x: sum(s if s > 0 and not x[i] else -s if s <= 0 and x[i] else 0 for i, s in enumerate(scores)) + sum(w for a, b, w in edges if x[a] != x[b])  # noqa: E731, B023
        assert cost(cut.source_side()) == pytest.approx(min(cost([k >> i & 1 for i in range(n)]) for k in range(1 << n)))


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def judged(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), m[2]) if m else ("", "")
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    _, rule, verdict = max(fits, default=(0, None, "block" if blocked(host) else "allow"))
    return host, path, rule, verdict


def blocked(host):
    """Whether some label, not the last, is a blocked word, or some label starts with one and a hyphen."""
    labels = host.split(".")
    return any(x.startswith(f"{w}-") or (x == w and k + 1 < len(labels)) for k, x in enumerate(labels) for w in url_filter.BLOCKED_LABELS)


def test_urls(spark):
    rng = random.Random(5)
    parts = ["com", "net", "example", "www", ".", ".", "/", "/", "en", "es", "fr", "?", "#", "://", "É", "EXAMPLE.com", "/en/", "x\n", "casino", "ads-", "bets", "xxx."]
    urls = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(400)] + ["http://" + "".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(800)]
    urls += [None, "", "http://", "http://com/", "http://xcom/", "https://a.net/es/b", "http://a.org/.example.com/en/", "http://com", "http://www.example.com/en/" + "a" * 70_000, "http://a.com/\0net/es/"]
    frame = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string").withColumn("best", F.lit(1))
    for r in url_filter.judge(frame, RULES).collect():
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == judged(urls[r["row"]["page_id"]])
    many = [(f"h{i}.com", f"/p{i}", "block") for i in range(40)]
    got = url_filter.judge(spark.createDataFrame([("http://a.h39.com/p39x",), ("http://h39.com/p3",)], "url string"), many).collect()
    assert [r["rule"] for r in got] == ["h39.com/p39", None]
    assert url_filter.judge(frame.limit(0), RULES).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("ab.*?é", max_size=5), st.text("ab/*?é", max_size=5)), min_size=1, max_size=30), st.lists(st.tuples(st.text("ab.é", max_size=7), st.text("ab/é", max_size=7)), min_size=1, max_size=8))
def test_url_globs(globs, urls):
    """The automaton against regular expressions."""
    spell = lambda glob: "".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in glob)
    automaton = url_filter.ShiftAnd(globs)
    got = automaton.fits([f".{h}\0{p}".encode() for h, p in urls])
    for k, (h, p) in enumerate(urls):
        expected = [re.fullmatch(rf"(?s)(.*\.)?{spell(a)}", h) is not None and re.match(rf"(?s){spell(b)}", p) is not None for a, b in globs]
        assert got[k].tolist() == expected, (globs, h, p)


def test_rules(spark, documents, clashing, nothing):
    got = quality_rules.judge(documents).collect()
    assert len(got) == documents.count()
    for r in got:
        text, m = r["row"]["text"] or "", r["rules"]
        words = WORD.findall(text)
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        seen = {}
        for x in windows:
            seen[x] = seen.get(x, 0) + 1
        repeated = len({i + k for i, x in enumerate(windows) if seen[x] > 1 for k in range(3)})
        lines, dup = set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                dup += line in lines
                lines.add(line)
        assert (m["n_words"], m["word_chars"], m["n_symbols"], m["n_dup_lines"], m["n_repeat_words"]) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, repeated)
        assert m["base_failed"] == (len(words) < 50 or 100 * repeated > 50 * len(words))
        assert not (m["base_failed"] and r["kept"])
    assert quality_rules.keep(nothing).count() == 0
    assert quality_rules.keep(clashing).columns == clashing.columns


def test_rules_measures(spark, library):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=P.path(quality_rules.VOCABULARY))
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(quality_rules.MULTI_VOCABULARY), "rb"))}
    multi = tiktoken.Encoding("multi", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    for r in quality_rules.judge(rows).collect():
        words = WORD.findall(r["row"]["text"])
        ids = [i for w in words for i in model.encode(w)]
        windows = [ids[max(0, min(a, len(ids) - 50)) :][:50] for a in range(0, len(ids), 50)]
        entropies = [-sum(c / len(w) * math.log2(c / len(w)) for c in Counter(w).values()) for w in windows]
        assert r["rules"]["n_tokens"] == len(ids)
        assert r["rules"]["n_tokens_multi"] == sum(len(multi.encode_ordinary(f" {w}")) for w in words)
        assert r["rules"]["token_entropy"] == pytest.approx(np.mean(entropies))
    odd = spark.createDataFrame([("🀀🀁" * 40 + " " + " ".join("🀂" * 3 + str(i) for i in range(80)),), (" ".join(f"слово{i} другое" for i in range(60)),)], "text string")
    got = {r["rules"]["script"]: r["rules"] for r in quality_rules.judge(odd).collect()}
    assert set(got) == {"other", "cyrillic"}
    assert got["other"]["byte_share"] > 0.3


def verdicts(rows):
    """What plain statistics say of judged rows of one language: doc_id to whether it is kept."""
    rows = [r for r in rows if not r["rules"]["base_failed"]]
    middle = lambda values: (sorted(math.floor(v * quality_rules.BINS) for v in values)[(len(values) + 1) // 2 - 1] + 0.5) / quality_rules.BINS
    once = list({r["row"]["text"]: r for r in rows}.values())
    weight = {"chars_per_token": lambda m: m["n_tokens"], "chars_per_token_multi": lambda m: m["n_tokens_multi"], "byte_share": lambda m: m["n_tokens"], "token_entropy": lambda m: -(-m["n_tokens"] // 50)}
    kept = {r["row"]["doc_id"]: r["rules"]["fits"] for r in rows}
    for name, floor in quality_rules.FLOORS.items():
        median = middle([r["rules"][name] for r in once])
        far = {r["row"]["doc_id"]: r["rules"][name] - median for r in rows}
        scaled = {r["row"]["doc_id"]: far[r["row"]["doc_id"]] * weight[name](r["rules"]) ** 0.5 for r in rows}
        error = max(floor, 1.4826 * middle([abs(scaled[r["row"]["doc_id"]]) for r in once])) * (1 + quality_rules.PRIOR_TEXTS / len(once)) ** 0.5
        for i, x in scaled.items():
            out = x > 6 * error if name == "byte_share" else abs(x) > 6 * error and (name == "token_entropy" or abs(far[i]) > 0.05 * median)
            kept[i] &= not out
    return kept


COMMON = [a + b for a in ("the", "of", "and", "house", "water", "little", "people", "other") for b in ("", "s", "ing", "ed", "ly")]


def odd_texts(rng):
    """For each measure texts that it alone, or nearly, finds: rare words, words of one vocabulary, bytes, few words."""
    say = lambda words, n: " ".join(rng.choice(words) for _ in range(n))
    return {
        "chars_per_token": say(["zq", "xj", "qk", "vv", "jx"] * 8 + COMMON, 300),
        "byte_share": say(["🀀🀁x"] * 12 + COMMON, 600),
        "token_entropy": " ".join(COMMON[i % 10] + " " + COMMON[int(rng.random() ** 3 * 6)] for i in range(200)),
    }


def test_rules_language_band(spark):
    """Texts of one language, some of them odd: the bands are those that plain statistics give."""
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(COMMON) for _ in range(rng.randint(60, 300))), "en") for i in range(400)]
    rows += [(1000 + 10 * k + j, text, "en") for k in range(4) for j, text in enumerate(odd_texts(rng).values())]
    rows.append(rows[0])
    got = quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    expected = verdicts(got)
    assert {r["row"]["doc_id"]: r["kept"] for r in got if not r["rules"]["base_failed"]} == expected
    assert all(expected.get(i, True) for i in range(400))
    odd = {r["row"]["doc_id"]: r for r in got if r["row"]["doc_id"] >= 1000}
    for j, name in enumerate(["chars_per_token", "byte_share", "token_entropy"]):
        for k in range(4):
            r = odd[1000 + 10 * k + j]
            assert not r["kept"]
            assert r["rules"]["base_failed"] or abs(r["errors"][name]) > 6, (name, r["errors"])


def test_rules_reject_bad_documents(spark):
    """On the labelled documents the bands reject none that is good, and each measure but the byte share some that are bad."""
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    rows = quality_rules.judge(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), carry=["doc_id"]).where("not rules.base_failed").select("row.doc_id", "errors", "kept").collect()
    assert [r for r in rows if labels.get(r["doc_id"]) == 1 and not r["kept"]] == []
    bad = [r for r in rows if labels.get(r["doc_id"]) == 0]
    assert sum(not r["kept"] for r in bad) > 0.8 * len(bad)
    for name in ("chars_per_token", "chars_per_token_multi", "token_entropy"):
        assert sum(abs(r["errors"][name]) > 6 for r in bad) > 0.25 * len(bad)


def test_rules_language_band_of_copies(spark):
    """A third of all rows being copies, or near copies, of one text rejects no other text."""
    rows = spark.read.parquet(f"{SF}/documents.parquet").where("lang = 'en'").select("doc_id", "text", "lang")
    kept = {r["row"]["doc_id"]: r["kept"] for r in quality_rules.judge(rows).collect()}
    tokens = {r["row"]["doc_id"]: r["rules"] for r in quality_rules.judge(rows).where("kept and rules.n_tokens between 300 and 900").collect()}
    low = min(tokens, key=lambda i: tokens[i]["chars_per_token"])
    text = rows.where(F.col("doc_id") == low).first()["text"]
    many = spark.range(len(kept) // 2).select(F.lit(-1).cast("long").alias("doc_id"), F.lit(text).alias("text"), F.lit("en").alias("lang"))
    near = many.withColumn("text", F.concat("text", F.lit(" "), F.monotonically_increasing_id().cast("string")))
    exact = {r["row"]["doc_id"]: r["kept"] for r in quality_rules.judge(rows.unionByName(many)).collect()}
    assert {i: k for i, k in exact.items() if i >= 0} == kept
    close = {r["row"]["doc_id"]: r["kept"] for r in quality_rules.judge(rows.unionByName(near)).collect()}
    good = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    assert not [i for i in good & set(kept) if kept[i] and not close[i]]


def test_rules_language_band_of_few(spark):
    """A language of a few texts has a band too: it rejects far junk and none of the others, and two texts pass."""
    rng = random.Random(9)
    common = [a + b for a in ("house", "water", "little", "people", "other", "garden") for b in ("", "s", "ing", "ed", "ly")]
    rows = [(i, " ".join(rng.choice(common) for _ in range(400)), "en") for i in range(30)]
    junk = (99, " ".join(rng.choice(common) if i % 2 else "".join(rng.choice("zqxjkvw") for _ in range(3)) for i in range(1500)), "en")
    judged = lambda rows: {r["row"]["doc_id"]: r for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    got = judged([*rows, junk])
    assert got[99]["rules"]["fits"]
    assert {i for i, r in got.items() if not r["kept"]} == {99}
    assert all(r["kept"] for r in judged(rows[:2]).values())


def test_classifier(spark, clashing, nothing):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    weights = quality_classifier.train(docs, labels)
    scored = quality_classifier.score(docs, weights, carry=["doc_id"]).select("row.doc_id", "score")
    held = scored.join(labels, "doc_id").where(quality_classifier.held_out(F.col("doc_id"))).collect()
    assert sum((r["score"] >= 0.7) == (r["quality"] == 1) for r in held) >= 0.9 * len(held)
    changed = labels.withColumn("quality", F.when(quality_classifier.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.array_equal(weights, quality_classifier.train(docs, changed))
    wide = quality_classifier.score(clashing, weights)
    assert wide.select("row.*").columns == clashing.columns
    assert all(0 <= r["score"] <= 1 for r in wide.collect())
    assert quality_classifier.score(nothing, weights).count() == 0
    none = quality_classifier.train(docs, labels.withColumn("quality", F.lit(None).cast("int")))
    assert {r["score"] for r in quality_classifier.score(clashing, none).collect()} == {0.5}


def plain_features(text):
    """Places and values of one text, by counting its words and pairs one by one."""
    one = lambda word: int(span_hashes(np.frombuffer(word.encode(), np.uint8), np.array([0]), np.array([len(word.encode())]))[0])
    words = [one(w) for w in WORD.findall(text or "")]
    pairs = [int(mix(np.array([(a + 0x632BE59BD9B4E019 * b) % 2**64], np.uint64))[0]) for a, b in zip(words, words[1:], strict=False)]
    counts = Counter(h >> (64 - quality_classifier.BITS) for h in words + pairs)
    size = math.sqrt(sum(counts.values()))
    return {k: math.sqrt(c) / size for k, c in sorted(counts.items())}


def plain_score(text, weights):
    total = sum(float(weights[k]) * v for k, v in plain_features(text).items()) + float(weights[-1])
    return 1 / (1 + math.exp(-total))


def test_classifier_against_plain_code(spark, documents):
    texts = [r["text"] for r in documents.collect()]
    of, place, value = quality_classifier.features(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        expected = plain_features(text)
        assert place[of == i].tolist() == list(expected)
        assert value[of == i] == pytest.approx(list(expected.values()))
    rng = random.Random(1)
    examples = [({rng.randrange(40): rng.random() for _ in range(6)}, rng.randint(0, 1)) for _ in range(60)]
    ftrl = quality_classifier.Ftrl()
    z, n, bias = Counter(), Counter(), 1 << quality_classifier.BITS

    def weight(i):
        return 0.0 if abs(z[i]) <= ftrl.l1 else -(z[i] - math.copysign(ftrl.l1, z[i])) / ((ftrl.beta + math.sqrt(n[i])) / ftrl.alpha + ftrl.l2)

    for _ in range(3):
        for x, y in examples:
            w = {i: weight(i) for i in [*x, bias]}
            gap = 1 / (1 + math.exp(-(sum(w[i] * v for i, v in x.items()) + w[bias]))) - y
            for i, v in [*x.items(), (bias, 1.0)]:
                g = gap * v
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / ftrl.alpha * w[i]
                n[i] += g * g
    got = ftrl.fit([(np.array(list(x)), np.array(list(x.values())), y) for x, y in examples], epochs=3)
    assert got[[*range(40), bias]] == pytest.approx([weight(i) for i in [*range(40), bias]], abs=1e-6)
    weights = np.random.default_rng(2).normal(0, 1, bias + 1).astype(np.float32)
    for r in quality_classifier.score(documents, weights).collect():
        assert r["score"] == pytest.approx(plain_score(r["row"]["text"], weights), abs=1e-6)


def test_classifier_edges(spark, nothing):
    rows = [(None, "bad x", "en"), (1, "good text", "en"), (1, "other", "en"), (5, "bad words", "en"), (5, "bad words", "en"), (7, None, "en"), (8, "long " * 9000 + " ".join(map(str, range(9000))), "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(None, 1), (1, 1), (1, 0), (5, 0), (7, None), (8, 1), (99, 1)], "doc_id long, quality int")
    weights = quality_classifier.train(docs, labels)
    assert np.array_equal(weights, quality_classifier.train(docs.repartition(3, "text"), labels.repartition(2)))
    kept = quality_classifier.keep(docs, labels)
    assert kept.columns == docs.columns
    assert {r["h"] for r in docs.where("doc_id is null").select(quality_classifier.held_out(F.col("doc_id")).alias("h")).collect()} == {False}
    assert quality_classifier.keep(nothing, labels).count() == quality_classifier.keep(docs, labels.limit(0)).count() == 0


def test_held_out(spark):
    got = {r["id"]: r["h"] for r in spark.range(300).select("id", quality_classifier.held_out(F.col("id")).alias("h")).collect()}
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in got.items())
