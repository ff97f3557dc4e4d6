"""URL filter, license scan, HTML extraction and quality classifier."""

import re

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
from staylytics.llm import html_extract, license_scan, quality, text, url_filter
from staylytics.llm.queries import URL_RULES

ROOT = "/root/testdata/sf0.01"


def test_word_hashes_follow_the_words():
    texts = ["Aa b\tC", None, "", "  ", "b C", "é\x0bÉ b", "x" * 70_000 + " b"]
    seen = {}
    pattern = re.compile(r"[^\x20\x09-\x0D]+")
    for first, data, offsets in text.pieces(pa.array(texts)):
        hashed, places = text.words(data, offsets)
        for i, (a, b) in enumerate(zip(places[:-1], places[1:])):
            plain = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in texts[first + i] or "")
            found = pattern.findall(plain)
            assert len(found) == b - a
            for word, h in zip(found, hashed[a:b]):
                assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("url,host,path", [
    ("HTTP://WWW.Example.com/en/1?x#y", "www.example.com", "/en/1"), ("a://b?c/d", "b", ""), ("a://b#c/d", "b", ""), ("nothing", "", ""),
    (None, "", ""), ("", "", ""), ("a://b/c://d", "b", "/c://d"), ("://ÄB.com/", "Äb.com", "/"),
])
def test_host_and_path(spark, url, host, path):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(url,)], "url string")
    assert tuple(df.select(*url_filter.host_and_path(F.col("url"))).first()) == (host, path)


def test_url_verdicts(spark):
    pages = [(i, f"http://{w}.example.{t}/{p}/{i}", "x") for i, (w, t, p) in enumerate(
        [("good", "com", "fr"), ("bad", "com", "en"), ("www", "com", "en"), ("m", "net", "es"), ("m", "net", "fr"), ("m", "org", "de")] * 20)]
    pages += [(1000, None, "x"), (1001, "", "x"), (1002, "no host", "x"), (1003, "http://com", "x"), (1003, "http://com", "x"), (None, "http://a.com/" + "z" * 50_000, "x")]
    got = url_filter.judge(spark.createDataFrame(pages, "page_id long, url string, verdict string"), URL_RULES).collect()
    assert len(got) == len(pages)
    rules = {(r.host, r.path): r.verdict for r in URL_RULES}
    for r in got:
        fits = [(h, p) for h, p in rules if (r["host"] == h or r["host"].endswith("." + h)) and r["path"].startswith(p)]
        best = max(fits, key=lambda x: len(x[0] + x[1]), default=None)
        assert r["rule"] == (best and best[0] + best[1])
        assert r["verdict"] == rules[best] if best else r["verdict"] in ("allow", "block")
    assert {r["verdict"] for r in got if r["page_id"] in (1000, 1001)} == {"allow"}
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string"), URL_RULES).collect() == []
    alone = url_filter.judge(spark.createDataFrame([(1, "http://x.org/a")], "page_id long, url string"), URL_RULES).collect()
    assert [r["verdict"] for r in alone] == ["allow"]


def test_url_scores_do_not_depend_on_the_slices(spark, monkeypatch):
    pages = [(i, f"http://{w}.example.{t}/{p}/{i % 7}é", "x") for i, (w, t, p) in enumerate(
        [("good", "com", "fr"), ("bad", "com", "en"), ("www", "com", "en"), ("m", "net", "es"), ("m", "net", "fr"), ("m", "org", "de")] * 20)] + [(901, "", "x")]
    df = spark.createDataFrame(pages, "page_id long, url string, found string")
    judged = lambda: sorted((*r[:-1], round(r["score"], 9)) for r in url_filter.judge(df, URL_RULES).collect())
    whole = judged()
    monkeypatch.setattr(url_filter, "SLICE_KEYS", 400)
    assert judged() == whole


def brute_ratio(url, accepted, rejected):
    """The same mixture from exact dictionaries instead of hashed counters."""
    total = 0.0
    b = url.encode()
    for i in range(len(b)):
        chance = []
        for known in (rejected, accepted):
            p = 1 / 256
            for order in range(min(i, url_filter.ORDER) + 1):
                context = b[i - order : i]
                c = sum(k[j : j + order] == context for k in known for j in range(len(k) - order))
                e = sum(k[j : j + order + 1] == context + b[i : i + 1] for k in known for j in range(len(k) - order))
                p = (e + url_filter.PRIOR * p) / (c + url_filter.PRIOR)
            chance.append(p)
        total += np.log(chance[1]) - np.log(chance[0])
    return total / max(1, len(b))


def test_url_model_counts(spark):
    good, bad = ["http://abc/x", "http://abd/y"], ["http://zzz/q", "ftp://zz"]
    df = spark.createDataFrame([(u, True) for u in good] + [(u, False) for u in bad], "url string, accepted boolean")
    table = url_filter.count(df)
    asked = ["http://abz/", "", "ftp://é"]
    got = url_filter.ratios(pa.array(asked), table)
    want = [brute_ratio(u, [g.encode() for g in good], [x.encode() for x in bad]) for u in asked]
    assert np.allclose(got, want)


def test_url_model_counts_grow_with_the_urls(spark):
    rng = np.random.default_rng(5)
    urls = [("".join(map(chr, rng.integers(97, 123, 40))), bool(i % 2)) for i in range(4_000)]
    table = url_filter.count(spark.createDataFrame(urls, "url string, accepted boolean"))
    known = [{}, {}]
    for url, accepted in urls:
        for i in range(len(url)):
            for k in range(min(i, url_filter.ORDER) + 1):
                for part in ((url[i - k : i], ""), (url[i - k : i], url[i])):
                    known[accepted][part] = known[accepted].get(part, 0) + 1
    asked, want = ["".join(map(chr, rng.integers(97, 123, 30))) for _ in range(20)], []
    for url in asked:
        total = 0.0
        for i in range(len(url)):
            chance = [1 / 256, 1 / 256]
            for k in range(min(i, url_filter.ORDER) + 1):
                context = url[i - k : i]
                chance = [(known[c].get((context, url[i]), 0) + url_filter.PRIOR * chance[c]) / (known[c].get((context, ""), 0) + url_filter.PRIOR) for c in (0, 1)]
            total += np.log(chance[1]) - np.log(chance[0])
        want.append(total / len(url))
    assert len(known[0]) > 1 << 17 and np.allclose(url_filter.ratios(pa.array(asked), table), want)


def test_url_cut_with_few_distinct_urls(spark):
    for good, bad in (("good/aaaa", "evil/bbbb"), ("nice/abab", "spam/zzzz"), ("ok/one", "no/two"), ("ok/three", "no/four")):
        rows = [(i, f"http://x.{u}") for i, u in enumerate([f"com/{good}"] * 30 + [f"net/{bad}"] * 30)] + [(98, f"http://y.org/{good}"), (99, f"http://y.org/{bad}")]
        rules = [url_filter.Rule("com", "/", "allow"), url_filter.Rule("net", "/", "block")]
        got = {r["page_id"]: r["verdict"] for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
        assert (got[98], got[99]) == ("allow", "block")


def test_license_spans(spark):
    notice = "Released under the MIT License."
    docs = [
        (1, f"Étude.\n{notice} Rest", "x"), (2, "released UNDER -- the mit\n license", "x"), (3, "Licensed under the Apache License, that is, Version 2.0", "x"), (4, None, "x"),
        (5, "", "x"), (6, "license mit the under released", "x"), (7, "w " * 30_000 + notice + " w" * 10 + " " + notice, "x"), (1, f"Étude.\n{notice} Rest", "x"),
        (None, notice, "x"),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string, license string")
    got = license_scan.scan_licenses(df).collect()
    assert sorted(((r["doc_id"] or 0), r["start"], r["length"], r["coverage"]) for r in got) == [
        (0, 0, 30, 1.0), (1, 7, 30, 1.0), (1, 7, 30, 1.0), (2, 0, 34, 1.0), (3, 0, 55, 1.0), (7, 60_000, 30, 1.0), (7, 60_052, 30, 1.0)]
    assert {r["license"] for r in got} == {"MIT", "Apache-2.0"}
    assert license_scan.scan_licenses(df.limit(0)).collect() == []
    assert license_scan.scan_licenses(df, {"none": "", "long": notice * 3}).collect() == []


def test_licenses_back_to_back_and_far_from_the_letter(spark):
    mit, cc = license_scan.TEMPLATES["MIT"], license_scan.TEMPLATES["CC-BY-NC-4.0"]
    docs = [(1, "\n".join([mit] * 10)), (2, "Released under an MIT License."), (3, "Released x under x the x MIT x License"), (4, " ".join([cc] * 3)), (5, f"{mit} " * 3_000)]
    got = license_scan.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    spans = sorted((r["doc_id"], r["license"], r["start"], r["length"], r["matched"]) for r in got if r["doc_id"] < 5)
    assert spans == [*[(1, "MIT", 32 * k, 30, 5) for k in range(10)], (2, "MIT", 0, 29, 4), (3, "MIT", 0, 38, 5), *[(4, "CC-BY-NC-4.0", 29 * k, 27, 7) for k in range(3)]]
    assert [r["start"] for r in got if r["doc_id"] == 5] == [32 * k for k in range(3_000)]


def test_whole_license_texts_and_versions(spark):
    ours = license_scan.production()
    asked = ["MIT text", "BSD-3-Clause text", "ISC text", "Zlib text", "GPL-3 text", "Apache-2.0 text", "CC0-1.0 text", "GPL-2.0 header", "GPL-3.0 header", "AGPL-3.0 header",
             "LGPL-2.1 header", "EPL-2.0 header", "CC-BY-SA-4.0 header"]
    docs = [(i, f"Ours. {ours[name]} End.") for i, name in enumerate(asked)] + [(99, ours["MIT text"][:400])]
    got = license_scan.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    best = {i: {r["license"]: r["coverage"] for r in got if r["doc_id"] == i} for i, _ in docs}
    assert all(best[i][name] == 1 for i, name in enumerate(asked))
    assert best[7]["GPL-2.0 header"] > best[7].get("GPL-3.0 header", 0) and best[8]["GPL-3.0 header"] > best[8].get("GPL-2.0 header", 0)
    assert set(best[99]) == {"MIT opening"}


def test_license_alignment_against_plain_dynamic_programming():
    rng = np.random.default_rng(2)
    for _ in range(40):
        a, b = rng.integers(0, 4, 8), rng.integers(0, 4, 20)
        best, score = 0, np.zeros((9, 21))
        for i in range(8):
            for j in range(20):
                step = license_scan.MATCH if a[i] == b[j] else license_scan.OTHER
                score[i + 1, j + 1] = max(0, score[i, j] + step, score[i, j + 1] + license_scan.GAP, score[i + 1, j] + license_scan.GAP)
                best = max(best, score[i + 1, j + 1])
        assert license_scan.align(a, b, -8, 20)[0] == best


def test_winnowing_shares_a_fingerprint_in_every_run():
    rng = np.random.default_rng(8)
    for gram, window in ((2, 1), (3, 1), (3, 2), (3, 5)):
        for _ in range(60):
            run = rng.integers(0, 50, gram + window - 1).astype(np.uint64)
            a, b = (np.concatenate([rng.integers(100 * k, 100 * k + 90, rng.integers(0, 9)).astype(np.uint64), run,
                                    rng.integers(100 * k, 100 * k + 90, rng.integers(0, 9)).astype(np.uint64)]) for k in (1, 2))
            assert set(license_scan.winnowed(a, gram, window)[1].tolist()) & set(license_scan.winnowed(b, gram, window)[1].tolist())


def brute_scan(words, template, need):
    """Spans of whole scans without an index: the best alignment over all diagonals, then what is left on both sides of it."""
    out, open_ = [], [(0, len(words))]
    while open_:
        a, b = open_.pop()
        if b - a < need:
            continue
        _, equal, first, end = license_scan.align(template, words[a:b], -len(template), b - a)
        if not equal:
            continue
        if equal >= need:
            out.append((equal, a + first, a + end))
        open_ += [(a, a + first), (a + end, b)]
    return sorted(out, key=lambda m: m[1])


@pytest.mark.parametrize("seed", range(12))
def test_scans_equal_a_scan_without_index(seed):
    rng = np.random.default_rng(seed)
    names = [f"t{k}" for k in range(3)]
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 30, n)) for n in (5, 14, 40)]
    ix = license_scan.index(dict(zip(names, texts)), 0.8)
    for _ in range(12):
        parts = []
        for _ in range(rng.integers(1, 5)):
            parts += [f"z{x}" for x in rng.integers(0, 99, rng.integers(60, 90))]  # far apart, so alignments do not meet
            copy = texts[rng.integers(3)].split()
            for _ in range(rng.integers(0, 4)):
                at = int(rng.integers(len(copy)))
                copy[at : at + 1] = [[], ["q"], [copy[at], "q"]][rng.integers(3)]
            parts += copy
        parts += ["end"] * 60
        _, data, offsets = next(text.pieces(pa.array([" ".join(parts)])))
        hashed = text.terms(data, offsets)[0]
        got = license_scan.scan(hashed, ix)
        for t in range(3):
            assert sorted(m[1:] for m in got if m[0] == t) == sorted(brute_scan(hashed, ix.words[t], ix.needs[t]))


def test_every_license_line_of_the_documents_is_found(spark):
    lines = [license_scan.TEMPLATES[k] for k in ("Apache-2.0", "CC-BY-NC-4.0", "GPL-3.0", "MIT")]
    want = sorted((r["doc_id"], line) for r in spark.read.parquet(f"{ROOT}/documents.parquet").collect() for line in lines if line in r["text"])
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{ROOT}/documents.parquet").collect()}
    got = entry.queries()["op7_license_scan"](spark, ROOT).collect()
    spans = sorted((r["doc_id"], texts[r["doc_id"]][r["start"] : r["start"] + r["length"]].rstrip(".") + ".") for r in got if r["coverage"] == 1)
    assert want and set(want) <= set(spans)


PAGE = """<!doctype html><html><head><title>T</title><style>x</style></head><body class="has-sidebar"><header>Top</header><nav><ul><li>m</ul></nav>
<div class="cookie-notice">We use cookies</div><div class=ad>Buy</div>{open}<h1>Head &amp; line</h1><p>One <b>bo</b>ld&nbsp;
 word<br>next<p>Two<aside>side</aside><form><input>f</form><script>var t="</p>";</script><!-- c --><table><tr><td>a<td>b</table>
<section id="comments"><article>reader</article></section>{close}<footer>&copy; f</footer></body></html>"""
MAIN = "Head & line\nOne bold word next\nTwo\na\nb"


@pytest.mark.parametrize("open_,close", [("<article>", "</article>"), ("<main>", "</main>"), ('<div role="main">', "</div>"), ('<div id="content">', "</div>")])
def test_main_text(open_, close):
    page = PAGE.format(open=open_, close=close)
    assert html_extract.extract(page, None) == MAIN
    assert html_extract.extract(page, html_extract.induce([page])) == MAIN


def test_wrapper_drops_what_a_host_repeats():
    pages = [f"<body><div class=top>Our site</div><div class=x><p>{w} text of page {w}</p><p>{w} more {w}</p></div><div>All rights</div>" for w in "abcde"]
    wrapper = html_extract.induce(pages)
    assert html_extract.extract(pages[0], wrapper) == "a text of page a\na more a"
    assert html_extract.extract(pages[0].replace("a text", "new words"), wrapper) == "new words of page a\na more a"


def test_tree_matching():
    forest = html_extract.Forest()
    one, two = (html_extract.facts(h, forest)[1] for h in ("<body><p>a</p><div>b</div><p>c</p>", "<body><p>x</p><p>y</p>"))
    size, pairs = forest.match(one, two)
    assert size == 6 and pairs == ((0, 0),)  # root, body, two paragraphs with their texts
    assert forest.places(one, two) == [(3, True), (7, True)]
    assert forest.dump(forest.merge(two, one)) == ["#", ["body", ["p", 0], ["div", 0], ["p", 0]]]


def brute_match(a, b):
    """Size of the largest matching of two dumped trees, by trying every pairing of children."""
    if a == 0 or b == 0:
        return int(a == b)
    if a[0] != b[0]:
        return 0

    def best(x, y):
        if not x or not y:
            return 0
        return max(best(x[1:], y), best(x, y[1:]), brute_match(x[0], y[0]) + best(x[1:], y[1:]))

    return 1 + best(a[1:], b[1:])


@pytest.mark.parametrize("seed", range(30))
def test_tree_matching_equals_brute_force(seed):
    import random

    rng = random.Random(seed)

    def tree(depth):
        return 0 if not depth or rng.random() < 0.3 else [rng.choice("ab"), *(tree(depth - 1) for _ in range(rng.randint(0, 4)))]

    for _ in range(20):
        forest = html_extract.Forest()
        a, b = (["r", *(tree(3) for _ in range(rng.randint(0, 4)))] for _ in range(2))
        x, y = forest.load(a), forest.load(b)
        assert forest.match(x, y)[0] == brute_match(a, b)
        both = forest.merge(x, y)
        for part in (x, y):  # a merged tree holds each of its parts
            places = forest.places(both, part)
            assert [n for n, own in places if own] == sorted({n for n, own in places if own}) and forest.dump(x) == a


def test_shared_paragraphs_stay_and_boxes_go_at_any_number_of_pages(spark):
    box = '<div class="newsletter">Get {w} by mail</div><div class="ad">Buy {w}</div><form>Your {w} mail</form><section class="comments"><p>{w} says hi</p></section>'
    for n in (1, 2, 3, 10):
        words = [f"w{i}" for i in range(n)]
        pages = ["<article><h1>Title {w}</h1><p>{w} tells one story and then another.</p><p>This paragraph stands in every article of the site.</p>{box}</article>".format(
            w=w, box=box.format(w=w)) for w in words]
        assert extracted(spark, pages) == {
            i: f"Title {w}\n{w} tells one story and then another.\nThis paragraph stands in every article of the site." for i, w in enumerate(words)}


def test_menu_of_most_pages_goes(spark):
    menu = "<div class=top><div>Home page</div><div>Our offers</div></div>"
    pages = [f"<body>{menu if i % 5 else '<div class=top><div>Other start</div><div>Other offers</div></div>'}<div class=x><p>{'word ' * 9}{i}</p><p>more words of {i}</p></div>" for i in range(20)]
    got = extracted(spark, pages)
    assert all(got[i] == f"{'word ' * 9}{i}\nmore words of {i}" for i in range(20) if i % 5)


def test_second_paragraph_is_told_from_the_first(spark):
    """Equal paths: a constant text after a varying one stands at a node of its own."""
    pages = [f"<body><div class=x><p>{w * 30} varies</p><p>Always the same line</p><p>{w * 20} too</p></div>" for w in "abcd"]
    assert extracted(spark, pages) == {i: f"{w * 30} varies\n{w * 20} too" for i, w in enumerate("abcd")}


def test_spark_wrappers_equal_induce(spark, monkeypatch):
    import random

    monkeypatch.setattr(html_extract, "MERGED_TREES", 3)
    rng = random.Random(4)
    pages = []
    for i in range(40):
        parts = [f"<p>{rng.random()} words of page {i}</p>" for _ in range(rng.randint(1, 6))]
        parts.insert(rng.randint(0, len(parts)), "<p>Fixed line</p>")
        pages.append(f"<body><div class=h><b>Site</b> name</div><div class=x>{''.join(parts)}</div><div class=f>All rights</div>")
    got = extracted(spark, pages)
    assert all("All rights" not in t and "Site name" not in t for t in got.values())
    assert all(re.findall(r"0\.\d+ words of page \d+", got[i]) == re.findall(r"0\.\d+ words of page \d+", p) for i, p in enumerate(pages))
    wrapper = html_extract.induce(pages)
    assert [html_extract.extract(p, wrapper).split("\n")[0] for p in pages] == [got[i].split("\n")[0] for i in range(40)]


def test_html_edges(spark):
    rows = [(1, "http://a/1", None, "q"), (2, None, "", "q"), (3, "http://a/3", "<article><p>cut <b>off</b> te<st", "q"), (4, "x", "plain < text > & more", "q"),
            (5, "http://a/1", "<article>" + "<p>w</p>" * 20_000 + "</article>", "q"), (5, "http://a/1", "<p>twin</p>", "q"), (5, "http://a/1", "<p>twin</p>", "q")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((r["page_id"], r["text"], r["n_chars"]) for r in html_extract.extract_pages(df).collect())
    assert got == [(1, "", 0), (2, "", 0), (3, "cut off te", 10), (4, "plain < text > & more", 21), (5, "twin", 4), (5, "twin", 4), (5, "\n".join("w" * 20_000), 39_999)]
    assert html_extract.extract_pages(df.limit(0)).collect() == []


def test_pages_table_against_its_article_element(spark):
    import html

    got = {r["page_id"]: r["text"] for r in entry.queries()["op8_html_extract"](spark, ROOT).collect()}
    for r in spark.read.parquet(f"{ROOT}/pages.parquet").collect():
        article = re.sub(r"<[^<>]*\Z", "", re.search(r"<article>(.*?)(</article>|\Z)", r["html"], re.S)[1])
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " " if "<br>" in b else "", b)).split()) for b in re.split("</?(?:p|h1)>", article))
        assert got[r["page_id"]] == "\n".join(b for b in blocks if b)


def extracted(spark, pages):
    df = spark.createDataFrame([(i, f"http://h/{i}", h) for i, h in enumerate(pages)], "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in html_extract.extract_pages(df).collect()}


def test_template_text_inside_articles_is_dropped(spark):
    pages = [f"<article><h1>Title {w}</h1><p>{w} text of page {w} with its words</p><p>Call our shop now</p></article>" for w in "abcde"]
    want = [f"Title {w}\n{w} text of page {w} with its words" for w in "abcde"]
    assert extracted(spark, pages) == dict(enumerate(want))
    assert [html_extract.extract(p, html_extract.induce(pages)) for p in pages] == want
    copies = [f"<article><p>the same long article in all of them</p><p>{w}</p></article>" for w in "abcdefgh"]
    assert extracted(spark, copies)[0] == "the same long article in all of them\na"


def test_every_layout_and_every_size_of_page_is_aligned(spark):
    pages = []
    for k in range(5):  # five layouts of twelve pages, of which every fourth has over 400 elements
        for i in range(12):
            body = "".join(f"<p>words {j} of page {k} {i}</p>" for j in range(500 if i % 4 == 0 else 3))
            pages.append(f"<body><div class=top{'xyzuv'[k]}>Site part {k} greets you</div><div class=b>{body}</div><div>All rights {k}</div>")
    got = extracted(spark, pages)
    assert all(got[n] == "\n".join(re.findall("<p>(.*?)</p>", p)) for n, p in enumerate(pages))
    two = [f"<body><div>Our site greets you</div><div class=x><p>{w * 9} text of page {w}</p><p>{w * 8} more</p></div>" for w in "ab"]
    assert extracted(spark, two) == {0: "aaaaaaaaa text of page a\naaaaaaaa more", 1: "bbbbbbbbb text of page b\nbbbbbbbb more"}


def test_class_words_are_evidence_only(spark):
    para = "".join(f'<div class="elementor-widget-container"><p>words {k} of the text</p></div>' for k in range(4))
    text = "\n".join(f"words {k} of the text" for k in range(4))
    for page in (f"<article>{para}</article>", f'<div class="layout sidebar-right"><article>{para}</article></div>', f"<form><main>{para}</main></form>",
                 f'<div class="layout sidebar-right"><div class="ad">Buy</div>{para}</div>'):
        assert html_extract.extract(page, None) == text
        assert extracted(spark, [page]) == {0: text}
    pages = [f'<article><p>{w} is what page {w} tells us</p><div class="note">{w} notes</div><div class="alert">Call us</div><div class="share"><a>{w} {w}</a></div></article>' for w in "abc"]
    want = {i: f"{w} is what page {w} tells us\n{w} notes" for i, w in enumerate("abc")}
    assert extracted(spark, pages) == want
    assert {i: html_extract.extract(p, html_extract.induce(pages)) for i, p in enumerate(pages)} == want


def test_quality_on_held_out_rows(spark):
    got = entry.queries()["op9_quality"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 500
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95
    assert np.mean([r["predicted"] for r in rows if r["quality"] == 1]) > 0.98


def plain_leader(rows, s):
    """Follow-the-regularised-leader of one weight at a time, from its definition."""
    import math

    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= s.l1:
            return 0.0
        return -(z[i] - math.copysign(s.l1, z[i])) / ((s.beta + math.sqrt(n[i])) / s.alpha + s.l2)

    for _ in range(s.epochs):
        for places, values, y in rows:
            entries = [*zip(places, values), (1 << s.bits, 1.0)]
            p = 1 / (1 + math.exp(-sum(weight(i) * x for i, x in entries)))
            for i, x, w in [(i, x, weight(i)) for i, x in entries]:
                g = (p - y) * x
                sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / s.alpha
                z[i] = z.get(i, 0.0) + g - sigma * w
                n[i] = n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z}


def test_training_equals_a_plain_loop(spark):
    s = quality.Settings(bits=10, epochs=2)
    rng = np.random.default_rng(6)
    texts = [" ".join(f"{'good' if y else 'bad'}{x}" if rng.random() < 0.5 else f"w{x}" for x in rng.integers(0, 40, rng.integers(0, 30))) for y in [0, 1] * 40]
    rows = [(p.tolist(), v.astype(np.float32).astype(float).tolist(), k % 2) for k, (p, v) in enumerate(quality.features(pa.array(texts), s.bits))]
    want = plain_leader(rows, s)
    arrays = [(np.array(p, np.uint32), np.array(v, np.float32), y) for _ in range(s.epochs) for p, v, y in rows]
    weights, bias = quality._leader(iter(arrays), s)
    assert bias == pytest.approx(want[1 << s.bits], abs=1e-6)
    assert all(weights[i] == pytest.approx(w, abs=1e-6) for i, w in want.items() if i < 1 << s.bits) and np.count_nonzero(weights) > 50
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] * 3, "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(len(texts))], "doc_id long, quality int")
    once, thrice = (quality.fit(d, marks, None, s) for d in (docs.dropDuplicates(["doc_id"]), docs))
    assert np.array_equal(once.weights, thrice.weights) and once.bias == thrice.bias  # rows of one doc_id count once


def test_quality_edges(spark):
    docs = [(1, "good words here", "x"), (2, "BAD!! BAD!!", "x"), (3, None, "x"), (4, "", "x"), (1, "good words here", "x"), (None, "good", "x"), (5, "w " * 50_000, "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, score string")
    marks = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (None, 1), (3, None), (99, 1)], "doc_id long, quality int")
    got = quality.classify(df, marks).collect()
    assert len(got) == len(docs) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (3, 4)}) == 1
    assert {r["score"] for r in quality.classify(df, marks.limit(0)).collect()} == {0.5}
    assert quality.classify(df.limit(0), marks).collect() == []
    assert quality.keep_good(df, marks, 0.0).columns == df.columns
    assert sorted(map(repr, quality.keep_good(df, marks, 0.0).collect())) == sorted(map(repr, df.collect()))
