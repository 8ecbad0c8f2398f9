"""Quality rules, classifier, page text and license scan."""

import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordtide.llm import html_text, license_scan, quality_classifier, quality_rules
from tests.llm.conftest import ODD_ROWS, prose
from tests.llm.test_passages import spaced


def measured(text):
    text, words = text or "", spaced(text)
    lines, seen, dups = [line for line in text.split("\n") if spaced(line)], set(), 0
    for line in lines:
        dups += line in seen
        seen.add(line)
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    again = {k for i, t in enumerate(triples) if triples.count(t) > 1 for k in (i, i + 1, i + 2)} if len(triples) < 3000 else None
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dups, None if again is None else len(again)


def judged(rows):
    return sorted(((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in rows), key=repr)


def test_rule_counts(odd, none, documents):
    got = quality_rules.judge(odd.filter("doc_id is null or doc_id <> 9")).collect()
    assert judged(got) == sorted(((a, *measured(b)) for a, b in ODD_ROWS if a != 9), key=repr)
    assert all(r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) for r in got)
    assert all(not r["kept"] for r in got if r["base_failed"])
    assert quality_rules.judge(none).count() == 0
    some = documents.filter("doc_id % 5 = 0")
    rows = [(r["doc_id"], r["text"]) for r in some.collect() if len(spaced(r["text"])) < 800]
    wanted = {a for a, _ in rows}
    assert judged(r for r in quality_rules.judge(some).collect() if r["doc_id"] in wanted) == sorted(((a, *measured(b)) for a, b in rows), key=repr)


def test_rules_against_labels(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged_ = quality_rules.judge(documents).filter("not base_failed").join(labels, "doc_id")
    assert judged_.filter("kept <> (quality = 1)").count() == 0


def test_kept_rows_have_all_their_columns(odd, none):
    kept = quality_rules.keep_good(odd)
    assert kept.schema.names == odd.schema.names and quality_rules.keep_good(none).schema.names == odd.schema.names
    good = {r["doc_id"] for r in quality_rules.judge(odd).filter("kept").collect()}
    assert {r["doc_id"] for r in kept.collect()} == good and {1, 2, 3} <= good


def test_classifier_on_the_held_out_fold(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality_classifier.train(documents, labels)
    scored = quality_classifier.score(documents, model)
    assert scored.count() == 1000 and scored.filter("score < 0 or score > 1 or score is null").count() == 0
    assert scored.filter("held_out <> (crc32(cast(doc_id AS string)) % 4 = 2)").count() == 0
    rows = scored.filter("held_out").join(labels, "doc_id").select("score", "quality", "predicted").collect()
    good, bad = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert np.mean([x > y for x in good for y in bad]) > 0.95 and np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.93
    # Labels of the held-out fold and labels of zero change nothing but the prior.
    turned = labels.withColumn("quality", F.when(quality_classifier.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = quality_classifier.train(documents, turned)
    assert other.prior == model.prior and all((a == b).all() for a, b in zip(other.weights, model.weights))


def test_classifier_on_odd_rows(spark, odd, none, documents):
    labels = spark.createDataFrame([(1, 1), (2, 1), (2, 0), (3, None), (None, 1), (99, 1), (8, 0)], "doc_id long, quality int").selectExpr("*", "'x' AS text")
    model = quality_classifier.train(odd, labels)
    scored = quality_classifier.score(odd, model)
    assert scored.count() == len(ODD_ROWS) and scored.filter("score between 0 and 1").count() == len(ODD_ROWS)
    assert scored.filter("doc_id is null and held_out").count() == 0
    assert quality_classifier.score(none, model).count() == 0
    blank = quality_classifier.train(odd, labels.filter("1 = 0"))
    assert {r["score"] for r in quality_classifier.score(odd, blank).collect()} == {0.5}
    assert quality_classifier.train(none, labels).weights == ()


def test_the_risk_is_non_negative_learning():
    draw = np.random.default_rng(0)
    positive = draw.normal(1.5, 1, (600, 14))
    mixed = np.concatenate((draw.normal(1.5, 1, (700, 14)), draw.normal(-1.5, 1, (300, 14))))
    model = quality_classifier.fit(positive, mixed, 0.7)
    scores = model.scores(mixed)
    assert (scores[:700] > 0.7).mean() > 0.95 and (scores[700:] < 0.3).mean() > 0.95


LONG = "This is a long sentence of the main text, with a comma. " * 6
PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a='</p>';</script></head><body><header><h1>Site</h1></header>"
    "<nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav><div class='cookie-banner'>We use cookies to improve this site.</div>"
    "<div id=ad-1 class=x>Buy now, cheap cheap cheap.</div>{}<aside>Side</aside><form><label>Mail</label><input></form>"
    "<section class=\"comments list\"><p>" + "Reader says hi. " * 30 + "</p></section><footer>&copy; Site</footer></body></html>"
)


@pytest.mark.parametrize(
    ("body", "text"),
    [
        ("<main><h1>Title</h1><p>" + LONG + "</p><p>Short.</p></main>", "Title " + LONG + "Short."),
        ("<article><h1>A &amp; B</h1><p><b>" + LONG + "<br><p>C<i>D</i>\n\t E&nbsp;F&#x21;</article>", "A & B " + LONG + "CD E F!"),
        ("<div><div><p>" + LONG + "</p><aside>no</aside><p>a <a href=x>link</a></p></div></div>", LONG + "a link"),
        ("<table><tr><td><a href=1>m</a><a href=2>n</a><td><p>" + LONG + "<p>two</table>", LONG + "two"),
        ("<article><p>" + LONG + "</p></article><article><p>" + LONG + "</p></article>", (LONG + LONG).strip()),
        ("<article><!-- <p>no</p> --><p>1 < 2 <script>x</script>" + LONG + "</article>", "1 < 2 " + LONG.strip()),
        ("", ""),
    ],
)
def test_main_text(body, text):
    assert html_text.main_text(PAGE.format(body)) == text.strip()


def sentences(k, size):
    return (f"Part {k} has words, " * size)[: size - 1].strip() + "."


@pytest.mark.parametrize("holder", ["article", "main", "div"])
def test_the_whole_article_is_kept(holder):
    paragraphs = "".join(f"<p>{sentences(k, 400)}</p>" for k in range(10))
    parts = [
        f"<h1>Title</h1>{''.join(f'<p>{sentences(k, 300)}</p>' for k in range(3))}<ul>{''.join(f'<li>{sentences(k, 40)}</li>' for k in range(50))}</ul>",
        f"<h1>Title</h1><p>{sentences(50, 400)}</p><section>{paragraphs}</section><section><p>{sentences(60, 400)}</p><p>{sentences(61, 400)}</p></section>",
        f"<h1><a href=/x>Title</a></h1><p>Lead.</p><table>{''.join(f'<tr><td>{sentences(k, 90)}<td>{k}' for k in range(30))}</table><pre>code</pre>",
    ]
    for part in parts:
        expected = " ".join(re.sub(r"<[^>]*>", " ", part).split())
        assert html_text.main_text(PAGE.format(f"<{holder}>{part}</{holder}>")) == expected


@pytest.mark.parametrize(
    "names",
    ["class='content with-sidebar'", "class='layout no-sidebar'", "class='post comments-open'", "id='discussion-article'", "class='entry share-enabled'", "class=sidebar-layout id=widget"],
)
def test_names_of_states_remove_no_article(names):
    text = "".join(f"<p>{LONG}</p>" for _ in range(4))
    for page in (f"<div {names}><h1>Title</h1>{text}</div>", f"<article {names}><h1>Title</h1>{text}</article>"):
        assert html_text.main_text(PAGE.format(page)) == "Title " + (LONG * 4).strip()
    for name in ("site-footer", "main-nav", "cookie-banner", "ad_1", "comments"):
        assert html_text.main_text(PAGE.format(f"<article><p>{LONG}</p><div class='x {name}'>no</div></article>")) == LONG.strip()


def test_main_text_of_broken_pages():
    for page in ("<", "<a href=\"x", "<p", "</", "<script>x", "<p>a<!-- b", "<div>" * 3000 + "x", "</p></p>", "&", "<a b='" * 500, "<p><li></div>", "\0"):
        assert isinstance(html_text.main_text(page), str)
    assert html_text.main_text("<p>a<!-- b") == "a" and html_text.main_text("<div>" * 3000 + "x") == "x"


def test_pages(spark):
    import html

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = {r["page_id"]: r for r in html_text.extract(pages).collect()}
    for r in pages.collect():
        article = re.search(r"(?s)<article>(.*?)(</article>|$)", r["html"])[1]
        article = re.sub(r"<[^>]*>", "", re.sub(r"(?i)</?(p|h1|br)[^>]*>", " ", article))
        expected = " ".join(html.unescape(article).split())
        assert (rows[r["page_id"]]["text"], rows[r["page_id"]]["n_chars"], rows[r["page_id"]]["url"]) == (expected, len(expected), r["url"])
    odd = spark.createDataFrame([(1, None, None), (None, "u", ""), (2, "u", PAGE.format("<p>" + LONG * 3000)), (2, "u", "<p>x")], "page_id long, url string, html string")
    odd = odd.selectExpr("*", "'t' AS text", "1 AS n_chars")
    got = {(r["page_id"], r["n_chars"]) for r in html_text.extract(odd).collect()}
    assert got == {(1, 0), (None, 0), (2, len((LONG * 3000).strip())), (2, 1)}
    assert html_text.extract(odd.filter("1 = 0")).count() == 0


def common_length(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = max(table[i][j + 1], table[i + 1][j], table[i][j] + (x == y))
    return table[-1][-1]


def test_alignment_is_the_longest_common_subsequence():
    choose = random.Random(5)
    for _ in range(600):
        a, b = ([choose.choice([b"a", b"b", b"c", b"d"]) for _ in range(choose.randint(1, n))] for n in (14, 10))
        common, begin, end = license_scan.align(a, b, -6, 6)
        assert common == common_length(a, b) and common_length(a, b[begin:end]) == common


def test_licenses_are_found_where_they_are():
    index, choose = license_scan.Index(license_scan.TEMPLATES), random.Random(6)
    for name, template in license_scan.TEMPLATES.items():
        words = template.split()
        at_word = [k for k, word in enumerate(words) if word.isalpha()]  # numbers tell versions apart
        for k in choose.sample(at_word, len(words) // 15):
            words[k] = choose.choice(["x", "foo bar", ""])
        before, after = prose(1, 200), prose(2, choose.randint(0, 300))
        text = f"{before} {' '.join(words)} {after}"
        found = license_scan.matches(index, text.encode())
        assert [m[0] for m in found] == [name] and abs(found[0][1] - 200) <= 3
        twice = license_scan.matches(index, f"{text} {text}".encode())
        assert [m[0] for m in twice] == [name, name] and twice[0][2] <= twice[1][1]
    assert license_scan.matches(index, prose(3, 5000).encode()) == []


def test_statements_close_together_are_all_found():
    index = license_scan.Index(license_scan.TEMPLATES)
    for gap in range(0, 9):
        for times in (2, 7, 60):
            text = "\n".join(f"{' '.join(f'lib{n}x{k}' for k in range(gap))} Released under the MIT License." for n in range(times))
            found = license_scan.matches(index, text.encode())
            assert [m[:4] for m in found] == [("MIT-line", (gap + 5) * n + gap, (gap + 5) * (n + 1), 5) for n in range(times)]
    line = "is licensed under the GNU General Public License, version"
    two = license_scan.matches(index, f"This work {line} x. This x {line} 3. x work {line} 3.".encode())
    assert [m[1:4] for m in two] == [(0, 11, 11), (12, 24, 11), (25, 36, 11)]
    three = license_scan.TEMPLATES["BSD-3-Clause"]
    assert [m[0] for m in license_scan.matches(index, f"{prose(1, 40)} {three} {prose(2, 40)}".encode())] == ["BSD-3-Clause"]
    assert [m[0] for m in license_scan.matches(index, license_scan.TEMPLATES["BSD-2-Clause"].encode())] == ["BSD-2-Clause"]


def test_license_scan(spark, odd, none, documents):
    lines = ("Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "General Public License, version 3.", "the Apache License, Version 2.0.")
    expected = {(r["doc_id"]) for r in documents.collect() if any(line in r["text"] for line in lines)}
    assert {r["doc_id"] for r in license_scan.scan(documents).filter("coverage = 1").collect()} == expected and expected
    assert license_scan.scan(odd).count() == license_scan.scan(none).count() == 0
    assert license_scan.scan(odd, {"short": prose(3, 120), "empty": ""}).filter("license = 'short'").select("doc_id").distinct().count() == 2


_PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*+)((?>[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/<>]*+)([^<>]*+)>", re.DOTALL
)


def test_tags_are_found_as_by_plain_search():
    """The reader that never looks twice for the end of a tag finds what the plain pattern finds, on pages of any pieces."""
    choose = random.Random(7)
    pieces = ["<", "</", ">", '"', "'", "/", " ", "a", "<p>", '<div class="x">', "</div>", "<!--", "-->", "<!x", "<?", "=", "\n", "<b", '<a href="', "<a href='q'>"]
    for _ in range(3000):
        page = "".join(choose.choice(pieces) for _ in range(choose.randrange(25)))
        want = [(m.start(), m.end(), *((g or "") for g in (m.group(1, 2, 3) if m.group(2) else m.group(4, 5, 6)))) for m in _PIECE.finditer(page)]
        assert list(html_text.tokens(page)) == want, page


@pytest.mark.parametrize("piece", ['<a href="', "<a", "<a/", "<a '", '<a<b "'])
def test_pages_of_unclosed_tags_take_no_square_time(piece):
    start = time.process_time()
    html_text.parse("<p>x</p>" + piece * 50_000)
    assert time.process_time() - start < 5  # by plain search: minutes
