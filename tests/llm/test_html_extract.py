import html
import re

from rolefeed.llm import html_extract, html_pages, queries
from tests.llm.helpers import DATA


def test_blocks_of_broken_markup():
    page = ("<p>one <b>two<br>three<p>four &amp; &lt;five&gt;&#33;</b><script>var t = '</p>';</script><!-- <p>no</p> -->"
            "<ul><li>a<li>b &nbsp; c</ul>tail<style>x{}</style><table><tr><td>x<td>y</table><div title='a > b'>in</div><p>cut <")
    assert [b.text for b in html_extract.blocks(page)] == ["one two three", "four & <five>!", "a", "b c", "tail", "x", "y", "in", "cut <"]
    assert html_extract.blocks(None) == html_extract.blocks("") == html_extract.blocks("<div></div>") == []


def test_pathological_markup_is_read_in_linear_time():
    for page in ("<a " * 20000, '<a "' * 20000, "<" * 100000, "<!--" * 20000, "<p>" * 3000, "&" * 100000, "<script>" * 5000):
        html_extract.blocks(page)


def test_held_out_labelled_pages():
    model, make = html_extract.trained(), html_pages.Maker(4242)
    right = total = 0
    for _ in range(150):
        page = html_extract.blocks(make.page())
        labels = [b.text.startswith("[[1:") for b in page]
        for b in page:
            b.text = b.text.replace("]]", "")[4:] or " "
        right += sum(a == b for a, b in zip(labels, model.decode(page)))
        total += len(labels)
    assert right / total > 0.98


def test_viterbi_against_all_labellings():
    import itertools

    model = html_extract.trained()
    page = html_extract.blocks("<nav><a>x</a></nav><article><h1>Head</h1><p>Some words here.</p></article><footer>&copy; z</footer>")
    scores = [float(model.emit[html_extract._vector(b)].sum()) for b in page]

    def total(labels):
        return (model.first[labels[0]] + sum(s for s, y in zip(scores, labels) if y)
                + sum(model.step[a, b] for a, b in zip(labels, labels[1:])))

    best = max(itertools.product((0, 1), repeat=len(page)), key=total)
    assert tuple(map(int, model.decode(page))) == best == (0, 1, 1, 0)


def test_query_gives_the_articles(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    got = queries.op6_html_extraction(spark, DATA).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id].html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(x for x in parts if x) and r.n_chars == len(r.text)


def test_edge_rows(spark):
    rows = [(1, None, "x", None), (2, "", "x", "u"), (2, "", "x", "u"), (None, "<p>Words of some length stand here, and more follow.</p>", "x", "u"),
            (3, "<article><p>" + "long text. " * 50000 + "</p></article>", "x", "u")]
    schema = "page_id long, html string, _guess string, text string"
    got = html_extract.extract(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.page_id or 0, len(r.text)) for r in got if r.page_id) == [(1, 0), (2, 0), (2, 0), (3, 549999)]
    assert html_extract.extract(spark.createDataFrame([], schema)).collect() == []


def test_head_without_end_tag():
    rest = "<title>no</title><meta charset=utf-8><style>x{}</style><script>y()</script><template><p>no</p></template>"
    for page in (f"<html><head>{rest}<body><p>one</p>two</body></html>", f"<head>{rest}<p>one</p>two", f"<head>{rest}<img src=x><p>one<p>two",
                 f"<head>{rest}one<p>two", f"<html><head>{rest}</head><body><p>one</p>two</body></html>"):
        assert [b.text for b in html_extract.blocks(page)] == ["one", "two"], page
