import time

import pytest
from lexforge import cases
from lexforge.functions import com_units, html_units as H, markdown_units as M, recitals as R, splitter as S, tree, translation as X
from lexforge.functions.quality import repetition
from lexforge.sources import catalogue as C, pdf
from lexforge.sources.config import Config, ConfigError


def brief(us, *fields):
    return [tuple(u[f] for f in fields) for u in us]


READ = {"case_html": H.act_units, "case_markdown": M.markdown_units, "case_com_pages": com_units.com_units, "case_com_texts": com_units.text_units}
PAGES = [(q, k) for q, (pages, _) in cases.PAGES.items() for k in pages]


@pytest.mark.parametrize(("group", "name"), PAGES, ids=[f"{q}: {k}" for q, k in PAGES])
def test_pages(group, name):
    page, want = cases.PAGES[group][0][name]
    read = next(f for k, f in READ.items() if group.startswith(k))
    assert brief(read(page), *cases.FIELDS) == want


@pytest.mark.parametrize("name", cases.SPLIT)
def test_split_article(name):
    granularity, sub, title, parts, want = cases.SPLIT[name]
    assert brief(S.split_article(parts, "5", title, granularity, sub), *cases.FIELDS) == want


def test_switches_and_empty_pages():
    assert H.act_units("<p>x</p>", recitals=False, articles=False, annexes=False) == []
    assert brief(H.act_units("<p>only <b>text</b>"), "type", "text") == [("body", "only text")]
    assert H.act_units("") == [] and M.markdown_units("") == [] and com_units.text_units(" ") == []
    page = cases.HTML_CLASS["whereas is counted"][0]
    assert {u["type"] for u in H.act_units(page, recitals=False)} == {"article", "annex"}
    assert S.quoted_regions("known as: ‘Plus’ and so") == [(10, 16)] and S.quoted_regions("reads: ‘no end") == [(7, 14)]


def test_well_formed_pages_are_read_as_xml():
    page = '<?xml version="1.0"?><html xmlns="http://www.w3.org/1999/xhtml"><body><P class="a">one<b>two</b>three<p>in</p></P><p>last</p></body></html>'
    root = tree.parse(page)
    assert [(n.tag, n.text()) for n in root.find("p")] == [("p", "one two three in"), ("p", "in"), ("p", "last")] and root.find("p")[0].cls == "a"
    assert [n.text() for n in tree.leaf_paragraphs(root)] == ["in", "last"]
    assert [n.text() for n in tree.parse(page.replace("</body>", "&nbsp;</body>")).find("p")] == ["one two three", "in", "last"]  # not XML: a p ends another one


def test_tree_is_tolerant():
    b = tree.blocks("<p>a<p>b<i>c</i><table><tr><td>1<td>2<tr><td>3</table><script></p></script>")
    assert [x[4] for x in b] == ["p", "p", "i", "table", "tr", "td", "td", "tr", "td", "script"]
    assert tree.full_text(tree.parse('<p class="hd-date">no</p><p>yes&nbsp;&amp; so</p>')) == "yes & so"
    assert tree.table_text(tree.parse("<table><tr><td>a</td><td>b</td></tr><tr><td></td></tr></table>").children[0]) == "a | b"


def test_text_layer():
    a, l = [S.unit("article", "1", "one")], [S.unit("article", "1", "eins"), S.unit("article", "2", "zwei und mehr")]
    assert brief(M.merge_text_layer(a, l), "number", "text") == [("1", "one"), ("2", "zwei und mehr")]
    assert M.merge_text_layer(a, l[1:]) == a
    assert M.sanitise_recovered("The levy is ten. Having regard to the Treaty, more") == "The levy is ten."
    assert M.sanitise_recovered("The levy is ten. 12. 80 Official Journal of the European Communities No L 4/5 more") == "The levy is ten."
    assert M.sanitise_recovered("The levy is ten. (2) OJ No L 4, p. 1") == "The levy is ten." and M.sanitise_recovered("12. 80") == ""


def test_lines_that_are_references():
    assert R.article_head("Article 4 of it") == ("4", "of it") and R.article_head("Article 4a Scope") == ("4a", "Scope") and R.article_head("Article of faith") is None and R.article_head("Articles 1 and 2") is None
    assert R.reference("of it") and R.reference("(2) and") and R.reference("To that end") and not R.reference("Officers")
    assert not R.refers("In order to") and not R.refers("To that end") and R.refers("of the act") and R.refers("thereof.") and not R.refers("official aid")
    assert R.cites("OJ No L 3, p. 1") and R.cites("[1974] ECR 837.") and not R.cites("Case law says")


def test_recital_rules():
    rows = [(1, "a"), (2, "b"), (1, "x"), (2, "y"), (3, "c")]
    assert [t for _, t in R.drop_restarts(rows)] == ["a", "b", "c"]
    assert R.sequence_ok(["sole"]) and R.sequence_ok(["1", "1a", "2"]) and not R.sequence_ok(["1", "3"])
    assert R.recital("1", "(1)", 3) is None and R.credible_from([(3, "abc"), (4, "abd")]) == 3 and R.credible_from([(1, "abc")]) is None


def test_translation_rules():
    ws = str.split
    assert [len(c.split()) for c in X.chunks(" ".join(["w"] * 1205), ws)] == [480, 480, 245]
    assert X.issue("short text here now", "word " * 20) == "repetitive_output"
    assert X.issue("some words in a sentence", "other words in a sentence") is None
    assert X.translate_text("a b c", ws, lambda ts, strict: [t.upper() for t in ts]) == ("A B C", None)
    assert X.translate_text("a b c", ws, lambda ts, strict: ["" for _ in ts]) == (None, "empty_output")
    assert X.translate_lines("a\n\n(1) OJ L 1\nb", lambda x: f"[{x}]") == "[a]\n\n(1) OJ L 1\n[b]"
    assert not repetition([], ["a"] * 9) and repetition([], ["a"] * 10)


def test_config():
    ok = {"data": {"mode": "fixed", "celex_ids": [" 32016r0679 "]}}
    assert Config.of(ok).data.celex_ids == ["32016R0679"] and len(Config.of(ok).digest()) == 64
    for bad in ({"data": {"mode": "fixed"}}, {"data": {"mode": "fixed", "celex_ids": ["x"]}}, ok | {"extra": 1}, ok | {"processing": {"limit": -1}}, {"data": {"mode": "descriptive", "document_types": ["regulation"], "start_date": "2020-01-02", "end_date": "2020-01-01"}}):
        with pytest.raises(ConfigError):
            Config.of(bad)


def test_catalogue_rules():
    page = b'<ul><li title="item"><a href="u1">x</a><ul><li title="stream_name">L_ANNEX.html</li><li title="stream_order">1</li></ul></li><li title="item"><a href="u2">y</a><ul><li title="stream_name">L_ACT.html</li><li title="stream_order">2</li></ul></li></ul>'
    assert C.pick_choice(C.parse_choices(page)) == "u2" and C.pick_choice([]) is None
    assert [C.classify(*x) for x in ((200, b"x"), (200, b""), (403, b""), (429, b""), (None, b""), (410, b"x"), (300, b""))] == ["ok", "missing", "missing", "transient", "transient", "unavailable", "choices"]
    assert C.complete([{"data_type": "zz_complete_eurovoc"}], ["eurovoc"]) and not C.complete([], ["eurovoc"])
    with pytest.raises(C.TransientError):
        C.bindings([])
    assert pdf.to_markdown(b"%PDF-", lambda b: "", lambda b: "text") == ("text", "text_layer", "empty", None)
    assert pdf.to_markdown(b"%PDF-", None, None)[1:3] == ("none", "startup")


def test_pdf_readers_in_a_child():
    import os

    def reader():
        def read(c):
            if c == b"hang":
                time.sleep(60)
            if c == b"die":
                os._exit(3)
            if c == b"bad":
                raise ValueError("no pages")
            return c.decode() + " read"

        return read

    child = pdf.Child(reader, seconds=0.5)
    layer = lambda c: "layer"
    began = time.monotonic()
    got = [pdf.to_markdown(c, child, layer)[:3] for c in (b"a", b"hang", b"b", b"die", b"bad", b"c")]
    child.close()
    assert got == [("a read", "layout", None), ("layer", "text_layer", "timeout"), ("b read", "layout", None), ("layer", "text_layer", "conversion"), ("layer", "text_layer", "conversion"), ("c read", "layout", None)]
    assert time.monotonic() - began < 20
    starts = []

    def broken():
        raise OSError("no model")

    child = pdf.Child(broken)
    for _ in range(5):
        starts.append(pdf.to_markdown(b"x", child, None))
    assert child.given_up and starts == [(None, "none", "startup", "no model")] * 5
    slow = pdf.Child(lambda: time.sleep(60), start_seconds=0.2)
    assert pdf.to_markdown(b"x", slow, None)[2:] == ("startup", "timeout")
