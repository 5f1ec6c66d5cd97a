"""Small invented pages and articles with the units that are to come out of them: the readers' contract in one place.
Tests read it, and so do the queries case_*, whose SQL is these rows as a table of values."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .functions import com_units, html_units, markdown_units, splitter
from .session import ship_package

FIELDS = ("type", "subtype", "number", "paragraph_num", "subparagraph_num", "point_letter", "title", "text")


def _u(kind: str, number: str | None, text: str, title=None, subtype=None, para=None, sub=None, point=None) -> tuple:
    return kind, subtype, number, para, sub, point, title, text


def rec(n, text, subtype=None):
    return _u("recital", n, text, subtype=subtype)


def art(n, text, title=None, **more):
    return _u("article", n, text, title, **more)


def anx(n, text, title=None):
    return _u("annex", n, text, title)


def par(n, text, title=None, subtype=None):
    return _u("paragraph", n, text, title, subtype)


SHORT = "subheading"  # of recitals of at most 30 characters


def _p(*lines: str, cls: str = "") -> str:
    return "".join(f'<p class="{cls}">{x}</p>' if cls else f"<p>{x}</p>" for x in lines)


def _only(*lines: str) -> str:
    return f'<html><body><div id="TexteOnly">{_p(*lines)}</div></body></html>'


def _body(inner: str) -> str:
    return f"<html><body>{inner}</body></html>"


def _row(*cells: str) -> str:
    return "<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"


ADOPTED = "HAS ADOPTED THIS REGULATION:"
DECIDED = "HAS ADOPTED THIS DECISION:"

HTML_STANDARD = {
    "recital and article": (
        _body('<div id="rct_1"><p>(1) The herds of the northern valleys must be counted each spring.</p></div><div id="art_1"><p>Counting starts in March.</p></div>'),
        [rec("1", "(1) The herds of the northern valleys must be counted each spring."), art("1", "Counting starts in March.")],
    ),
    "title, inserted number, sole": (
        _body('<div id="art_2a"><p class="oj-ti-art">Article 2a</p><div class="eli-title"><p>Fees</p></div><p>A fee is due.</p></div><div id="art"><p>Only this.</p></div>'),
        [art("2a", "A fee is due.", "Fees"), art("sole", "Only this.")],
    ),
    "plain divs are entered, marks are not": (
        _body('<div id="art_3"><div class="norm"><span>1.</span><div class="norm inline-element"><p>First rule.</p></div></div><p class="modref">▼M2</p><div>Loose text.</div></div>'),
        [art("3", "1. First rule. Loose text.")],
    ),
    "annex title and body": (
        _body('<div id="art_1"><p>Rule.</p></div><div id="anx_IV"><p class="oj-doc-ti">ANNEX IV</p><p class="oj-doc-ti">List of ports</p><p>Harbour A</p><p>Harbour B</p></div>'),
        [art("1", "Rule."), anx("IV", "Harbour A Harbour B", "List of ports")],
    ),
    "articles of an attachment": (
        _body('<div id="rct_1"><p>(1) The protocol ought to be signed before the winter.</p></div><div id="art_1"><p class="oj-ti-art">Article 1</p><p>It is signed.</p></div>'
              '<div id="agr_1.art_1"><p class="oj-ti-art">Article 1</p><div><p>The parties trade.</p></div></div><div id="agr_1.art_2"><p class="oj-ti-art">Article 2</p><div><p>The parties meet.</p></div></div>'),
        [rec("1", "(1) The protocol ought to be signed before the winter."), art("1", "It is signed."), art("1", "The parties trade."), art("2", "The parties meet.")],
    ),
    "note behind a recital": (
        _body('<div id="rct_7"><p>(7) Storage of salt is costly in summer. (3) OJ No L 4, 5.1.1990, p. 2.</p></div><div id="art_1"><p>Rule.</p></div>'),
        [rec("7", "(7) Storage of salt is costly in summer."), art("1", "Rule.")],
    ),
}
HTML_TABLES = {
    "rows above the operative part": (
        _body("<table>" + _row("(1)", "Wells run dry by August.") + _row("(2)", "Pumps are shared by villages.") + "</table>" + _p(DECIDED) + '<div id="art_1"><p>Pumps are lent.</p></div>'),
        [rec("1", "(1) Wells run dry by August.", SHORT), rec("2", "(2) Pumps are shared by villages."), art("1", "Pumps are lent.")],
    ),
    "a phrase that only sounds like the formula": (
        _body("<table>" + _row("(1)", "The board has adopted an earlier plan.") + "</table><table>" + _row("(2)", "A second ground is given here.") + "</table>" + _p(DECIDED) + '<div id="art_1"><p>Rule.</p></div>'),
        [rec("1", "(1) The board has adopted an earlier plan."), rec("2", "(2) A second ground is given here."), art("1", "Rule.")],
    ),
    "a list inside a recital": (
        _body("<table>" + _row("(1)", "First ground. <table>" + _row("(1)", "Proof one.") + _row("(2)", "Proof two.") + "</table>") + "</table><table>" + _row("(2)", "Second ground of the decision.") + "</table>" + _p(DECIDED) + '<div id="art_1"><p>Rule.</p></div>'),
        [rec("1", "(1) First ground. (1) Proof one. (2) Proof two."), rec("2", "(2) Second ground of the decision."), art("1", "Rule.")],
    ),
    "a list between recitals": (
        _body("".join("<table>" + _row(f"({n})", t) + "</table>" for n, t in ((1, "First ground of the decision."), (2, "Second ground of the decision."), (1, "A cited act."), (2, "Another cited act."), (3, "Third ground of the decision."))) + _p(DECIDED) + '<div id="art_1"><p>Rule.</p></div>'),
        [rec("1", "(1) First ground of the decision."), rec("2", "(2) Second ground of the decision."), rec("3", "(3) Third ground of the decision."), art("1", "Rule.")],
    ),
    "credible without classes": (
        _body(_p("Whereas:") + "<table>" + _row("(1)", "Nets tear in the spring floods.") + _row("(2)", "Boats need a new harbour wall.") + "</table>" + _p(ADOPTED, "Article 1", "Walls are built.")),
        [rec("1", "(1) Nets tear in the spring floods."), rec("2", "(2) Boats need a new harbour wall."), art("1", "Walls are built.")],
    ),
    "rows go on with paragraphs": (
        _body(_p("Whereas:", "(1) Ground one is stated in prose.", "(2) Ground two is stated in prose.") + "<table>" + _row("(3)", "Ground three is in a row.") + _row("(4)", "Ground four is in a row.") + "</table>"),
        [rec("1", "(1) Ground one is stated in prose."), rec("2", "(2) Ground two is stated in prose."), rec("3", "(3) Ground three is in a row.", SHORT), rec("4", "(4) Ground four is in a row.", SHORT)],
    ),
    "numbered columns of an annex are none": (
        _body(_p("Whereas hail has hurt the vines;", "Whereas growers ask for aid,", ADOPTED, "Article 1", "Aid is paid.", "Done at Riva, 3 May 1999.", "ANNEX") + "<table>" + _row("(1)", "Column of names.") + _row("(2)", "Column of sums.") + "</table>"),
        [rec("1", "Whereas hail has hurt the vines;"), rec("2", "Whereas growers ask for aid,", SHORT), art("1", "Aid is paid. Done at Riva, 3 May 1999."), anx(None, "")],
    ),
    "one row alone": (
        _body("<table>" + _row("<p>(1)</p>", "The only ground of this act.") + "</table>" + _p(DECIDED, "Article 1", "Rule holds.", "Done at Riva, 3 May 1999.", "ANNEX", "More words.")),
        [rec("1", "(1) The only ground of this act."), art("1", "Rule holds. Done at Riva, 3 May 1999."), anx(None, "More words.")],
    ),
    "empty cell before the number": (
        _body(_p("SUMMARY OF THE CASE") + "<table>" + _row("", "<p>(1)</p>", "<span>The firms met in secret.</span>") + "</table><table>" + _row("", "<p>(2)</p>", "<span>The firms fixed their prices.</span>") + "</table>"),
        [rec("1", "(1) The firms met in secret.", SHORT), rec("2", "(2) The firms fixed their prices.")],
    ),
}
HTML_MANUAL = {
    "second heading is the title": (
        _body(_p("Article 1", "Scope of the scheme", cls="Titrearticle") + _p("It covers all mills.", cls="Normal") + _p("Article 2", cls="Titrearticle") + _p("It starts in May.", cls="Normal") + _p("Done at Riva.", cls="Fait")),
        [art("1", "It covers all mills.", "Scope of the scheme"), art("2", "It starts in May.")],
    ),
    "title that names another article": (
        _body(_p("Article 1", "Changes to Article 9 of the Mill Act", cls="Titrearticle") + _p("They apply at once.", cls="Normal") + _p("Article 2", cls="Titrearticle") + _p("End.", cls="Normal")),
        [art("1", "They apply at once.", "Changes to Article 9 of the Mill Act"), art("2", "End.")],
    ),
    "line break, recital, annex": (
        _body('<p class="li ManualConsidrant"><span class="num">(1)</span> <span>Mills grind more than they report.</span></p><p class="Titrearticle">Article 4b<br/>Reports</p><p>Mills report each month.</p>'
              '<p class="Annexetitre">ANNEX II</p><p class="NormalCentered">Form of the report</p><p>Name, place</p>'),
        [rec("1", "(1) Mills grind more than they report."), art("4b", "Mills report each month.", "Reports"), anx("II", "Name, place", "Form of the report")],
    ),
}
HTML_CLASS = {
    "titles, blank title, sole": (
        _body(_p("Article 1", cls="ti-art") + _p("Purpose", cls="sti-art") + _p("Fish stocks are kept.", "Nets are checked.", cls="normal") + _p("Article 2", cls="ti-art") + _p(" ", cls="sti-art") + _p("Ports report.", cls="normal") + _p("Signed", cls="signatory")),
        [art("1", "Fish stocks are kept. Nets are checked.", "Purpose"), art("2", "Ports report.")],
    ),
    "title is all there is": (_body(_p("Sole Article", cls="oj-ti-art") + _p("Repealed", cls="oj-sti-art")), [art("sole", "Repealed")]),
    "recitals of all forms": (
        _body(_p("Whereas:", "(1)", "Boats go out before dawn in all weathers.", "(2) In order to save fuel, boats should sail together.", "(3) To that end, harbours should publish their tides.", "(4) of the earlier regulation on boats.", "(5) OJ No L 3, 4.1.1988, p. 1.", cls="oj-normal") + _p("Article 1", cls="oj-ti-art") + _p("Tides are published.", cls="oj-normal")),
        [rec("1", "(1) Boats go out before dawn in all weathers."), rec("2", "(2) In order to save fuel, boats should sail together."), rec("3", "(3) To that end, harbours should publish their tides."), art("1", "Tides are published.")],
    ),
    "whereas is counted": (
        _body(_p("Whereas the quota was used up by June;", "Whereas a new quota should be opened,", cls="normal") + _p("Article 1", cls="ti-art") + _p("A quota is opened.", cls="normal") + _p("ANNEX B12", cls="ti-grseq-1") + _p("Tonnes: 40", cls="normal")),
        [rec("1", "Whereas the quota was used up by June;"), rec("2", "Whereas a new quota should be opened,"), art("1", "A quota is opened."), anx(None, "Tonnes: 40", "B12")],
    ),
    "annex by its heading": (
        _body(_p("Article 1", cls="ti-art") + _p("Rule.", cls="normal") + _p("ANNEX III Prices", cls="ti-grseq-1") + _p("Wheat 10", "Rye 8", cls="normal") + _p("TITLE IV", cls="ti-grseq-1")),
        [art("1", "Rule."), anx("III", "Wheat 10 Rye 8", "Prices")],
    ),
}
HTML_CONSOLIDATED = {
    "subtitles of article and annex": (
        _body(_p("Article 1", cls="title-article-norm") + _p("Aim", cls="stitle-article-norm") + _p("▼M1", cls="modref") + _p("Bees are protected.", cls="norm") + '<div><p class="norm">Hives are marked.</p><p class="x">no</p></div>' + _p("ANNEX I", cls="title-annex-norm") + _p("Species", cls="stitle-annex-norm") + _p("Honey bee", cls="norm")),
        [art("1", "Bees are protected. Hives are marked.", "Aim"), anx("I", "Honey bee", "Species")],
    ),
    "prose that begins with annex": (
        _body(_p("Article 1", cls="title-article-norm") + _p("Annex I to this act holds from May.", "Keepers comply.", cls="norm") + _p("ANNEX I", cls="title-annex-1") + _p("Real annex.", cls="norm")),
        [art("1", "Annex I to this act holds from May. Keepers comply."), anx("I", "Real annex.")],
    ),
    "recitals": (
        _body(_p("(1) In view of the losses, aid should be paid to keepers.", "(2)", "And the aid should be paid in autumn.", "(3) thereof.", cls="norm") + _p("Article 1", cls="title-article-norm") + _p("Aid is paid.", cls="norm")),
        [rec("1", "(1) In view of the losses, aid should be paid to keepers."), rec("2", "(2) And the aid should be paid in autumn."), art("1", "Aid is paid.")],
    ),
}
HTML_TEXT_ONLY = {
    "annexes behind the signature": (
        _only(ADOPTED, "Article 1", "Rule one.", "Article 2", "Rule two.", "Done at Riva, 3 May 1999.", "For the Board", "ANNEX I", "first list", "(1) OJ No L 9, 1.2.1980, p. 3.", "ANNEX II Rates", "second list"),
        [art("1", "Rule one."), art("2", "Rule two. Done at Riva, 3 May 1999."), anx("I", "first list"), anx("II", "second list", "Rates")],
    ),
    "recitals that begin with small words": (
        _only("Whereas:", "(1) In order to save the elms, felling is watched.", "(2) To that end, each elm gets a number.", "(3) of the Elm Treaty, and so on.", "(4) And elms are counted twice a year.", ADOPTED, "Article 1", "Elms are counted."),
        [rec("1", "(1) In order to save the elms, felling is watched."), rec("2", "(2) To that end, each elm gets a number."), rec("4", "(4) And elms are counted twice a year."), art("1", "Elms are counted.")],
    ),
    "a wrapped reference is no article": (
        _only("Whereas:", "(1) The duties laid down in", "Article 4 of the Elm Act are heavy.", ADOPTED, "Article 1", "Owners shall comply with", "Article 6 to the letter.", "Article 2a", "End of it."),
        [rec("1", "(1) The duties laid down in Article 4 of the Elm Act are heavy."), art("1", "Owners shall comply with Article 6 to the letter."), art("2a", "End of it.")],
    ),
    "markers above their text": (
        _only("Whereas:", "(1)", "The first ground begins on this line.", "It goes on below.", "(2)", "The second ground is whole.", DECIDED, "Article 1", "Rule."),
        [rec("1", "(1) The first ground begins on this line. It goes on below."), rec("2", "(2) The second ground is whole."), art("1", "Rule.")],
    ),
    "marks of columns": (
        _only("Whereas:", "(1)", "Figures follow in a table.", "(1)", "(2)", "(3)", "10", "20", "(2)", "The figures are assessed here.", DECIDED, "Article 1", "Rule."),
        [rec("1", "(1) Figures follow in a table. (1) (2) (3) 10 20"), rec("2", "(2) The figures are assessed here."), art("1", "Rule.")],
    ),
    "falling marks": (
        _only("Whereas:", "(7)", "The seventh ground begins here.", "(2)+(3)", "(5)+(6)", "Values.", "(8)", "The eighth ground follows now.", DECIDED, "Article 1", "Rule."),
        [rec("7", "(7) The seventh ground begins here. (2)+(3) (5)+(6) Values."), rec("8", "(8) The eighth ground follows now."), art("1", "Rule.")],
    ),
    "plain numbers": (
        _only("Whereas:", "A. FACTS", "1 The first ground is set out here.", "More on the first.", "2 1.1. A nested label opens the second.", "3 May 1984 was the day of the count.", "3 The third ground ends the list.", DECIDED, "Article 1", "Rule."),
        [rec("1", "(1) The first ground is set out here. More on the first."), rec("2", "(2) 1.1. A nested label opens the second. 3 May 1984 was the day of the count."), rec("3", "(3) The third ground ends the list."), art("1", "Rule.")],
    ),
    "dotted topics are none": (_only("Whereas:", "1. History", "Told at length.", "2. Finding", "Told again.", DECIDED, "Article 1", "Rule."), [art("1", "Rule.")]),
    "run-on whereas": (
        _only("THE BOARD, Having regard to the pact, Whereas hail fell in May; whereas it fell again; Whereas vines were lost; Whereas aid is due, HAS DECIDED AS FOLLOWS:", "Article 1", "Aid is paid."),
        [rec("1", "Whereas hail fell in May; whereas it fell again;"), rec("2", "Whereas vines were lost;", SHORT), rec("3", "Whereas aid is due,", SHORT), art("1", "Aid is paid.")],
    ),
    "quoted articles over lines": (
        _only(ADOPTED, "Article 1", "The Elm Act is amended as follows:", "'Article 2", "New words apply.", "Article 3", "More new words apply.'.", "Article 2", "This Regulation starts in May."),
        [art("1", "The Elm Act is amended as follows: 'Article 2 New words apply. Article 3 More new words apply.'."), art("2", "This Regulation starts in May.")],
    ),
    "backtick quotes": (
        _only(DECIDED, "Article 1", "Article 2 is replaced by the following:", "'Article 2", "Malta's duties apply.`", "2. Article 3 is replaced by the following:", "'Article 3", "More duties apply.`", "Article 2", "This Decision is addressed to Malta."),
        [art("1", "Article 2 is replaced by the following: 'Article 2 Malta's duties apply.` 2. Article 3 is replaced by the following: 'Article 3 More duties apply.`"), art("2", "This Decision is addressed to Malta.")],
    ),
    "possessive before a reference": (
        _only(DECIDED, "Article 1", "The towns' Article 5 duties under the pact stay.", "Article 2", "It starts in May."),
        [art("1", "The towns' Article 5 duties under the pact stay."), art("2", "It starts in May.")],
    ),
    "text on the line of the head": (
        _only(DECIDED, "Article 1 The following aid is allowed.", "Article 2 The town shall obey.", "Article 3 This Decision starts in May."),
        [art("1", "The following aid is allowed."), art("2", "The town shall obey."), art("3", "This Decision starts in May.")],
    ),
    "chapters, captions, titles": (
        _only(ADOPTED, "CHAPTER I", "GENERAL RULES", "Article 1", "Scope", "It covers elms.", "PART I of the list stays.", "▼M3", "Article 2", "Repealed"),
        [art("1", "It covers elms. PART I of the list stays.", "Scope"), art("2", "Repealed")],
    ),
    "nested page of the old kind": (
        '<html><body><div id="TexteOnly"><p><TXT_TE><p>(2) OJ No L 198, 26.7.1988, p. 35.</p><p>Whereas salt was stored all year;</p><p>' + ADOPTED + "</p><p>Article 1 The following Article 2a is added:</p><p>'Article 2a Sums are changed.' Article 2 This Regulation starts today.</p></TXT_TE></p></div></body></html>",
        [rec("1", "Whereas salt was stored all year;"), art("1", "The following Article 2a is added: 'Article 2a Sums are changed.'"), art("2", "This Regulation starts today.")],
    ),
    "references to annexes": (
        _only(ADOPTED, "Article 1", "See below.", "Annex I to the Elm Act is kept.", "Annexes are binding.", "ANNEX", "Kept words."),
        [art("1", "See below. Annex I to the Elm Act is kept. Annexes are binding."), anx(None, "Kept words.")],
    ),
}
MARKDOWN = {
    "zone, formula, articles": (
        "Whereas:\n(1) First of the grounds;\n(2) Second of the grounds,\n" + ADOPTED + "\n## Article 1\nRule one.\nArticle\n2\nRule two.",
        [rec("1", "(1) First of the grounds;", SHORT), rec("2", "(2) Second of the grounds,", SHORT), art("1", "Rule one."), art("2", "Rule two.")],
    ),
    "counted whereas": ("Whereas prices fell;\nby a third;\nWhereas stocks grew,\n" + ADOPTED + "\nArticle 1\nRule.", [rec("1", "Whereas prices fell; by a third;"), rec("2", "Whereas stocks grew,", SHORT), art("1", "Rule.")]),
    "translated zones": ("Considering the following:\n(1) Barley is scarce this year.\n" + DECIDED + "\nArticle 1\nRule.", [rec("1", "(1) Barley is scarce this year."), art("1", "Rule.")]),
    "zone by having regard": ("Having regard to the following:\n- (1) Oats are scarce this year too.\n" + DECIDED + "\nArticle 1\nRule.", [rec("1", "- (1) Oats are scarce this year too."), art("1", "Rule.")]),
    "considering that": ("(1) Considering that rye is scarce,\n(2) Considering that hay is scarce,\n" + DECIDED + "\nArticle 1\nRule.", [rec("1", "(1) Considering that rye is scarce,"), rec("2", "(2) Considering that hay is scarce,"), art("1", "Rule.")]),
    "bare marks": ("Whereas:\n(25)\n(19)\n" + DECIDED + "\nArticle 1\nRule.", [art("1", "Rule.")]),
    "falling number goes on": (
        "Whereas:\n(1) Ground one is whole.\n(2) Ground two starts here.\n(1) of the Oat Act goes on with it.\n(3) Ground three is whole.\n" + DECIDED + "\nArticle 1\nRule.",
        [rec("1", "(1) Ground one is whole.", SHORT), rec("2", "(2) Ground two starts here. (1) of the Oat Act goes on with it."), rec("3", "(3) Ground three is whole.", SHORT), art("1", "Rule.")],
    ),
    "restart in capitals": ("Whereas:\n(7) Seventh the first time round.\n(8) Eighth the first time round.\n(7) Seventh the second time round.\n" + DECIDED + "\nArticle 1\nRule.", [rec("7", "(7) Seventh the first time round."), rec("8", "(8) Eighth the first time round."), rec("7", "(7) Seventh the second time round."), art("1", "Rule.")]),
    "fragment in counted recitals": (
        "Whereas ground one starts here\n(2) of the Oat Act; whereas it goes on;\nWhereas ground two is whole,\n" + ADOPTED + "\nArticle 1\nRule.",
        [rec("1", "Whereas ground one starts here (2) of the Oat Act; whereas it goes on;"), rec("2", "Whereas ground two is whole,", SHORT), art("1", "Rule.")],
    ),
    "small letters without a zone": ("(2) bids sent in time fill the quota; whereas the\ncut should be fixed,\n" + ADOPTED + "\nArticle 1\nRule.", [rec("2", "(2) bids sent in time fill the quota; whereas the cut should be fixed,"), art("1", "Rule.")]),
    "fragment alone": ("(2) of the Oat Act; whereas it goes on;\n" + ADOPTED + "\nArticle 1\nRule.", [art("1", "Rule.")]),
    "flattened line": (
        "Whereas the cut is right, HAVE ADOPTED THIS REGULATION: Article 1 The levy shall be ten crowns. Article 2 This Regulation shall start in May.\nThis Regulation shall be binding.",
        [rec("1", "Whereas the cut is right,", SHORT), art("1", "The levy shall be ten crowns."), art("2", "This Regulation shall start in May. This Regulation shall be binding.")],
    ),
    "head inside a line": (ADOPTED + "\nArticle 1\nOne.\nArticle 2\nTwo. Article 3 The Oat Act is repealed.\nArticle 4\nFour.", [art("1", "One."), art("2", "Two."), art("3", "The Oat Act is repealed."), art("4", "Four.")]),
    "references stay": (
        ADOPTED + "\nArticle 1 The goods listed in Article 1 (2) and Article 3 of the Oat Act are free.\nThe rule holds under Article 3 This Regulation says so.\nArticle 2\nGoods of Article 5\nof the Rye Act are not.",
        [art("1", "The goods listed in Article 1 (2) and Article 3 of the Oat Act are free. The rule holds under Article 3 This Regulation says so."), art("2", "Goods of Article 5 of the Rye Act are not.")],
    ),
    "wrapped reference before the recitals": ("Having regard to Article\n7 thereof,\nWhereas the cut is right,\n" + ADOPTED + "\nArticle 1\nRule.\nArticle 4 of the Oat Act stays.", [rec("1", "Whereas the cut is right,", SHORT), art("1", "Rule. Article 4 of the Oat Act stays.")]),
    "quoted law on one line": (ADOPTED + "\nArticle 1\nThe Oat Act is amended as follows: 'Article 2 New words apply. Article 3 More words apply.'\nArticle 2\nEnd.", [art("1", "The Oat Act is amended as follows: 'Article 2 New words apply. Article 3 More words apply.'"), art("2", "End.")]),
    "two columns": (
        "Whereas the cut is right, HAS ADOPTED THIS REGULATION: sold in bags, are set out in the list Article 1\nThe refunds on the grains\nshall apply to grains, Article 2\nThis Regulation shall start in May.",
        [rec("1", "Whereas the cut is right,", SHORT), art("1", "The refunds on the grains shall apply to grains, sold in bags, are set out in the list"), art("2", "This Regulation shall start in May.")],
    ),
    "heads inside a table": (
        DECIDED + "\nArticle 1\nArticle 1 of the old act is replaced by the following:\n'Article 1\n| Name | Town |\n| A | Riva |\n| B | Lund | Article 2 This Decision shall start today. Article 3\n| C | Bern |\nThis Decision shall be published in the Gazette.",
        [art("1", "Article 1 of the old act is replaced by the following: 'Article 1 | Name | Town | | A | Riva | | B | Lund | | C | Bern |"), art("2", "This Decision shall start today."), art("3", "This Decision shall be published in the Gazette.")],
    ),
    "annexes behind the signature": ("## Article 1\nRule.\nDone at Riva, 3 May 1999.\nFor the Board\n## ANNEX I\nlist\n(1) OJ No L 3, 4.1.1990, p. 1.\nANNEX II RATES\nrates", [art("1", "Rule. Done at Riva, 3 May 1999."), anx("I", "list"), anx("II", "rates", "RATES")]),
    "annex in many tongues": ("## Article 1\nRule.\n## ANNEXE - ANHANG - ALLEGATO - ANNEX - BILAG\n| Beef | 100 |", [art("1", "Rule."), anx(None, "| Beef | 100 |")]),
    "annex heads behind their table": ("## Article 1\nRule.\nDone at Riva, 3 May 1999.\n| Place | Tonnes |\n| North | 57 |\n## ANNEX\n## ANNEX I", [art("1", "Rule. Done at Riva, 3 May 1999."), anx("I", "| Place | Tonnes | | North | 57 |")]),
    "cover of annexes is none": ("## Article 1\nRule.\n## ANNEXES\nmore", [art("1", "Rule. ## ANNEXES more")]),
    "operative block behind the signature": ("Whereas a rule is due,\nDone at Riva, 3 May 1999.\n" + DECIDED + "\nArticle 1\nRule.\nArticle 2\nEnd.", [rec("1", "Whereas a rule is due,", SHORT), art("1", "Rule."), art("2", "End. Done at Riva, 3 May 1999.")]),
    "attachment behind the signature": ("Article 1\nRule.\nDone at Riva, 3 May 1999.\nAGREEMENT on barley\n" + DECIDED + "\nArticle 1\nOther.", [art("1", "Rule. Done at Riva, 3 May 1999.")]),
    "signature before the title": ("Done at Riva, 3 May 1999.\n## COUNCIL REGULATION No 4\nWhereas a rule is due,\n" + ADOPTED + "\nArticle 1\nRule.", [rec("1", "Whereas a rule is due,", SHORT), art("1", "Rule.")]),
}
COM_PAGES = {
    "headings, prose, table, signature, notes": (
        _body(_p("COM(2001) 5", cls="Emission") + "<table><tr><td>cover</td></tr></table>" + _p("1. Outlook", cls="li Heading1") + '<p class="Normal">Trade grows<a class="footnoteRef">3</a> slowly.</p>' + _p("1.1 Grain trade", cls="Text1") + _p("Grain is traded by sea.", cls="CommentText")
              + "<table><tr><td>a</td><td>b</td></tr><tr><td></td></tr></table>" + _p("1 2 3", cls="Figures9pRight") + _p("For the Commission", cls="Normal") + _p("A name", cls="Normal") + '<dl><dd id="footnote3"><a class="footnote">(3)</a><p>(3) See the last report.</p></dd></dl>'),
        [par("1", "Trade grows slowly.", "1. Outlook"), par("2", "Grain is traded by sea.", "1.1 Grain trade"), par("3", "a | b", "1.1 Grain trade", "table"), _u("footnote", "3", "See the last report.")],
    ),
    "prose that begins like a signature": (_body(_p("Start", cls="Heading1") + _p("The President concluded.", "The President of the Board stressed that ports should be open all year.", cls="Corps")), [par("1", "The President concluded.", "Start"), par("2", "The President of the Board stressed that ports should be open all year.", "Start")]),
    "boxes and classes of reports": (_body(_p("Lead", cls="Heading2") + '<div class="border"><p class="MBT">Boxed words.</p></div><div><p>not read</p></div>' + _p("Sized words.", cls="Text9pItalicLeft") + _p("Odd words.", cls="Unknown") + _p("More words.", cls="EEATextbody")), [par("1", "Boxed words.", "Lead"), par("2", "Sized words.", "Lead"), par("3", "More words.", "Lead")]),
    "old page": ('<html><body><div id="TexteOnly"><TXT_TE><p>BOARD OF TRADE</p><p>Riva, 4.5.1999</p><p>1. Outlook</p><p>Trade grows slowly.</p><p>GRAIN AND SALT</p><p>Salt is dear.</p><p>[1] First note.</p><p>[2] Second note.</p></TXT_TE></div></body></html>', [par("1", "Trade grows slowly.", "1. Outlook"), par("2", "Salt is dear.", "GRAIN AND SALT")]),
    "body": (_body(_p("Only words.", "And more.")), [_u("body", None, "Only words. And more.")]),
}
COM_TEXTS = {
    "cover, headings, table, noise, notes": (
        "ARCHIVES HISTORIQUES\n\n## COM (78) 761\n\n## Outlook for the grain trade\n\nTrade grows slowly.\n\n. .\n\n| a | b |\n\nGRAIN AND SALT\n\n2.1 Salt\n\nSalt is dear.\n\n( 1 ) OJ No L 3, p. 1.\n\n[2] See there.",
        [par("1", "Trade grows slowly.", "Outlook for the grain trade"), par("2", "Salt is dear.", "2.1 Salt")],
    ),
}
_AMEND = "Amendments to the Oat Act"
SPLIT = {
    # name: (granularity, subparagraphs, title, parts, units)
    "article": ("article", False, "T", ["One. ", " ", "Two."], [art("5", "One. Two.", "T")]),
    "article without parts": ("article", False, "T", [], [art("5", "", "T")]),
    "numbers": ("paragraph", False, "T", ["1. Alpha.", "2. Beta."], [art("5", "Alpha.", "T", para="1"), art("5", "Beta.", para="2")]),
    "lead": ("paragraph", False, None, ["Lead words.", "1. Alpha."], [art("5", "Lead words.", para="0"), art("5", "Alpha.", para="1")]),
    "inside a line": ("paragraph", False, None, ["1. Alpha. 2. Beta. 3a. Gamma."], [art("5", "Alpha.", para="1"), art("5", "Beta.", para="2"), art("5", "Gamma.", para="3a")]),
    "blank before the dot": ("paragraph", False, None, ["1 . Alpha.", "2 . Beta."], [art("5", "Alpha.", para="1"), art("5", "Beta.", para="2")]),
    "no number at a line start": ("paragraph", False, None, ["Alpha. 2. Beta."], [art("5", "Alpha. 2. Beta.")]),
    "quoted numbers": ("paragraph", False, None, ["1. It reads: ‘1. New. 2. Newer.’.", "2. Beta."], [art("5", "It reads: ‘1. New. 2. Newer.’.", para="1"), art("5", "Beta.", para="2")]),
    "apostrophe in a quotation": ("paragraph", False, None, ["1. It reads: ‘the towns’ duties", "2. stay’.", "3. Beta."], [art("5", "It reads: ‘the towns’ duties\n2. stay’.", para="1"), art("5", "Beta.", para="3")]),
    "quoted term": ("paragraph", False, None, ["1. Known as: ‘Plus’ and so on.", "2. Beta."], [art("5", "Known as: ‘Plus’ and so on.", para="1"), art("5", "Beta.", para="2")]),
    "no closing mark": ("paragraph", False, None, ["1. It reads: “new words", "2. run on."], [art("5", "It reads: “new words\n2. run on.", para="1")]),
    "points and tail": ("point", False, "T", ["1. Stem:", "(a) x;", "(b) y.", "Tail sentence."], [art("5", "Stem:", "T", para="1", sub="1"), art("5", "x;", para="1", sub="1", point="a"), art("5", "y.", para="1", sub="1", point="b"), art("5", "Tail sentence.", para="1", sub="2")]),
    "inserted point": ("point", False, None, ["(a) x", "(aa) y", "(b) z"], [art("5", "x", point="a"), art("5", "y", point="aa"), art("5", "z", point="b")]),
    "roman points stay": ("point", False, None, ["(a) x", "(b) y", "(i) z", "(ii) w"], [art("5", "x", point="a"), art("5", "y\n(i) z\n(ii) w", point="b")]),
    "a gap of one": ("point", False, None, ["(a) x", "(b) y", "(d) z", "(e) w"], [art("5", t, point=p) for p, t in (("a", "x"), ("b", "y"), ("d", "z"), ("e", "w"))]),
    "points that start late": ("point", False, None, ["(c) x", "(d) y"], [art("5", "(c) x\n(d) y")]),
    "one point is none": ("point", False, None, ["Stem:", "(a) x"], [art("5", "Stem:\n(a) x")]),
    "amending by title": ("paragraph", False, _AMEND, ["1. Point 3 is deleted.", "2. Point 4 is replaced by: ‘New.’."], [art("5", "Point 3 is deleted.", _AMEND, para="1", subtype="amendment_item"), art("5", "Point 4 is replaced by: ‘New.’.", para="2")]),
    "amending by two edits": ("paragraph", False, None, ["1. Point 3 is hereby deleted.", "2. Points 4 and 5 are inserted."], [art("5", "Point 3 is hereby deleted.", para="1", subtype="amendment_item"), art("5", "Points 4 and 5 are inserted.", para="2", subtype="amendment_item")]),
    "one edit is not amending": ("paragraph", False, None, ["1. Point 3 is deleted.", "2. Beta."], [art("5", "Point 3 is deleted.", para="1"), art("5", "Beta.", para="2")]),
    "amending items keep their points": ("point", False, "Modification to the Rye Act", ["1. These are deleted:", "(a) x", "(b) y"], [art("5", "These are deleted:\n(a) x\n(b) y", "Modification to the Rye Act", para="1", subtype="amendment_item")]),
    "subparagraphs": ("point", True, None, ["The first subparagraph is long enough to stand alone.", "The second subparagraph is long enough as well here."], [art("5", "The first subparagraph is long enough to stand alone.", sub="1"), art("5", "The second subparagraph is long enough as well here.", sub="2")]),
    "subparagraphs not asked for": ("point", False, None, ["The first subparagraph is long enough to stand alone.", "The second subparagraph is long enough as well here."], [art("5", "The first subparagraph is long enough to stand alone.\nThe second subparagraph is long enough as well here.")]),
}

#: Name of a query -> pages and the reader that makes a column of units of a column of pages.
PAGES: dict[str, tuple[dict, Callable[[Column], Column]]] = {
    "case_html_standard": (HTML_STANDARD, html_units.html_units),
    "case_html_tables": (HTML_TABLES, html_units.html_units),
    "case_html_manual": (HTML_MANUAL, html_units.html_units),
    "case_html_class": (HTML_CLASS, html_units.html_units),
    "case_html_consolidated": (HTML_CONSOLIDATED, html_units.html_units),
    "case_html_text_only": (HTML_TEXT_ONLY, html_units.html_units),
    "case_markdown": (MARKDOWN, markdown_units.md_units),
    "case_com_pages": (COM_PAGES, com_units.com_html_units),
    "case_com_texts": (COM_TEXTS, com_units.com_text_units),
}


def _rows(units: DataFrame) -> DataFrame:
    return units.select("case", F.posexplode("us").alias("pos", "u")).select("case", "pos", *[F.col(f"u.{f}").alias(f) for f in FIELDS])


def page_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    pages, reader = PAGES[name]

    def query(spark: SparkSession, d: str) -> DataFrame:
        ship_package(spark)
        df = spark.createDataFrame([(k, v[0]) for k, v in pages.items()], "case string, page string")
        return _rows(df.select("case", reader(F.col("page")).alias("us")))

    return query


def split_query(spark: SparkSession, d: str) -> DataFrame:
    ship_package(spark)
    parts = [
        _rows(spark.createDataFrame([(k, v[3], v[2]) for k, v in SPLIT.items() if v[:2] == mode], "case string, parts array<string>, title string")
              .select("case", splitter.split_units(F.col("parts"), F.lit("5"), F.col("title"), *mode).alias("us")))
        for mode in sorted({v[:2] for v in SPLIT.values()})
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _literal(x) -> str:
    return "null" if x is None else str(x).lower() if isinstance(x, (bool, int)) else "'" + x.replace("'", "''") + "'"


def values_sql(rows: Iterator[tuple], columns: tuple[str, ...]) -> str:
    """The rows as a query."""
    body = ",\n".join("(" + ", ".join(map(_literal, r)) + ")" for r in rows)
    return f"select * from (values\n{body}) t({', '.join(columns)})"


def _expected(cases: dict) -> Iterator[tuple]:
    return ((k, pos, *u) for k, v in cases.items() for pos, u in enumerate(v[-1]))


_COLUMNS = ('"case"', "pos", *FIELDS)
QUERIES = {name: page_query(name) for name in PAGES} | {"case_split": split_query}
SQL = {name: values_sql(_expected(pages), _COLUMNS) for name, (pages, _) in PAGES.items()} | {"case_split": values_sql(_expected(SPLIT), _COLUMNS)}
