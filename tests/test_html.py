"""Selections on an open-element stack against hand-made pages and against a
tree that is built and searched in plain Python."""

import html as entities
import random
import re

import pytest
from pyspark.sql import functions as F

from sitegauge.sources.html import IMPLIED, RANKS, VOID, Selection, decode_entities, found, select_lists, values_of

V = Selection("div", "class", "v")
CELL = Selection("div", "class", "cell zero", "contains", "a")
CASES = [
    ('Mac: <div class="v">Mac<b>Book</b> Pro</div>', V, ["Mac", " Pro"]),
    ('<div class="x cell zero"><div>n</div><a href="/1">$1</a><p><a>deep</a></p></div>', CELL, ["$1"]),
    ('<div class="cell zero"><div class="q"><a>deep</a></div><a>top</a>', CELL, ["top"]),
    ("<p>a&#8211;b &#x1F642; &amp;lt; &nope; &eacute; &#0; &#xD800; a < b</p>", Selection("p"),
     ["a–b \U0001f642 &lt; &nope; é � � a < b"]),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", Selection("li"), ["a", "b", "c", "d"]),
    ("<p>one<p>two<div>three</div>four", Selection("p"), ["one", "two"]),
    ("<p><b>bold<br><p>next", Selection("p"), ["next"]),
    ("<table><tr><td>a<td>b<table><tr><td>c</table><td>d<tr><td>e</table>", Selection("td"), ["a", "b", "c", "d", "e"]),
    ('<div class="v">a<br>b<img src="x"/>c<!-- <div class="v">z</div> -->d<script>"<div class=v>"</script>e</div>f', V,
     ["a", "b", "c", "d", "e"]),
    ('<div title="x class=v">no</div><div data-class="v">no</div><DIV ID=1 CLASS=v>yes</DIV><div class = \'v\'>also</div>', V,
     ["yes", "also"]),
    ('<div class="v"><td></div>x</td>y</div>z', V, ["y"]),
    ('<b><div class="v">x</b>y</div>z', V, ["x", "y"]),
    ('<div class="v"> <i>i</i>\n</div>', V, [" ", "\n"]),
    ('<li><a href="/1&amp;x">t</a><a>u</a><a href=/2>v</a></li>', Selection("li", child="a", take="href"), ["/1&x", "/2"]),
    ("", Selection("p"), []),
    (None, Selection("p"), None),
    ("<", Selection("p"), []),
    ("<p", Selection("p"), []),
    ("<p>" + "< " * 3000 + "</p>", Selection("p"), ["< " * 3000]),
    ('<p a="' + "y" * 200_000 + '">x</p>' + "<i>" * 200 + "<p>z", Selection("p"), ["x", "z"]),
    ("<p>" + "w " * 100_000, Selection("p"), ["w " * 100_000]),
]


def test_selections_on_ordinary_pages(spark):
    wanted = list(dict.fromkeys(s for _, s, _ in CASES))
    pages = spark.createDataFrame([(i, h) for i, (h, _, _) in enumerate(CASES)], "page_id int, html string").repartition(4)
    got = {r["page_id"]: r for r in select_lists(pages, ["page_id"], {f"s{k}": s for k, s in enumerate(wanted)}).collect()}
    for i, (h, s, want) in enumerate(CASES):
        assert got[i][f"s{wanted.index(s)}"] == want, (h or "")[:80]


def tree_of(page):
    """(name, attributes, children) tree; texts are strings."""
    rank = dict(RANKS)
    root = ("", {}, [])
    path = [root]
    for token in re.findall(r"<!--.*?-->|</?[a-z][^>]*>|(?:[^<]|<(?![a-z/!]))+", page):
        name = re.match(r"</?([a-z0-9]+)", token)
        if token.startswith("<!--"):
            path[-1][2].append(None)
        elif not name:
            path[-1][2].append(token)
        elif token[1] == "/":
            places = [i for i, e in enumerate(path) if i and e[0] == name[1]]
            if places and all(rank.get(e[0], 0) <= rank.get(name[1], 0) for e in path[places[-1] + 1:]):
                del path[places[-1]:]
        else:
            for starts, ends, shields in IMPLIED:
                if name[1] in starts:
                    for i in range(len(path) - 1, 0, -1):
                        if path[i][0] in ends:
                            del path[i:]
                            break
                        if path[i][0] in shields:
                            break
                    break
            element = (name[1], dict(re.findall(r'([a-z]+)="([^"]*)"', token)), [])
            path[-1][2].append(element)
            if name[1] not in VOID and not token.endswith("/>"):
                path.append(element)
    return root


def search(node, s, out):
    name, attributes, kids = node
    fits = name == s.tag and (s.attr is None or s.attr in attributes and (
        attributes[s.attr] == s.value if s.match == "equals" else s.value in attributes[s.attr]))
    holders = ([node] if not s.child else [k for k in kids if isinstance(k, tuple) and k[0] == s.child]) if fits else []
    found_here = []
    for holder in holders:
        if s.take:
            found_here += [(holder, -1, entities.unescape(holder[1][s.take]))] if s.take in holder[1] else []
        else:
            found_here += [(holder, i, entities.unescape(k)) for i, k in enumerate(holder[2]) if isinstance(k, str)]
    out += found_here
    for k in kids:
        if isinstance(k, tuple):
            search(k, s, out)
    return out


def in_order(root, hits):
    """Hits in document order, each once."""
    place, n = {}, 0

    def number(node):
        nonlocal n
        place[id(node), -1] = n = n + 1
        for i, k in enumerate(node[2]):
            if isinstance(k, tuple):
                number(k)
            else:
                place[id(node), i] = n = n + 1
    number(root)
    return [text for _, text in sorted((place[id(h), i], text) for h, i, text in hits)]


def test_walk_agrees_with_a_tree(spark):
    rnd = random.Random(11)
    bits = ["<div>", '<div class="v">', '<div class="v w">', "</div>", "<p>", "</p>", "<ul>", "</ul>", "<li>", "</li>", '<a href="/x">', "<a>",
            "</a>", "<b>", "</b>", "<br>", "<hr>", '<i class="v"/>', "<table>", "</table>", "<tr>", "<td>", "</td>", "<th>", "</tr>", "<!-- c -->",
            "text", " ", "&amp;", "&lt;b&gt;", " < ", "x", "<tbody>", "<span>", "</span>", "<dl>", "<dt>", "<dd>", "</dl>"]
    pages = ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 60))) for _ in range(400)]
    wanted = [V, Selection("div", "class", "v", "contains", "a"), Selection("p"), Selection("li"), Selection("li", child="a", take="href"),
              Selection("td"), Selection("td", child="b"), Selection("dd"), Selection("a"), Selection("div", child="div")]
    table = spark.createDataFrame(list(enumerate(pages)), "page_id int, html string").repartition(4)
    got = {r["page_id"]: r for r in select_lists(table, ["page_id"], {f"s{k}": s for k, s in enumerate(wanted)}).collect()}
    for i, page in enumerate(pages):
        root = tree_of(page)
        for k, s in enumerate(wanted):
            assert got[i][f"s{k}"] == in_order(root, search(root, s, [])), (page, s)


def test_one_walk_serves_all_selections(spark):
    pages = spark.createDataFrame([(1, "<p>x")], "page_id int, html string")
    lists = select_lists(pages, ["page_id"], {"a": Selection("p"), "b": Selection("a"), "c": Selection("li", child="a", take="href")})
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == plan.count("aggregate(") == 1 or plan.count("aggregate(") == 1
    assert "Python" not in plan and "Exchange" not in plan
    with pytest.raises(ValueError):
        Selection("p", "class", "v", "starts")
    assert pages.select(values_of(found("html", [Selection("P")]), [Selection("P")], 0).alias("v")).first()["v"] == ["x"]


def test_entities(spark):
    text = "&lt;&gt;&quot;&apos;&#39;&nbsp;&copy;&middot;&#x41;&#1114112;&#65&amp;amp;&&;"
    got = spark.createDataFrame([(text,), ("plain",), (None,)], "t string").select(decode_entities(F.col("t")).alias("d")).collect()
    assert [r["d"] for r in got] == ["<>\"'' ©·A�&#65&amp;&&;", "plain", None]
