"""Selection of texts and attributes from a table of HTML pages.

Spark's ``xpath`` functions need well-formed XML and fail on ordinary HTML
(unclosed ``<b>``/``<br>``, trap T12). Here each page is read once: a native
regular expression cuts it into tokens (tags, texts, comments), and a native
``aggregate`` walks the tokens with a stack of the open elements. All
selections of a page are answered in that one walk; no tree is kept, and no
Python runs.

Selections (:class:`Selection`), with what they mean in XPath:

* ``Selection("div", "class", "v")``: ``//div[@class="v"]/text()``
* ``Selection("div", "class", "v", "contains", child="a")``:
  ``//div[contains(@class,"v")]/a/text()``
* ``Selection("li", child="a", take="href")``: ``//li/a/@href``

Rules of the walk:

* void elements (``<br>``) and tags closed in themselves hold nothing;
* a start tag ends what it can't stand in: ``<li>`` an open ``<li>`` of the same
  list, a block an open ``<p>``, table parts their kind, and so on (``IMPLIED``);
* an end tag closes the nearest open element of its name and all in it, unless
  an element that ranks higher (``RANKS``) is open in between; else it is ignored;
* comments, declarations, scripts and style sheets hold no elements or texts;
* every text directly in a selected element is a result of its own, in
  document order, also behind child elements; children are direct ones. A
  ``<`` that begins no tag is text;
* names match in any case, attribute values quoted or not; entities are
  decoded, named (HTML 4) and numeric, unknown ones stay as written.

A null page has null results, an empty one none.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a page is cut into. Repeats are possessive, so long
# texts and tags need no stack.
TOKEN = (r"(?s)<!--.*?(?:-->|\z)"                                  # comment
         r"|<(?i:script|style)\b.*?(?:</(?i:script|style)\s*+>|\z)"    # no markup inside
         r"|<[!?][^>]*+>?"                                         # declaration
         r"""|</?+[a-zA-Z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>?"""    # tag
         r"|</[^>]*+>?"                                            # nameless end tag
         r"|(?:[^<]++|<(?![a-zA-Z/!?]))++")                        # text

# Elements without content.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")

# Start tags, the open elements that they end, and the elements
# that shield open elements further out.
IMPLIED = (
    (("li",), ("li",), ("ul", "ol")),
    (("dt", "dd"), ("dt", "dd"), ("dl",)),
    (("td", "th"), ("td", "th"), ("table",)),
    (("tr",), ("tr",), ("table",)),
    (("thead", "tbody", "tfoot"), ("thead", "tbody", "tfoot"), ("table",)),
    (("option",), ("option",), ("select",)),
    (("address", "article", "aside", "blockquote", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2", "h3",
      "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"),
     ("p",), ("table", "td", "th", "caption", "button")),
    (("body",), ("head",), ()),
)
# An end tag reaches through elements of its rank or lower.
RANKS = (("div", 1), ("td", 2), ("th", 2), ("tr", 3), ("thead", 4), ("tbody", 4), ("tfoot", 4), ("table", 5),
         ("head", 6), ("body", 6), ("html", 7))

ENTITY = r"&(#[xX][0-9a-fA-F]{1,6}|#[0-9]{1,7}|[a-zA-Z][a-zA-Z0-9]*);"
# Named entities that HTML 4 lacks.
LATER_NAMES = {"apos": 0x27}

TEXT, START, EMPTY, END = 0, 1, 2, 3


@dataclass(frozen=True)
class Selection:
    """Elements ``tag`` (whose ``attr`` equals or contains ``value``), or their
    direct children ``child``; of these the texts, or the attribute ``take``."""

    tag: str
    attr: str | None = None
    value: str | None = None
    match: str = "equals"
    child: str | None = None
    take: str | None = None

    def __post_init__(self):
        if self.match not in ("equals", "contains"):
            raise ValueError(f"match must be 'equals' or 'contains', not {self.match!r}")


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _last(stack: Column) -> Column:
    return F.get(stack, F.size(stack) - 1)


def _bits(conditions: Sequence[tuple[int, Column]]) -> Column:
    """The bit of every condition that holds."""
    out = F.lit(0)
    for bit, holds in conditions:
        out = out.bitwiseOR(F.when(holds, F.lit(1 << bit)).otherwise(F.lit(0)))
    return out


def attribute(tag: Column, name: str) -> Column:
    """An attribute's value in a start tag's text, decoded; NULL if it has none."""
    one = r"""\s+[^\s=>"'/]+(?:\s*=\s*(?:"[^"]*+"|'[^']*+'|[^\s"'>]++))?|\s*/"""
    pattern = (rf"""(?s)^<[^\s/>]+(?:{one})*?\s+(?i:{re.escape(name)})\s*=\s*(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""")
    found = F.concat(*[F.regexp_extract(tag, pattern, g) for g in (1, 2, 3)])
    return F.when(tag.rlike(pattern), decode_entities(found))


def _character(entity: Column) -> Column:
    """What the inside of an entity stands for; the entity itself if unknown."""
    names = {**{n: chr(c) for n, c in name2codepoint.items()}, **LATER_NAMES}
    table = F.create_map(*[F.lit(x) for n, c in names.items() for x in (n, c if isinstance(c, str) else chr(c))])
    digits = F.when(entity.rlike("^#[xX]"), F.conv(F.substring(entity, 3, 6), 16, 10)).otherwise(F.substring(entity, 2, 7))
    code = digits.cast("long")
    valid = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
    number = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code).otherwise(F.lit(0xFFFD))), 8, "0")), "UTF-32")
    return F.when(F.startswith(entity, F.lit("#")), number).otherwise(
        F.coalesce(F.try_element_at(table, entity), F.concat(F.lit("&"), entity, F.lit(";"))))


def decode_entities(c: Column) -> Column:
    """Named and numeric entities decoded, each once."""
    joined = F.zip_with(F.split(c, ENTITY, -1), F.regexp_extract_all(c, F.lit(ENTITY), 1),
                        lambda gap, entity: F.concat(gap, F.when(entity.isNull(), F.lit("")).otherwise(_character(entity))))
    return F.when(F.contains(c, F.lit("&")), F.array_join(joined, "")).otherwise(c)


def _rank(name: Column) -> Column:
    out = F.lit(0)
    for rank in sorted({r for _, r in RANKS}):
        out = F.when(name.isin([n for n, r in RANKS if r == rank]), F.lit(rank)).otherwise(out)
    return out


def _tokens(html: Column, wanted: Sequence[Selection]) -> Column:
    """Tokens that matter: texts, start tags with what they select, end tags."""
    empty = (F.lit(None).cast("string"), F.lit(0), F.lit(0), F.lit(0), F.lit(0))
    fields = ("kind", "text", "name", "rank", "group", "own", "child")

    def of(kind, text, name, rank, group, own, child):
        return F.struct(*[v.alias(n) for n, v in zip(fields, (F.lit(kind), text, name, rank, group, own, child))])

    def start(tag):
        def named(name):
            group = F.lit(0)
            for i, (tags, _, _) in enumerate(IMPLIED, 1):
                group = F.when(name.isin(list(tags)), F.lit(i)).otherwise(group)
            fits = []
            for k, s in enumerate(wanted):
                holds = name == s.tag.lower()
                if s.attr is not None:
                    value = attribute(tag, s.attr)
                    rest = (value == s.value) if s.match == "equals" else F.contains(value, F.lit(s.value))
                    holds = F.when(holds, F.coalesce(rest, F.lit(False))).otherwise(F.lit(False))
                fits.append((k, holds))
            kids = [(k, name == s.child.lower()) for k, s in enumerate(wanted) if s.child]
            closed = name.isin(list(VOID)) | F.endswith(tag, F.lit("/>"))
            parts = (tag, name, _rank(name), group, _bits(fits), _bits(kids))
            return F.when(closed, of(EMPTY, *parts)).otherwise(of(START, *parts))
        return _let(F.lower(F.regexp_extract(tag, r"^<([^\s/>]+)", 1)), named)

    def end(tag):
        return _let(F.lower(F.regexp_extract(tag, r"^</([^\s/>]+)", 1)),
                    lambda name: of(END, F.lit(None).cast("string"), name, _rank(name), *empty[2:]))

    def read(token):
        return (F.when(~F.startswith(token, F.lit("<")) | token.rlike("^<(?![a-zA-Z/!?])"), of(TEXT, token, *empty))
                .when(token.rlike("^</[a-zA-Z]"), end(token))
                .when(token.rlike("^<(?!(?i:script|style)\\b)[a-zA-Z]"), start(token)))

    # what is left NULL (comments, scripts) only separates texts
    return F.transform(F.regexp_extract_all(html, F.lit(TOKEN), 0), read)


def _implied(stack: Column, group: Column) -> Column:
    """The stack after the ends that a start tag of ``group`` implies."""
    def place(test):
        return F.coalesce(F.array_max(F.transform(stack, lambda e, i: F.when(test(e["name"]), i + 1).otherwise(F.lit(0)))), F.lit(0))

    out = stack
    for i, (_, ends, shields) in enumerate(IMPLIED, 1):
        last = place(lambda n, ends=ends: n.isin(list(ends)))
        shield = place(lambda n, shields=shields: n.isin(list(shields))) if shields else F.lit(0)
        out = F.when(group == i, _let(F.struct(last.alias("a"), shield.alias("b")),
                                      lambda p: F.when(p["a"] > p["b"], F.slice(stack, F.lit(1), p["a"] - 1)).otherwise(stack))).otherwise(out)
    return out


def _closed(stack: Column, name: Column, rank: Column) -> Column:
    """The stack after an end tag."""
    last = F.array_max(F.transform(stack, lambda e, i: F.when(e["name"] == name, i + 1).otherwise(F.lit(0))))

    def cut(at):
        inner = F.slice(stack, at + 1, F.size(stack))
        return F.when((at > 0) & ~F.exists(inner, lambda e: e["rank"] > rank), F.slice(stack, F.lit(1), at - 1)).otherwise(stack)
    return _let(F.coalesce(last, F.lit(0)), cut)


def found(html: str | Column, wanted: Sequence[Selection]) -> Column:
    """``array<struct<mask, value>>`` in document order: bit ``k`` of ``mask`` says
    that ``value`` (not yet decoded) is a result of ``wanted[k]``."""
    if len(wanted) > 31:
        raise ValueError("31 selections at most")
    html = F.col(html) if isinstance(html, str) else html
    direct = sum(1 << k for k, s in enumerate(wanted) if not s.child)
    texts = sum(1 << k for k, s in enumerate(wanted) if not s.take)
    taken = [(k, s.take) for k, s in enumerate(wanted) if s.take]

    def state(stack, values):
        return F.struct(stack.alias("stack"), values.alias("values"))

    def start(s, t):
        def opened(base):
            parent = F.coalesce(_last(base)["own"], F.lit(0))
            hits = t["own"].bitwiseAND(F.lit(direct)).bitwiseOR(t["child"].bitwiseAND(parent))

            def with_hits(hit):
                values = s["values"]
                for k, name in taken:
                    bit = F.lit(1 << k)
                    value = attribute(t["text"], name)
                    values = F.when((hit.bitwiseAND(bit) != 0) & value.isNotNull(),
                                    F.array_append(values, F.struct(bit.alias("mask"), value.alias("value")))).otherwise(values)
                element = F.struct(t["name"].alias("name"), t["rank"].alias("rank"), t["own"].alias("own"),
                                   hit.bitwiseAND(F.lit(texts)).alias("hits"))
                return state(F.when(t["kind"] == START, F.array_append(base, element)).otherwise(base), values)
            return _let(hits, with_hits)
        return _let(F.when(t["group"] == 0, s["stack"]).otherwise(_implied(s["stack"], t["group"])), opened)

    def step(s, t):
        hits = _last(s["stack"])["hits"]
        text = F.when(hits != 0, state(s["stack"], F.array_append(
            s["values"], F.struct(hits.alias("mask"), t["text"].alias("value"))))).otherwise(s)
        return (F.when(t["kind"] == TEXT, text)
                .when(t["kind"] == END, state(_closed(s["stack"], t["name"], t["rank"]), s["values"]))
                .when(t["kind"].isNotNull(), start(s, t)).otherwise(s))

    none = state(F.array().cast("array<struct<name:string,rank:int,own:int,hits:int>>"),
                 F.array().cast("array<struct<mask:int,value:string>>"))
    return F.aggregate(_tokens(html, wanted), none, step, lambda s: s["values"])


def values_of(hits: Column, wanted: Sequence[Selection], k: int) -> Column:
    """The values of ``wanted[k]`` in what :func:`found` gives, decoded."""
    mine = F.filter(hits, lambda x: x["mask"].bitwiseAND(F.lit(1 << k)) != 0)
    return F.transform(mine, lambda x: x["value"] if wanted[k].take else decode_entities(x["value"]))


def select_lists(pages: DataFrame, keys: Sequence[str], wanted: dict[str, Selection], html: str = "html") -> DataFrame:
    """``keys`` and one array column for each named selection, all from one walk over ``html``."""
    every = list(wanted.values())
    hits = pages.select(*keys, found(html, every).alias("_found"))
    return hits.select(*keys, *[values_of(F.col("_found"), every, k).alias(name) for k, name in enumerate(wanted)])


def element_texts(html: str | Column, tag: str, cls: str | None = None,
                  match: str = "equals", child: str | None = None) -> Column:
    """Array of texts of the selected elements, or of every direct ``child`` of
    them (S2, S3), in document order, entity-decoded."""
    wanted = [Selection(tag, "class" if cls is not None else None, cls, match, child)]
    return values_of(found(html, wanted), wanted, 0)


def child_attributes(html: str | Column, tag: str, child: str, attr: str) -> Column:
    """Array of ``attr`` of every direct ``child`` of the ``tag`` elements."""
    wanted = [Selection(tag, child=child, take=attr)]
    return values_of(found(html, wanted), wanted, 0)


def zip_lists(df: DataFrame, keys: Sequence[str], lists: Sequence[str],
              pos: str = "pos") -> DataFrame:
    """Parallel arrays -> one row per position.

    ``arrays_zip`` pads short arrays with NULL; the reference's DataFrame
    constructor rejects unequal lengths, so lengths are asserted first.
    """
    first = lists[0]
    same = F.lit(True)
    for other in lists[1:]:
        same = same & (F.size(first) == F.size(other))
    guarded = df.withColumn(
        first,
        F.when(same, F.col(first)).otherwise(
            F.raise_error(F.lit(f"lists {list(lists)} differ in length"))))
    zipped = guarded.select(*keys, F.posexplode(F.arrays_zip(*lists)).alias(pos, "_z"))
    return zipped.select(*keys, F.col(pos).cast("long").alias(pos),
                         *[F.col(f"_z.{c}").alias(c) for c in lists])
