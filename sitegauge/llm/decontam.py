"""Benchmark decontamination by template windows, on native functions only.

Texts are cut into lower-cased word tokens. Numbers, units that follow a
number and capitalised words inside a sentence (names) become the typed
placeholders of a template; their raw values are the template's slots. Every
window of ``k`` template tokens of every text is hashed and joined with the
windows of the benchmark items. A text and an item match when the text holds
at least ``cover`` of the item's distinct windows, at whatever places. An item of
fewer than ``k`` tokens is one window of its own length, which is looked for at
every position of the texts as well.

For matches the slots are then read: where windows meet, the slot at a token of
the item faces a slot of the text. All places of the text count, each as an
occurrence: the windows of one alignment (text position minus item position),
those of neighbouring alignments (a copy with words put in or left out) and the
first places of all windows. If some occurrence reaches ``cover`` and every slot
of the item faces one value only there, the question was copied (``exact``: same
values) or re-parameterised (``reworded``). Otherwise the match stays
(``literal``) only if the item's windows without placeholders alone reach
``cover``. A decimal or grouped number ('2.5', '1,300') is one slot.

The benchmark's windows are written first, so the optimiser sees their size
and broadcasts them only below its own limit; a larger benchmark is joined by
a shuffle. Equal items are joined as one template and named each in the result.

Defined results: null or empty texts and items match nothing. A text matches a
short item wherever it holds all of its tokens in a row. Repeated document rows are
judged alike and reported once per (document, item); a null id is kept as null.
Extra columns are not read; empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegauge.llm.tables import freeze, read

K = 5
COVER = 0.4
#: Unit words after a number, in natural order (a parameter of this operator).
UNITS = ("kg", "g", "mg", "lb", "oz", "km", "m", "cm", "mm", "mi", "ft", "in", "l", "ml", "h", "s", "min",
         "kilograms", "grams", "pounds", "ounces", "kilometers", "meters", "miles", "feet", "inches", "liters",
         "hours", "minutes", "seconds", "days", "weeks", "months", "years", "dollars", "euros", "cents",
         "percent", "degrees")

# Marks in front of a slot's value: name, unit, number.
_NAME, _UNIT, _NUM = "\x01", "\x02", "\x03"
_SEP = "[\\x00\\x04-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]"
_IN = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]"


# A number with its decimal and grouping marks, which become other signs in slots.
_DOT, _COMMA = "\uE000", "\uE001"
_NUMBER = "[0-9]+(?:[.,][0-9]+)*"
_NAMES = r" (?<=[\p{Ll}0-9,;:] )(\p{Lu}\p{Ll}+)"
_UNITS = "|".join(sorted(UNITS, key=len, reverse=True))


def marked(text: Column) -> Column:
    """The text with a mark in front of every name, number and unit."""
    named = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), _NAMES, f" {_NAME}$1")
    numbered = F.regexp_replace(named, _NUMBER, f" {_NUM}$0 ")
    for mark, sign in ((r"\.", _DOT), (",", _COMMA)):
        numbered = F.regexp_replace(numbered, f"(?<=[0-9]){mark}(?=[0-9])", sign)
    return F.regexp_replace(numbered, f"({_NUM}[0-9{_DOT}{_COMMA}]+ +)((?i:{_UNITS}))(?!{_IN})", f"$1{_UNIT}$2")


def _tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), _SEP + "+"), "")


def template(text: Column) -> Column:
    """Template tokens: words, and a mark alone for every slot. Token i belongs
    to token i of the marked text."""
    named = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), _NAMES, f" {_NAME}")
    numbered = F.regexp_replace(named, _NUMBER, f" {_NUM} ")
    return _tokens(F.regexp_replace(numbered, f"({_NUM} +)(?i:{_UNITS})(?!{_IN})", f"$1{_UNIT}"))


def _windows(words: str, k: int, short: tuple = ()) -> Column:
    """Positions and hashes of all windows of ``k`` tokens of an array column, and
    of all windows of each length in ``short``; their length goes into the hash."""
    def of(n: int, own: str) -> str:
        return (f"if(size({words}) >= {n}, transform(sequence(0, greatest(size({words}) - {n}, 0)), "
                f"i -> struct(i as pos, xxhash64(slice({words}, i + 1, {n}){own}) as h)), array())")
    return F.expr(f"concat({', '.join([of(k, ''), *(of(n, f', {n}') for n in short)])})")


def _item_windows(words: str, k: int) -> Column:
    """The windows of an item: all of ``k`` tokens, or one of its own length."""
    return F.expr(f"""case when size({words}) >= {k}
        then transform(sequence(0, size({words}) - {k}), i -> struct(i as pos, xxhash64(slice({words}, i + 1, {k})) as h))
        else array(struct(0 as pos, xxhash64({words}, size({words})) as h)) end""")


def template_matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     item_col: str = "item_id", item_text: str = "text", k: int = K,
                     cover: float = COVER) -> DataFrame:
    """(id_col, item_col, coverage, kind) of every text that holds an item."""
    bench = (items.select(F.col(item_col).alias("item"), marked(F.col(item_text)).alias("m"),
                          template(F.col(item_text)).alias("w"))
             .withColumn("form", F.xxhash64("m")).withColumn("raw", _tokens(F.col("m"))).where("size(w) > 0"))
    bench = freeze(bench.select("item", "form", "w", "raw"), "items")
    forms = bench.groupBy("form").agg(F.first("w").alias("w"), F.first("raw").alias("raw"))
    windows = forms.select("form", F.inline(_item_windows("w", k))).withColumnRenamed("pos", "ipos")
    # How many distinct windows an item has, and how many hold no slot.
    slotless = F.expr(f"not exists(slice(w, ipos + 1, {k}), x -> x rlike '[{_NAME}{_UNIT}{_NUM}]')")
    windows = freeze(windows.join(forms.select("form", "w"), "form")
                     .select("form", "h", "ipos", slotless.alias("plain")), "windows")
    sizes = windows.select("form", "h", "plain").distinct().groupBy("form").agg(F.count("*").alias("size"), F.sum(F.col("plain").cast("int")).alias("plain_size"))

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    # Lengths of the items shorter than a window: k - 1 at most.
    short = tuple(sorted(r[0] for r in forms.where(F.size("w") < k).select(F.size("w")).distinct().collect()))

    def hits(some: DataFrame) -> DataFrame:
        return (some.select("id", "th", template(F.col("text")).alias("w"))
                .select("id", "th", F.inline(_windows("w", k, short))).join(windows, "h"))

    # Texts that hold enough of an item's windows are then read again for the places.
    texts = texts.withColumn("th", F.xxhash64("text"))
    met = (hits(texts).select("th", "form", "h").distinct().groupBy("th", "form").agg(F.count("*").alias("n"))
           .join(sizes.select("form", "size"), "form").where(F.col("n") >= cover * F.col("size")).select("th", "form"))
    met = freeze(met, "met")
    near = freeze(texts.join(met.select("th").distinct(), "th", "left_semi").dropDuplicates(["id", "th"]), "near")
    found = freeze(hits(near).join(met, ["th", "form"], "left_semi"), "hits")
    once = found.groupBy("id", "th", "form", "h").agg(
        F.min(F.struct("pos", "ipos")).alias("p"), F.first("plain").alias("plain"))
    pairs = (once.groupBy("id", "th", "form").agg(F.count("*").alias("n"), F.sum(F.col("plain").cast("int")).alias("np"))
             .join(sizes, "form").where(F.col("n") >= cover * F.col("size"))
             .select("id", "th", "form", (F.col("n") / F.col("size")).alias("coverage"),
                     F.coalesce((F.col("np") >= cover * F.col("size")), F.lit(False)).alias("literal"),
                     (F.col("plain_size") < F.col("size")).alias("has_slots")))
    pairs = freeze(pairs, "matches")

    # Slots, for the matches with placeholders only.
    slotted = pairs.where("has_slots")
    wanted = slotted.select("id", "th").distinct()
    raws = (near.alias("t").join(wanted.alias("x"), F.expr("t.id <=> x.id and t.th = x.th"), "left_semi")
            .select("id", "th", _tokens(marked(F.col("text"))).alias("traw")))
    # Occurrences of an item: (0, alignment), (1, overlapping ranges of alignments,
    # half an item wide), (2, the first places of all windows).
    wide = F.expr("greatest(4, cast(ceil(size / 2) as int))")
    of_slotted = slotted.select("id", "th", "form").join(sizes.select("form", "size"), "form").withColumn("wide", wide)
    placed = (found.alias("f").join(of_slotted.alias("s"), F.expr("f.id <=> s.id and f.th = s.th and f.form = s.form"))
              .select("f.*", "s.size", F.expr("cast(floor((pos - ipos) / s.wide) as int)").alias("range"))
              .select("id", "th", "form", "h", "pos", "ipos", "plain", "size", F.explode(F.expr(
                  "array(struct(0 as kind, pos - ipos as place), struct(1 as kind, range as place), "
                  "struct(1 as kind, range + 1 as place))")).alias("o")))
    first = (once.alias("f").join(of_slotted.alias("s"), F.expr("f.id <=> s.id and f.th = s.th and f.form = s.form"))
             .select("f.id", "f.th", "f.form", "f.h", "f.p.pos", "f.p.ipos", "f.plain", "s.size",
                     F.expr("struct(2 as kind, 0 as place)").alias("o")))
    placed = placed.unionByName(first)
    whole = (placed.select("id", "th", "form", "size", "o", "h").distinct().groupBy("id", "th", "form", "size", "o")
             .agg(F.count("*").alias("n")).where(F.col("n") >= cover * F.col("size")).drop("size", "n"))
    whole = freeze(whole, "occurrences")
    faced = (placed.where("not plain").alias("f")
             .join(whole.alias("o"), F.expr("f.id <=> o.id and f.th = o.th and f.form = o.form and f.o = o.o"), "left_semi")
             .alias("f").join(raws.alias("r"), F.expr("f.id <=> r.id and f.th = r.th"))
             .select("f.id", "f.th", "f.form", "f.o", "f.pos", "f.ipos", "r.traw")
             .join(forms.select("form", "raw"), "form")
             .select("id", "th", "form", "o", F.explode(F.expr(
                 f"filter(zip_with(zip_with(slice(raw, ipos + 1, {k}), sequence(ipos, ipos + {k - 1}), (a, j) -> struct(a as i, j as slot)), "
                 f"slice(traw, pos + 1, {k}), (a, b) -> struct(a.i as i, a.slot as slot, b as t)), "
                 f"x -> x.i rlike '^[{_NAME}{_UNIT}{_NUM}]')")).alias("v")))
    values = (faced.groupBy("id", "th", "form", "o", "v.slot").agg(
        F.min("v.t").alias("lo"), F.max("v.t").alias("hi"), F.first("v.i").alias("i"))
        .groupBy("id", "th", "form", "o").agg(F.min(F.expr("lo = hi")).alias("consistent"),
                                              F.min(F.expr("lo = i and hi = i")).alias("same")))
    # an occurrence of plain windows alone conflicts with nothing
    verdict = (whole.alias("w").join(values.alias("v"), F.expr(
        "w.id <=> v.id and w.th = v.th and w.form = v.form and w.o = v.o"), "left")
        .select("w.id", "w.th", "w.form", F.coalesce("v.consistent", F.lit(True)).alias("consistent"),
                F.coalesce("v.same", F.lit(True)).alias("same"))
        .groupBy("id", "th", "form").agg(F.max("consistent").alias("consistent"), F.max("same").alias("same")))
    judged = (pairs.alias("p").join(verdict.alias("v"), F.expr("p.id <=> v.id and p.th = v.th and p.form = v.form"), "left")
              .select("p.id", "p.form", "p.coverage", "p.literal",
                      F.coalesce("v.consistent", F.lit(True)).alias("consistent"),
                      F.coalesce("v.same", F.lit(True)).alias("same"))
              .where("consistent or literal")
              .withColumn("kind", F.expr("case when same then 'exact' when consistent then 'reworded' else 'literal' end")))
    return (judged.join(bench.select("item", "form"), "form")
            .groupBy(F.col("id").alias(id_col), F.col("item").alias(item_col))
            .agg(F.max("coverage").alias("coverage"), F.min("kind").alias("kind")))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text matches no item. Rows are
    removed by their text, so a null id is no obstacle."""
    keyed = docs.withColumn("_text_hash", F.xxhash64(F.col(text_col).cast("string")))
    gone = (template_matches(keyed, items, "_text_hash", text_col).select("_text_hash").distinct())
    return keyed.join(gone, "_text_hash", "left_anti").drop("_text_hash").select(*docs.columns)


def op3_decontamination(spark, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, over all documents and items."""
    return template_matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
