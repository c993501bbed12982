"""URL filter: a path-template tree per host.

A url's path is cut into segments. A segment that is variable by its form
(a number, a hash, a long or mixed name) becomes ``*`` at once. Then, at each
depth, sibling branches with the same shape below them (the next depth's
children) and label rates that do not differ by a two-proportion test are merged
into ``*``, however many siblings there are: a branch whose labels differ keeps
its name on a host of any size. The leaves of this tree are templates.

A template is rejected when its labelled purity says so: with ``good`` and
``bad`` labelled urls, smoothed towards the labelled rate of all urls with
strength ``smooth``, its good share is under ``reject_under``. Templates
without labels keep the overall rate and so are allowed.

Rules (host suffix and path prefix, longest match wins) come before the tree.

Counts are aggregated before every shuffle, so a host that holds a third of
all urls is as many rows as it has templates. The tree is built level by level
over whole paths; keys with no sibling left, and those that have ended, are set
aside, so the number of levels is that of the longest paths that share all but
their ends.

Defined results: a null url or one without ``://`` has an empty host and path
and no rule, and is judged like any template. Repeated rows are judged
alike and each counted. A null id stays. Null or non-0/1 labels do not count.
An empty table gives an empty result; without labels everything the rules
leave is allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegauge.llm.tables import freeze, read

#: (host suffix, path prefix, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow"))
VARIABLE = r"^(?:[0-9]+(?:[._-][0-9]+)*(?:\.[a-z0-9]{1,5})?|[0-9a-f]{8,}|.{33,}|[^0-9]*[0-9][^0-9]*[0-9].*)$"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    u = F.coalesce(url.cast("string"), F.lit(""))
    rest = F.when(F.instr(u, "://") > 0, F.substr(u, F.instr(u, "://") + F.lit(3))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.char_length(host) + F.lit(1)), r"(?s)^[^?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as text (``host/path``), else null."""
    out = F.lit(None).cast("string")
    for suffix, prefix, _ in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == suffix) | host.endswith("." + suffix)) & path.startswith(prefix)
        out = F.when(fits, F.lit(suffix + prefix)).otherwise(out)
    return out


def _segments(path: Column) -> Column:
    parts = F.array_remove(F.split(path, "/"), "")
    return F.transform(parts, lambda s: F.when(s.rlike(VARIABLE), F.lit("*")).otherwise(s))


def _generalise(tree: DataFrame, d: int, z: float) -> DataFrame:
    """Turn segment ``d`` of the tree's rows (host, t, n, good, bad) into ``*`` where
    the branch is like its siblings: of the same shape, with a rate of good labels
    that agrees with theirs together. How many siblings there are doesn't matter."""
    at = F.get("t", F.lit(d))
    rows = tree.withColumn("up", F.slice("t", 1, d)).withColumn("seg", at)
    deep = rows.where("seg is not null and seg <> '*'")
    # shape below a branch: its next segments, as a set of bounded size
    branch = (deep.groupBy("host", "up", "seg")
              .agg(F.sum("good").alias("g"), F.sum("bad").alias("b"),
                   F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(xxhash64(coalesce(get(t, {d + 1}), '')), 63) as int))")).alias("shape")))
    alike = branch.groupBy("host", "up", "shape").agg(
        F.count("*").alias("peers"), F.sum("g").alias("pg"), F.sum("b").alias("pb"))
    judged = (branch.join(alike, ["host", "up", "shape"])
              .withColumn("pool", F.expr("(pg + 1D) / (pg + pb + 2D)"))
              .withColumn("own", F.expr("(g + 2 * pool) / (g + b + 2D)"))
              .withColumn("se", F.expr("sqrt(pool * (1 - pool) / (g + b + 2D))"))
              .withColumn("wild", F.expr(f"peers > 1 and abs(own - pool) <= {z} * se"))
              .where("wild").select("host", "up", "seg", "wild"))
    out = rows.join(judged, ["host", "up", "seg"], "left")
    kept = F.slice("t", d + 2, F.greatest(F.size("t") - F.lit(d + 1), F.lit(0)))
    wild = F.when(F.col("wild"), F.concat("up", F.array(F.lit("*")), kept)).otherwise(F.col("t"))
    return (out.select("host", "key", wild.alias("t"), "n", "good", "bad"))


def templates(urls: DataFrame, labels: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url",
              z: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """(rows, tree): every url's host, path and raw template key, and for each key
    its template with the template's labelled counts."""
    host, path = host_and_path(F.col(url_col))
    rows = urls.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("key", F.concat_ws("/", _segments(F.col("path"))))
    if labels is not None:
        marks = labels.where("label in (0, 1)").groupBy("id").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
        rows = rows.join(marks.where("lo = hi").select("id", F.col("lo").alias("label")), "id", "left")
    else:
        rows = rows.withColumn("label", F.lit(None).cast("int"))
    rows = freeze(rows, "urls")
    tree = rows.groupBy("host", "key").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("good"),
        F.coalesce(F.sum(F.lit(1) - F.col("label")), F.lit(0)).alias("bad"))
    tree = tree.withColumn("t", F.when(F.col("key") == "", F.array().cast("array<string>")).otherwise(F.split("key", "/")))
    # level by level, until no path is longer: rows that have ended are set aside
    ended, d = None, 0
    while True:
        up = F.slice("t", 1, d)
        crowd = tree.groupBy("host", up.alias("up")).agg(F.count("*").alias("keys"))
        tree = freeze(tree.withColumn("up", up).join(crowd, ["host", "up"]).drop("up"), f"tree{d}")
        over = (F.size("t") <= d) | (F.col("keys") == 1)
        done = tree.where(over).drop("keys")
        ended = done if ended is None else ended.unionByName(done)
        deeper = tree.where(~over).drop("keys")
        if deeper.isEmpty():
            break
        tree, d = _generalise(deeper, d, z), d + 1
    tree = ended
    template = F.concat(F.lit("/"), F.concat_ws("/", "t"))
    tree = tree.withColumn("template", template)
    counts = tree.groupBy("host", "template").agg(F.sum("n").alias("urls"), F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    return rows, tree.select("host", "key", "template").join(counts, ["host", "template"])


def judge(urls: DataFrame, labels: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url",
          rules=RULES, smooth: float = 8.0, reject_under: float = 0.5) -> DataFrame:
    """(id_col, host, path, rule, verdict, template, purity) of every url."""
    rows, tree = templates(urls, labels, id_col, url_col)
    good, known = rows.agg(F.sum("label"), F.count("label")).first()
    rate = (int(good or 0) + 1) / (int(known or 0) + 1)
    purity = F.expr(f"(good + {smooth} * {rate}D) / (good + bad + {smooth}D)")
    # A host may hold a third of all urls: the tree side is small and unique per
    # key, so a skewed key splits on the urls' side only.
    judged = rows.join(tree.select("host", "key", "template", purity.alias("purity")), ["host", "key"])
    rule = rule_of(F.col("host"), F.col("path"), rules)
    by_rule = F.lit(None).cast("string")
    for suffix, prefix, verdict in rules:
        by_rule = F.when(F.col("rule") == suffix + prefix, F.lit(verdict)).otherwise(by_rule)
    return (judged.withColumn("rule", rule)
            .select(F.col("id").alias(id_col), "host", "path", "rule",
                    F.coalesce(by_rule, F.when(F.col("purity") < reject_under, F.lit("block")).otherwise(F.lit("allow")))
                    .alias("verdict"), "template", "purity"))


def op1_url_template_tree(spark, sf_dir: str) -> DataFrame:
    """Every page's url; a page is labelled by the quality mark of the document
    whose number ends its url's path."""
    pages = read(spark, sf_dir, "pages")
    number = F.regexp_extract(host_and_path(F.col("url"))[1], r"/([0-9]{1,18})(?:\.[a-z]+)?/?$", 1)
    marks = read(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    labels = (pages.select(F.col("page_id").alias("id"), number.alias("n"))
              .select("id", F.expr("try_cast(n as long)").alias("doc_id")).join(marks, "doc_id").select("id", "label"))
    return judge(pages, labels)
