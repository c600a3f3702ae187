"""URL filter: rules first, then a path-template tree learned from labelled pages.

For each host the paths form a tree. Digits and long hexadecimal runs of a
segment become placeholders; then, level by level to the paths' real depth (levels
at which a branch does not part are passed at once), a segment becomes a wildcard when too small a part of its branch's pages have it
and its labels say nothing of their own: they are fewer than ENOUGH and their
share of bad pages does not differ significantly from that of the branch's other
segments with few labels. A branch keeps any number of literal segments. Sibling
templates whose shares of bad pages do not differ significantly are merged, and
a merged template is rejected when its share of bad pages, smoothed towards that
of all labelled pages, reaches PURITY; one without a labelled page is not.

Everything is DataFrame expressions. Pages are summed up by host and shape of
the path first, so the tree's levels work on few rows and a host with a third
of all pages costs no more than another.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opslake.llm.graph import cut

#: a segment stays literal if it has so many pages, and this part of its branch's or labels of its own
MIN_SHARE, MIN_PAGES = 0.02, 3
#: only how a template is written: wildcards from this segment to the end are one, with their number
LEVELS = 8
#: siblings are merged when their shares differ by fewer standard errors
SIMILAR = 1.64
#: pseudo-pages of the overall share, and the share from which a template is rejected
SMOOTHING, PURITY = 10.0, 0.5
#: labelled pages with which any segment stays literal: they outweigh the pseudo-pages
ENOUGH = 10
#: levels' finished shapes that are written as one frame
PARTS = 16

# fixed values: the rules of the registered query
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
         ("block", "net/fr/")]


def _after(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(_after(url), r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1)


def _ruled(host: Column, path: Column, rules: list[tuple[str, str]], give) -> Column:
    """``give`` (verdict, rule) of the longest rule that fits, or null."""
    out = F.lit(None).cast("string")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):  # the longest is tested first
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        out = F.when(fits, F.lit(give(verdict, rule))).otherwise(out)
    return out


def _shape(path: Column) -> Column:
    """The path's segments, digits and long hexadecimal runs as placeholders."""
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    return F.transform(parts, lambda x: F.regexp_replace(
        F.regexp_replace(x, r"[0-9a-fA-F]{8}(?:-?[0-9a-fA-F]{4}){3}-?[0-9a-fA-F]{12}|[0-9a-fA-F]{16,}", "{x}"), r"[0-9]+", "{n}"))


def _trunk(out: DataFrame) -> DataFrame:
    """Branches moved on over the levels at which they do not part: all their
    shapes that go so far have one segment there, on MIN_PAGES pages or more, so it
    stays literal. Found for all levels at once from the counts of the segments by place."""
    ahead = out.select("host", "template", "pages", F.posexplode(
        F.expr("slice(shape, level + 1, size(shape) - level)")).alias("j", "seg"))
    places = ahead.groupBy("host", "template", "j").agg(F.sum("pages").alias("p"), F.min("seg").alias("low"), F.max("seg").alias("high"))
    parts = (F.col("low") != F.col("high")) | (F.col("p") < MIN_PAGES)
    steps = places.groupBy("host", "template").agg(
        F.coalesce(F.min(F.when(parts, F.col("j"))), F.max("j") + 1).alias("steps"))
    n = F.least(F.col("steps"), F.size("shape") - F.col("level"))
    straight = F.array_join(F.expr("slice(shape, level + 1, n)"), "/")
    return (out.join(steps, ["host", "template"]).withColumn("n", n)
            .withColumn("template", F.when(F.col("n") > 0, F.concat("template", F.lit("/"), straight)).otherwise(F.col("template")))
            .withColumn("level", F.col("level") + F.col("n")).drop("n", "steps"))


def _generalised(shapes: DataFrame) -> DataFrame:
    """host, shape, pages, ... with template, in which a wildcard is an empty
    segment: from one level at which branches part to the next, until none has
    MIN_PAGES pages left to part."""
    out = shapes.withColumn("template", F.lit("")).withColumn("level", F.lit(0)).withColumn("open", F.size("shape") > 0)
    done = []
    while True:
        done.append(out.where("not open").drop("open", "level"))
        if len(done) == PARTS:
            done = [cut(_union(done))]
        out = out.where("open").drop("open")
        if out.isEmpty():
            return _union(done)
        out = _trunk(out)
        ended = F.size("shape") <= F.col("level")
        done.append(cut(out.where(ended).drop("level")))
        out = out.where(~ended).withColumn("seg", F.expr("get(shape, level)"))
        step = out.groupBy("host", "template", "seg").agg(
            F.sum("pages").alias("own"), F.sum("labelled").alias("n"), F.sum("bad").alias("b"))
        few = F.col("n") < ENOUGH
        branch = step.groupBy("host", "template").agg(
            F.sum("own").alias("all"), F.sum(F.when(few, F.col("n")).otherwise(0)).alias("all_n"),
            F.sum(F.when(few, F.col("b")).otherwise(0)).alias("all_b"))
        kept = step.join(branch, ["host", "template"]).select(
            "host", "template", "seg", "all", ((F.col("own") >= MIN_PAGES) & (
                (F.col("own") >= MIN_SHARE * F.col("all")) | ~few | _differs())).alias("literal"))
        longer = F.concat("template", F.lit("/"), F.when(F.col("literal"), F.col("seg")).otherwise(""))
        # of a branch with fewer pages no segment below can stay literal either
        small = F.concat("template", F.repeat(F.lit("/"), F.size("shape") - F.col("level")))
        out = (out.join(kept, ["host", "template", "seg"])
               .withColumn("open", (F.col("all") >= MIN_PAGES) & (F.size("shape") > F.col("level") + 1))
               .withColumn("template", F.when(F.col("all") < MIN_PAGES, small).otherwise(longer))
               .withColumn("level", F.col("level") + 1).drop("seg", "all", "literal"))
        out = cut(out)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _differs() -> Column:
    """Whether a segment's share of bad pages (b of n labelled) differs from that of
    the branch's others (all_b of all_n with it)."""
    n, b = F.col("n"), F.col("b")
    rest = F.col("all_n") - n
    overall = F.col("all_b") / F.col("all_n")
    error = F.sqrt(overall * (1 - overall) * (1 / n + 1 / rest))
    return F.when((n >= MIN_PAGES) & (rest > 0), F.abs(b / n - (F.col("all_b") - b) / rest) > SIMILAR * error).otherwise(False)


def _written(template: Column) -> Column:
    """Wildcards as ``*``; k of them from segment LEVELS to the end as ``*{k}``."""
    tail = F.length(F.regexp_extract(template, rf"^(?:/[^/]*){{{LEVELS - 1}}}(/{{2,}})$", 1))
    front = F.substring(template, F.lit(1), F.length(template) - tail)
    stars = F.regexp_replace(front, "/(?=/|$)", "/*")
    return F.when(tail > 0, F.concat(stars, F.lit("/*{"), tail.cast("string"), F.lit("}"))).otherwise(stars)


def template_verdicts(shapes: DataFrame) -> DataFrame:
    """host, shape, template, branch, purity, reject. ``shapes``: host, shape
    (array of segments), pages, labelled, bad (counts)."""
    t = _generalised(shapes)
    total = t.agg(F.sum("labelled").alias("n"), F.sum("bad").alias("b")).first()
    prior = (total["b"] or 0) / total["n"] if total["n"] else 0.0
    nodes = t.groupBy("host", "template").agg(*[F.sum(c).alias(c) for c in ("pages", "labelled", "bad")])
    parent = F.when(F.col("template").contains("/"), F.regexp_extract("template", r"^(.*)/[^/]*$", 1)).otherwise(F.lit(""))
    share = (F.col("bad") + SMOOTHING * prior) / (F.col("labelled") + SMOOTHING)
    # siblings by share; one that differs from the one before opens a new branch
    order = Window.partitionBy("host", "parent").orderBy("share", "template")
    nodes = (nodes.withColumn("parent", parent).withColumn("share", share)
             .withColumn("before", F.lag(F.struct("share", "labelled")).over(order)))
    n1, n2 = F.col("labelled") + SMOOTHING, F.col("before.labelled") + SMOOTHING
    pooled = (F.col("share") * n1 + F.col("before.share") * n2) / (n1 + n2)
    error = F.sqrt(pooled * (1 - pooled) * (1 / n1 + 1 / n2))
    new = F.coalesce(F.col("share") - F.col("before.share") > SIMILAR * error, F.lit(False)).cast("int")
    nodes = nodes.withColumn("branch", F.sum(new).over(order))
    merged = (nodes.groupBy("host", "parent", "branch").agg(F.sum("labelled").alias("n"), F.sum("bad").alias("b"))
              .withColumn("purity", (F.col("b") + SMOOTHING * prior) / (F.col("n") + SMOOTHING)))
    judged = (nodes.select("host", "parent", "branch", "template").join(merged, ["host", "parent", "branch"])
              .select("host", "template", "branch", "purity", ((F.col("n") > 0) & (F.col("purity") >= PURITY)).alias("reject")))
    return (t.select("host", "shape", "template").join(judged, ["host", "template"])
            .withColumn("template", _written(F.col("template"))))


def url_filter(pages: DataFrame, labelled: DataFrame, rules: list[tuple[str, str]] | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity for each row of
    ``pages`` (page_id, url). ``labelled``: page_id and bad (0 or 1).

    rule: the longest that fits the host or a parent of it, and the beginning of
    the path; its verdict holds. Else ``block`` where the page's template is
    rejected, ``allow`` otherwise. A null url, or one without ``://``, has an empty
    host and path and is judged like others. A page labelled more than once is bad
    if one label says so; null labels and ids are no label. Repeated rows each get
    a row; other columns are ignored; an empty table gives an empty one.
    """
    rules = RULES if rules is None else rules
    url = F.col("url").cast("string")
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    p = p.withColumn("shape", _shape(F.col("path")))
    marks = (labelled.select(F.col("page_id").cast("long").alias("page_id"), F.col("bad").cast("int").alias("bad"))
             .where("page_id is not null and bad is not null").groupBy("page_id").agg(F.max("bad").alias("bad")))
    known = p.join(marks, "page_id", "left")
    shapes = cut(known.groupBy("host", "shape").agg(F.count("*").alias("pages"), F.count("bad").alias("labelled"),
                                                    F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")))
    judged = template_verdicts(shapes)
    host, path = F.col("host"), F.col("path")
    return (p.join(judged, ["host", "shape"], "left")
            .select("page_id", "host", "path", _ruled(host, path, rules, lambda v, r: r).alias("rule"),
                    F.coalesce(_ruled(host, path, rules, lambda v, r: v),
                               F.when(F.col("reject"), F.lit("block")).otherwise("allow")).alias("verdict"),
                    "template", "purity"))
