"""Secret scan with multipart credential linking.

Base kinds are always reported. Weak candidates (a name that could be an access
identifier, a random-looking token, an endpoint) are reported only where
complementary parts stand close by: an identifier needs a secret; a token needs
an identifier or an endpoint; an endpoint needs an identifier and a secret. A
complement begins within SCOPE code points and shares no character with the part
it completes: a token inside a link is not the link's secret. The parts are joined
as intervals, in cells of SCOPE code points: each part is a partner in its
own cell and both beside it, and a running maximum over the cell's places gives each weak part
the nearest partner of each role before and behind it, so the join grows with the
parts and not with their pairs.

Everything is DataFrame expressions. A regular expression's matches and the
texts between them (``regexp_extract_all`` and ``split``) give the places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opslake.llm.graph import cut

#: most code points between the starts of parts that belong together
SCOPE = 300

# fixed values: base kinds, their patterns (leftmost, not overlapping) and least lengths
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # a run of [0-9a-f] is one match; shorter ones would be dropped after it

#: weak kinds
IDENT = r"""(?i)(?:access_?key(?:_?id)?|key_?id|client_?id|user_?name|user|login|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@+-]{3,}"""
ENDPOINT = r"""(?i)(?:https?|ftps?|sftp|s3|gs|postgres(?:ql)?|mysql|mongodb|redis|amqps?|jdbc:[a-z]+)://[^\s"'<>]{3,}"""
BLOB = (r"(?<![A-Za-z0-9+/])(?=[A-Za-z0-9+/]*[0-9])(?=[A-Za-z0-9+/]*[a-z])(?=[A-Za-z0-9+/]*[A-Z])"
        r"[A-Za-z0-9+/]{20,}={0,2}")

#: (kind, pattern, role, weak) in the order of equal starts
KINDS = [("assign", ASSIGN, "secret", False), ("access", ACCESS, "ident", False), ("hex", HEX, "secret", False),
         ("ident", IDENT, "ident", True), ("endpoint", ENDPOINT, "endpoint", True), ("blob", BLOB, "secret", True)]


def _matches(text: Column, order: int) -> Column:
    """array<struct<ord, gap, len, ok>>: each match with the length of the text
    before it (from the match before) and whether it is long enough."""
    kind, pattern, _, _ = KINDS[order]
    pairs = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
                         F.split(text, pattern, -1).alias("gap"))
    ok = {"assign": lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 6,
          "access": lambda m: F.length(m) >= 20}.get(kind, lambda m: F.lit(True))
    rows = F.transform(pairs, lambda p: F.struct(F.lit(order).alias("ord"), F.length(p["gap"]).cast("long").alias("gap"),
                                                 F.length(p["m"]).cast("long").alias("len"), ok(p["m"]).alias("ok")))
    return F.when(text.rlike(pattern), F.filter(rows, lambda r: r["len"].isNotNull()))


def parts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows (uid, doc_id), and their parts (uid, ord, first, end) in code points."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"),
                    text.alias("text"))
    empty = F.array().cast("array<struct<ord:int,gap:bigint,len:bigint,ok:boolean>>")
    found = F.flatten(F.array(*[F.coalesce(_matches(F.col("text"), i), empty) for i in range(len(KINDS))]))
    rows = cut(d.select("uid", "doc_id", F.posexplode_outer(found).alias("nth", "p")).select("uid", "doc_id", "nth", "p.*"))
    run = Window.partitionBy("uid", "ord").orderBy("nth")
    end = F.sum(F.col("gap") + F.col("len")).over(run.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    some = rows.where("ord is not null").withColumn("end", end).where("ok").select(
        "uid", "ord", (F.col("end") - F.col("len")).alias("first"), "end")
    return rows.where("coalesce(nth, 0) = 0").select("uid", "doc_id"), cut(some)


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak parts (uid, ord, first, end) that have their complements within ``scope``."""
    role = F.element_at(F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (i, k[2])]), F.col("ord"))
    weak = F.col("ord").isin([i for i, k in enumerate(KINDS) if k[3]])
    p = found.withColumn("role", role).withColumn("cell", F.floor(F.col("first") / scope))
    first, end = F.col("first"), F.col("end")
    # looking back (side 0) a partner counts from its end on by its start; looking ahead is the same with all signs changed
    partners = p.withColumn("cell", F.explode(F.array(F.col("cell") - 1, F.col("cell"), F.col("cell") + 1))).select(
        "uid", "cell", "role", F.inline(F.array(
            F.struct(F.lit(0).alias("side"), end.alias("at"), first.alias("value")),
            F.struct(F.lit(1).alias("side"), (-first).alias("at"), (-first).alias("value")))))
    asking = p.where(weak).select(
        "uid", "cell", "role", "ord", "first", "end", F.inline(F.array(
            F.struct(F.lit(0).alias("side"), first.alias("at"), (first - scope).alias("least")),
            F.struct(F.lit(1).alias("side"), (-end).alias("at"), (-first - scope).alias("least")))))
    events = partners.unionByName(asking, allowMissingColumns=True)
    # partners before a weak part at the same place
    upto = (Window.partitionBy("uid", "cell", "side").orderBy("at", F.col("ord").isNotNull())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    roles = ("ident", "secret", "endpoint")
    events = events.withColumns({f"near_{r}": F.max(F.when((F.col("role") == r) & F.col("ord").isNull(), F.col("value"))).over(upto)
                                 for r in roles})
    has = events.where("ord is not null").groupBy("uid", "ord", "role", "first", "end").agg(
        *[F.max((F.coalesce(F.col(f"near_{r}") >= F.col("least"), F.lit(False))).cast("int")).alias(f"has_{r}") for r in roles])
    return has.where("(role = 'ident' and has_secret = 1) or (role = 'secret' and has_ident + has_endpoint > 0) "
                     "or (role = 'endpoint' and has_ident + has_secret = 2)").select("uid", "ord", "first", "end")


def secret_scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, spans (array of kind, first, end), base (the same of the base kinds)
    for each row of ``docs``, sorted by start, then kind as listed.

    Null and empty texts have no span. Repeated rows each get a row, null doc_ids
    stay null, other columns are ignored; an empty table gives an empty one.
    """
    rows, found = parts(docs)
    base = found.where(~F.col("ord").isin([i for i, k in enumerate(KINDS) if k[3]]))
    spans = (base.unionByName(linked(found, scope)).groupBy("uid")
             .agg(F.array_sort(F.collect_list(F.struct("first", "ord", "end"))).alias("s")))
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    strong = [i for i, k in enumerate(KINDS) if not k[3]]

    def named(s: Column) -> Column:
        return F.transform(s, lambda x: F.struct(F.get(names, x["ord"]).alias("kind"), x["first"].alias("first"),
                                                 x["end"].alias("end")))

    s = F.coalesce("s", F.array().cast("array<struct<first:bigint,ord:int,end:bigint>>"))
    return rows.join(spans, "uid", "left").select(
        "doc_id", named(s).alias("spans"), named(F.filter(s, lambda x: x["ord"].isin(strong))).alias("base"))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["first"].cast("string"),
                                                                 x["end"].cast("string"))), ",")
