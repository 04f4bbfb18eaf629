"""Mixing sources to target weights by Pareto order sampling, with DataFrame functions only.

Every document is expected to be taken ``e`` times: its source's target over its source's size, times the document's preference where
one is given. ``floor(e)`` copies are certain. The fraction ``p`` left is an inclusion probability: documents are ranked
by random odds over inclusion odds, ``q = (u / (1 - u)) / (p / (1 - p))``, and each source takes the smallest ``q`` until
the words that its fractions add up to are reached, a sample of fixed size with unequal probabilities. Words do not
come out even: past the first document that does not fit, smaller ones are taken that still do, and last the one that
brings the source nearest to its target.

No source is ever sorted whole. ``q / (1 + q)`` lies in (0, 1); its range is cut into ``BINS`` bins, words are summed by source and bin
with partial aggregation, and only the one bin in which a source reaches its size is ranked row by row. What comes out is
a small table of cut-offs, one row a source, that decides about any row where it lies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, words_of

BINS = 4096


def shares(sized: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    """(s, source, source_size, target): sources, numbered by code point, null last, weigh ``weights`` in turn and share the total size;
    no target exceeds ``cap`` times its source's size, and what that frees is shared out again by weight.

    The windows over all sources hold one row a source, never documents. Targets are min(cap * size, weight * level) for the one level at which they add up to the total. Sources reach
    their cap in order of cap * size / weight, so the level follows from running sums in that order."""
    each = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    row = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    each = each.withColumn("s", row)
    each = each.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("s") - 1) % len(weights) + 1))
    each = each.withColumn("most", cap * F.col("source_size").cast("double")).withColumn("full", F.col("most") / F.col("w"))
    order = Window.orderBy("full", F.col("source").asc_nulls_last())
    above = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    below = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    each = each.withColumn("level", (F.sum(F.col("source_size").cast("double")).over(everything) - F.coalesce(F.sum("most").over(below), F.lit(0.0)))
                           / F.sum("w").over(above))
    # The first source, in that order, that the level leaves below its cap: from there on all are.
    level = F.min(F.when(F.col("level") <= F.col("full"), F.struct("full", F.col("source").isNull(), "source", "level"))).over(everything)
    each = each.withColumn("at", level["level"])
    return each.select("s", "source", "source_size", F.coalesce(F.least("most", F.col("w") * F.col("at")), F.col("most")).alias("target"))


def uniform(seed: int, *key: Column) -> Column:
    """A number in (0, 1) that depends on the key alone."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("")) for k in key])
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once. A column that is only named several times would be repeated wherever Spark
    folds projections or pushes a filter, and chains of such columns multiply."""
    return F.transform(F.array(value), then)[0]


def rank(id: Column, source: Column, size: Column, preference: Column, source_size: Column, target: Column, seed: int, cap: float) -> Column:
    """What a source's plan says of a row: size, sure copies, the fraction p left, the rank t in (0, 1), its bin, and a tie-breaker."""
    e = F.when(source_size > 0, F.least(F.lit(cap), target / source_size * preference)).otherwise(0.0)
    given = F.struct(size.alias("size"), e.alias("e"), id.alias("id"))

    def drawn(r):
        return F.struct(r["size"].alias("size"), F.floor(r["e"]).cast("long").alias("sure"), (r["e"] - F.floor(r["e"])).alias("p"),
                        uniform(seed, source, r["id"], r["size"]).alias("u"), F.xxhash64(r["id"], r["size"]).alias("tie"))

    def odds(r):
        q = F.when(r["p"] > 0, (r["u"] / (1 - r["u"])) / (r["p"] / (1 - r["p"])))
        return F.struct(*[r[c].alias(c) for c in ("size", "sure", "p", "tie")], q.alias("q"))

    def placed(r):
        return F.struct(*[r[c].alias(c) for c in ("size", "sure", "p", "tie")], (r["q"] / (1 + r["q"])).alias("t"))

    def binned(r):
        at = F.least(F.floor(r["t"] * BINS), F.lit(BINS - 1)).cast("int")
        return F.struct(*[r[c].alias(c) for c in ("size", "sure", "p", "t", "tie")], at.alias("bin"))

    return let(let(let(let(given, drawn), odds), placed), binned)


def before(r, n: int) -> Column:
    """Whether the ranked row ``r`` (its columns by name) lies before its source's n-th cut-off; the second is for what the first left
    and still fits."""
    edge, last = F.col(f"edge{n}"), F.col(f"last{n}")
    at = F.coalesce((r["bin"] < edge) | ((r["bin"] == edge) & (F.struct(r["t"].alias("t"), r["tie"].alias("tie")) <= last)), F.lit(False))
    return at if n == 1 else ~before(r, 1) & (r["size"] <= F.col("goal2")) & at


def copies(r) -> Column:
    """How often the mix takes the ranked row ``r``, given its source's cut-offs."""
    closing = F.coalesce((r["t"] == F.col("closing.t")) & (r["tie"] == F.col("closing.tie")), F.lit(False))
    return r["sure"] + (before(r, 1) | before(r, 2) | closing).cast("long")


def fill(rows: DataFrame, plan: DataFrame, n: int) -> DataFrame:
    """``plan`` with the n-th cut-off of each source (edge, last: a bin and the last row in it) such that ``rows`` before it add up to
    ``goal`` n at most, and with what is missing then, the next goal. The first goal is what the fractions of the rows add up to."""
    bins = rows.groupBy("s", "bin").agg(F.sum("size").alias("words"), F.sum(F.col("p") * F.col("size")).alias("part"))
    each = Window.partitionBy("s")
    bins = bins.withColumn("upto", F.sum("words").over(each.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)))
    if n == 1:
        bins = bins.withColumn("goal1", F.sum("part").over(each))
    else:
        bins = bins.join(plan.select("s", f"goal{n}"), "s")
    over = F.col("upto") > F.col(f"goal{n}")
    edge = bins.groupBy("s").agg(F.coalesce(F.min(F.when(over, F.col("bin"))), F.lit(BINS)).alias("edge"),
                                 F.coalesce(F.max(F.when(~over, F.col("upto"))), F.lit(0)).alias("fits"), F.max(f"goal{n}").alias("goal"))
    edge = cut(edge, "mix-edges")
    inside = rows.select("s", "bin", "t", "tie", "size").join(edge, "s").where("bin = edge")
    run = Window.partitionBy("s").orderBy("t", "tie").rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("upto", F.col("fits") + F.sum("size").over(run)).where("upto <= goal")
    last = inside.groupBy("s").agg(F.max(F.struct("t", "tie")).alias("last"), F.max("upto").alias("upto"))
    both = edge.join(last, "s", "left").select("s", F.col("edge").alias(f"edge{n}"), F.col("last").alias(f"last{n}"),
                                               (F.col("goal") - F.coalesce("upto", "fits")).alias(f"goal{n + 1}"))
    return cut(plan.join(both, "s", "left"), "mix-plan")


def cut_offs(ranks: DataFrame, plan: DataFrame) -> DataFrame:
    """``plan`` (s, source, source_size, target) with what decides about the rows of ``ranks``: a row is taken once more than its sure
    copies if it lies before the first cut-off, or, being small enough for what is missing there, before the second, or if it is
    ``closing``, the one that then brings the words nearest to the goal, if any does. Every step reads the written ranks."""
    left = {c: F.col(c) for c in ("size", "t", "tie", "bin")}
    some = ranks.where("p > 0")
    plan = fill(some, plan, 1)
    plan = fill(some.join(plan.select("s", "edge1", "last1", "goal2"), "s").where(~before(left, 1) & F.expr("size <= goal2")).select(some.columns), plan, 2)
    missing = F.coalesce("goal3", "goal2")
    off = F.abs(missing - F.col("size"))
    rest = some.join(plan.drop("source", "source_size", "target"), "s").where(~before(left, 1) & ~before(left, 2) & (off < missing))
    closing = rest.groupBy("s").agg(F.min(F.struct(off.alias("off"), "t", "tie")).alias("closing"))
    return cut(plan.join(closing, "s", "left"), "mix-plan")


def sizes(docs: DataFrame, id: str, source: str, text: str, preference: str | None) -> DataFrame:
    liked = F.coalesce(F.col(preference).cast("double"), F.lit(0.0)) if preference else F.lit(1.0)
    got = docs.select(F.col(id).alias("id"), F.col(source).alias("source"), words_of(F.col(text)).alias("size"), liked.alias("preference"))
    if not preference:
        return got
    # Preferences count relative to their source's mean, weighted by size.
    mean = got.groupBy(F.col("source").alias("__source")).agg((F.sum(F.col("preference") * F.col("size")) / F.sum("size")).alias("__mean"))
    got = got.join(mean, got["source"].eqNullSafe(mean["__source"]))
    return got.select("id", "source", "size", F.coalesce(F.col("preference") / F.col("__mean"), F.lit(1.0)).alias("preference"))


def mixed(docs: DataFrame, id: str = "doc_id", source: str = "source", text: str = "text", weights=(1, 2, 3), cap: float = 3.0,
          seed: int = 7, preference: str | None = None) -> DataFrame:
    """One row for each row of ``docs``: id, source, size (words of its text), source_size, target (its source's words in
    the mix), copies (how often the mix takes it), taken (copies * size).

    Sources share 100 % of all sizes by ``weights``, none above ``cap`` times its size. A document is taken at most
    ``ceil(cap)`` times. Null texts have size 0, null sources are one source, the last. Rows equal in source, id and size share their
    fate, also at the cut-off. Reruns agree, whatever the partitioning. An empty table gives an empty mix."""
    ranks, plan = planned(docs, id, source, text, weights, cap, seed, preference)
    taken = copies({c: F.col(c) for c in ("size", "t", "tie", "bin", "sure")})
    got = ranks.join(plan.drop("source", "source_size", "target"), "s").select("id", "source", "size", "source_size", "target", taken.alias("copies"))
    return got.select(F.col("id").alias(id), F.col("source").alias(source), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def planned(docs: DataFrame, id: str, source: str, text: str, weights, cap: float, seed: int, preference: str | None = None):
    """Every row ranked, and every source's cut-offs: two written tables. Sources have a number ``s``, so that no later join
    has to care for the missing one."""
    sized = cut(sizes(docs, id, source, text, preference), "mix-sizes")
    plan = cut(shares(sized, weights, cap), "mix-shares")
    mine = plan.withColumnRenamed("source", "__source")
    r = rank(*map(F.col, ("id", "source", "size", "preference", "source_size", "target")), seed, cap)
    ranks = sized.join(mine, F.col("source").eqNullSafe(F.col("__source"))).select("s", "id", "source", "source_size", "target", r.alias("r"))
    ranks = cut(ranks.select("s", "id", "source", "source_size", "target", "r.*"), "mix-ranks")
    return ranks, cut_offs(ranks, plan)


def mix(docs: DataFrame, id: str = "doc_id", source: str = "source", text: str = "text", weights=(1, 2, 3), cap: float = 3.0, seed: int = 7) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with the columns of ``docs``. Texts are not shuffled:
    the cut-offs, one row a source, come to the rows."""
    _, plan = planned(docs, id, source, text, weights, cap, seed)
    whole = docs.select(F.struct("*").alias("__row")).join(plan, F.col(f"__row.{source}").eqNullSafe(F.col("source")))
    r = rank(F.col(f"__row.{id}"), F.col("source"), words_of(F.col(f"__row.{text}")), F.lit(1.0), F.col("source_size"), F.col("target"), seed, cap)
    taken = whole.select("__row", F.explode(F.array_repeat(F.lit(True), let(r, copies).cast("int"))))
    return taken.select(*[F.col("__row").getField(c).alias(c) for c in docs.columns])


# The same mix for DuckDB: sources are ranked whole, and the level is found by the same running sums.
MIX_SQL = r"""
WITH sized AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s1 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
s2 AS (SELECT *, CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS w, 3.0::DOUBLE * source_size AS most FROM s1),
s3 AS (SELECT *, most / w AS fill FROM s2),
s4 AS (SELECT *, (sum(CAST(source_size AS DOUBLE)) OVER () - coalesce(sum(most) OVER (ORDER BY fill, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
       / sum(w) OVER (ORDER BY fill, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl FROM s3),
s5 AS (SELECT lvl FROM s4 WHERE lvl <= fill ORDER BY fill, source ASC NULLS LAST LIMIT 1),
s6 AS (SELECT source, source_size, coalesce(least(most, w * (SELECT lvl FROM s5)), most) AS target FROM s4),
d1 AS (SELECT d.*, s.source_size, s.target, CASE WHEN s.source_size > 0 THEN least(3.0::DOUBLE, s.target / s.source_size) ELSE 0.0::DOUBLE END AS e
       FROM sized d JOIN s6 s ON d.source IS NOT DISTINCT FROM s.source),
d2 AS (SELECT *, e - floor(e) AS p, (CAST(('0x' || substr(md5('7|' || coalesce(source, '') || '|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || CAST(size AS VARCHAR)), 1, 13)) AS BIGINT) + 0.5::DOUBLE)
       / 4503599627370496.0::DOUBLE AS u FROM d1),
d3 AS (SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS q FROM d2),
d4 AS (SELECT *, sum(p * size) OVER (PARTITION BY source) AS goal, sum(CASE WHEN p > 0 THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY q ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM d3),
d5 AS (SELECT *, p > 0 AND upto <= goal AS a1 FROM d4),
d6 AS (SELECT *, goal - coalesce(max(CASE WHEN a1 THEN upto END) OVER (PARTITION BY source), 0) AS goal2 FROM d5),
d7 AS (SELECT *, p > 0 AND NOT a1 AND size <= goal2 AS small FROM d6),
d8 AS (SELECT *, sum(CASE WHEN small THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY q ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto2 FROM d7),
d9 AS (SELECT *, small AND upto2 <= goal2 AS a2 FROM d8),
d10 AS (SELECT *, goal2 - coalesce(max(CASE WHEN a2 THEN upto2 END) OVER (PARTITION BY source), 0) AS goal3 FROM d9),
d11 AS (SELECT *, p > 0 AND NOT a1 AND NOT a2 AND abs(goal3 - size) < goal3 AS could FROM d10),
d12 AS (SELECT *, could AND row_number() OVER (PARTITION BY source, could ORDER BY abs(goal3 - size), q) = 1 AS closing FROM d11)
SELECT doc_id, size, source_size, target, CAST((floor(e) + CASE WHEN a1 OR a2 OR closing THEN 1 ELSE 0 END) * size AS BIGINT) AS taken FROM d12
"""
