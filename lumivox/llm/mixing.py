"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A document's key is an exponential variate divided by its quality weight; the
smallest keys of a source form a weighted sample without replacement.  Complete
epochs of a source come first; the rest of its target is filled in key order by
prefix sums of document sizes.

The order inside a source is never sorted as a whole: keys fall into bins whose
sizes are summed (pre-aggregated), and the bins' prefix sums show the one bin in which
the budget ends.  While that bin holds more than ``EDGE_ROWS`` documents, whatever the
weights have made of the keys, it is cut into bins again; then its documents alone are
ordered.  A source that holds a third of all rows therefore costs its bins, not a sort
in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import at_most, materialize, table

#: Weights of the sources by code point, repeating; total share of all sizes; most times a source is taken.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
#: Bins of keys for each source.
BINS = 4096
#: Up to this many documents of a source are ordered in one task.
EDGE_ROWS = 20_000
#: Up to this many sources their totals are broadcast (a few dozen bytes each); beyond, they are joined by shuffle.
BROADCAST_SOURCES = 20_000


def word_count(text: str = "text"):
    """Number of ``[^\\x20\\x09-\\x0D]+``; 0 for null.

    Each word, with the space after it, becomes one sign of a string: ``regexp_count``
    holds an object for every word of a text, many times the text itself.
    """
    signs = F.regexp_replace(F.ltrim(F.col(text), F.lit(" \t\n\v\f\r")), r"[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+", "x")
    return F.coalesce(F.length(signs), F.lit(0)).cast("long")


def quality_weight(text: str = "text"):
    """A weight in (0, 1]: the share of letters, marks of ordinary prose and spaces, floored at 1/16.

    Counted from lengths only, so that it is exact in every engine.
    """
    plain = F.length(F.translate(F.coalesce(F.col(text), F.lit("")), "#$%&*!|{}<>=_0123456789", ""))
    whole = F.length(F.coalesce(F.col(text), F.lit("")))
    return F.when(whole > 0, F.greatest(plain / whole, F.lit(0.0625))).otherwise(F.lit(1.0))


def _uniform(seed: int):
    """A number strictly between 0 and 1 from the md5 of seed, doc_id and text: rows without an id differ, too."""
    text = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(16**12)


def sampling_keys(docs: DataFrame, kept: list[str], seed: int = 8, weight=None) -> DataFrame:
    """source, size, key (-ln(u) / weight: the smaller, the earlier it is drawn), tie, and ``row`` of the ``kept`` columns."""
    weight = quality_weight() if weight is None else weight
    return docs.select(
        F.col("source"),
        word_count().alias("size"),
        (-F.log(_uniform(seed)) / weight).alias("key"),
        F.xxhash64("doc_id", "text").alias("tie"),
        F.struct(*kept).alias("row"),
    )


def source_targets(sizes: DataFrame) -> DataFrame:
    """Per source of ``sizes`` (source, source_size): target, epochs and budget left after whole epochs.

    Sources stand by code point, null last, and weigh 3, 1, 2, repeating.  Together
    their targets are 1.5 times all sizes; a target stops at twice its source's size
    and the excess goes to the others by weight, until none is above: target =
    min(cap, level * weight).  The level is found in closed form: sources fill up in
    the order of cap / weight; as long as they do, what is left for each unit of weight
    rises, and from the first that doesn't it falls, so it is the largest remainder
    that stays under its own source's cap.
    """
    n = len(WEIGHTS)
    order = W.orderBy(F.col("source").asc_nulls_last())
    rank = (F.row_number().over(order) - 1) % n
    weighed = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), rank + 1).cast("double"))
    weighed = weighed.withColumn("cap", (MOST * F.col("source_size")).cast("double"))
    fill = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    left = SHARE * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    heft = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levels = weighed.withColumn("level", left / heft)
    first = F.max(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))).over(everything)
    target = F.least("cap", F.coalesce(first, F.lit(float("inf"))) * F.col("weight"))
    return (
        levels.withColumn("target", target)
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
        .withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
        .select("source", "source_size", "target", F.col("epochs").cast("long"), "budget")
    )


def small(by_source: DataFrame) -> DataFrame:
    """A table of one row a source, cut from its lineage, and marked for broadcast if its counted rows allow that."""
    by_source = materialize(by_source, counted=True)
    return F.broadcast(by_source) if at_most(by_source, BROADCAST_SOURCES) else by_source


def _edges(bins: DataFrame, plan: DataFrame) -> DataFrame:
    """Of each source's bins (source, bin, size, rows, lo, hi) the one in which its budget ends.

    ``plan``: s, start (what lies before the first bin) and budget.  Returns source, lo, hi, rows, start, budget.
    """
    so_far = W.partitionBy("source").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    return (
        bins.withColumn("before", F.coalesce(F.sum("size").over(so_far), F.lit(0)))
        .join(plan, F.col("source").eqNullSafe(F.col("s")))
        .withColumn("before", F.col("start") + F.col("before"))
        .filter((F.col("before") < F.col("budget")) & (F.col("before") + F.col("size") >= F.col("budget")))
        .select("source", "lo", "hi", "rows", F.col("before").alias("start"), "budget")
    )


def _binned(slim: DataFrame, bin_) -> DataFrame:
    return slim.groupBy("source", bin_.alias("bin")).agg(
        F.sum("size").alias("size"), F.count("*").alias("rows"), F.min("key").alias("lo"), F.max("key").alias("hi")
    )


def selection(slim: DataFrame) -> DataFrame:
    """Per source: source_size, target, epochs and where the fractional part's draw ends.

    ``slim``: source, size, key, tie.  Documents are drawn in the order of (key, tie,
    size) while the source stays nearer its target with the next one than without it;
    rows of equal key, tie and size are one draw (``tie``, a hash of id and text, and the
    key make these rows that repeat exactly).  All documents of a key below ``lo`` are
    drawn, and those up to ``last``; both are null where nothing is drawn.
    """
    slim = materialize(slim)
    bins = materialize(_binned(slim, F.floor((1 - F.exp(-F.col("key"))) * BINS).cast("long")))
    targets = small(source_targets(bins.groupBy("source").agg(F.sum("size").alias("source_size"))))
    edge = materialize(_edges(bins, targets.select(F.col("source").alias("s"), F.lit(0).alias("start"), "budget")))
    large = (F.col("rows") > EDGE_ROWS) & (F.col("lo") < F.col("hi"))
    while not edge.filter(large).isEmpty():  # a bin's keys are never all equal here, so each round cuts it
        inside = _inside(slim, small(edge.filter(large)))
        cut = F.floor((F.col("key") - F.col("lo")) / (F.col("hi") - F.col("lo")) * BINS).cast("long")
        bins = _binned(inside.select("source", "size", "key", cut.alias("cut")), F.col("cut"))
        plan = edge.filter(large).select(F.col("source").alias("s"), "start", "budget")
        edge = materialize(edge.filter(~large).unionByName(_edges(bins, plan)))
    edge = small(edge)
    order = W.partitionBy("source").orderBy("key", "tie", "size").rowsBetween(W.unboundedPreceding, 0)
    last = (
        _inside(slim, edge)
        .groupBy("source", "key", "tie", "size", "start", "budget")
        .agg(F.sum("size").alias("all"))
        .withColumn("upto", F.col("start") + F.sum("all").over(order))
        .filter(F.col("upto") - F.col("all") / 2 < F.col("budget"))
        .groupBy("source")
        .agg(F.max(F.struct("key", "tie", "size")).alias("last"))
    )
    # where not even the first document of the edge bin is drawn, those before it are
    marks = edge.join(last.withColumnRenamed("source", "m"), F.col("source").eqNullSafe(F.col("m")), "left").select(F.col("source").alias("m"), "lo", "last")
    return targets.join(marks, F.col("source").eqNullSafe(F.col("m")), "left").select("source", "source_size", "target", "epochs", "lo", "last")


def _inside(slim: DataFrame, edge: DataFrame) -> DataFrame:
    """The rows of ``slim`` in their source's edge bin, with its bounds."""
    e = edge.select(F.col("source").alias("s"), "lo", "hi", "start", "budget")
    return slim.join(e, F.col("source").eqNullSafe(F.col("s")) & F.col("key").between(F.col("lo"), F.col("hi"))).drop("s")


def mix_sources(docs: DataFrame, seed: int = 8, weight=None) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``taken`` (words that the mix takes of it).

    ``docs``: doc_id, text, source and any further columns, which are kept whatever their
    names (columns of the four new names are replaced).  ``weight``: quality weights as a
    positive column, by default ``quality_weight``.  Null texts have size 0 and are never
    taken; null sources form a source that stands last.  Rows that repeat exactly (same
    doc_id and text) are drawn together.  A source of no words has target 0.  Equal
    inputs give equal mixes.  No document is taken more than twice; each source's taken
    words differ from its target by at most half of the document at the edge, repeats of
    it included.  An empty table gives no rows.
    """
    kept = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken")]
    return draw(sampling_keys(docs, kept, seed, weight), kept)


def draw(keyed: DataFrame, kept: list[str]) -> DataFrame:
    """``kept`` columns of ``keyed`` (as ``sampling_keys`` makes it) with the mix's decisions."""
    plan = small(selection(keyed.select("source", "size", "key", "tie"))).withColumnRenamed("source", "s")
    own = F.struct("key", "tie", keyed["size"].alias("size"))
    drawn = F.coalesce((F.col("key") < F.col("lo")) | (own <= F.col("last")), F.lit(False))
    return keyed.join(plan, F.col("source").eqNullSafe(F.col("s"))).select(
        *(F.col("row").getField(c).alias(c) for c in kept),
        F.col("size"),
        "source_size",
        "target",
        (F.col("size") * (F.col("epochs") + drawn.cast("long"))).alias("taken"),
    )


def op8_source_mixing(spark, sf_dir: str) -> DataFrame:
    """The mix of all documents by source; texts are read once, for sizes and weights."""
    return draw(materialize(sampling_keys(table(spark, sf_dir, "documents"), ["doc_id"])), ["doc_id"])


SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    -ln((CAST('0x' || substr(md5('8:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 12) AS BIGINT) + 0.5) / 281474976710656.0)
      / CASE WHEN length(text) > 0 THEN greatest(
          CAST(length(translate(text, '#$%&*!|{}<>=_0123456789', '')) AS DOUBLE) / length(text), 0.0625) ELSE 1.0 END AS key
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS DOUBLE) AS source_size FROM d GROUP BY source),
w AS (SELECT *, 2 * source_size AS cap,
        CAST(([3, 1, 2])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight FROM s),
l AS (SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0))
        / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level FROM w
      WINDOW b AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT *, least(cap, coalesce(max(level) FILTER (WHERE level <= cap / weight) OVER (), 'infinity'::DOUBLE) * weight) AS target
      FROM l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM t),
o AS (SELECT d.*, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS budget,
        sum(d.size) OVER (PARTITION BY d.source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS upto
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
  CAST(size * (epochs + CASE WHEN budget > 0 AND upto - size / 2.0 < budget THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM o
"""
