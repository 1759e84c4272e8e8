"""Matching of base reads to a codebook, null models and accuracy tables.

Minimum-Hamming decoding doesn't compare every read with every code.  Codes within
distance k of a read agree with it on at least one of k + 1 stretches of rounds, so
reads and codes meet in an equi-join on (stretch, its bases), and only those pairs are
measured.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.exprs import hamming, hamming_called

#: Codebooks of up to this many codes are broadcast (counted first); larger ones join by shuffle.
BROADCAST_CODES = 200_000


def _stretches(codes: str, rounds: int, parts: int) -> Column:
    """array<struct<part, bases>>: the codes cut into ``parts`` stretches of nearly equal length."""
    cuts = [round(k * rounds / parts) for k in range(parts + 1)]
    return F.array(
        *(
            F.struct(F.lit(k).alias("part"), F.array_join(F.slice(F.col(codes), a + 1, b - a), ",", "-").alias("bases"))
            for k, (a, b) in enumerate(zip(cuts, cuts[1:]))
            if b > a
        )
    )


def close_codes(reads: DataFrame, codebook: DataFrame, rounds: int, k: int, key: str = "puncta_id", small: bool | None = None) -> DataFrame:
    """(key, code_id, name, d): every code within Hamming distance k < rounds of each read."""
    parts = min(k + 1, rounds)
    left = reads.select(key, "bases", F.explode(_stretches("bases", rounds, parts)).alias("s")).select(key, "bases", "s.*")
    left = left.toDF(key, "_read", "part", "stretch")
    right = codebook.select("code_id", "name", "codes", F.explode(_stretches("codes", rounds, parts)).alias("s")).select(
        "code_id", "name", "codes", F.col("s.part").alias("part"), F.col("s.bases").alias("stretch")
    )
    if small is None:
        small = codebook.count() <= BROADCAST_CODES
    met = left.join(F.broadcast(right) if small else right, ["part", "stretch"])
    # a pair that agrees on several stretches counts at the first of them only
    measured = met.withColumn("d", hamming(F.col("_read"), F.col("codes"))).filter(F.col("d") <= k)
    first = F.array_min(
        F.transform(
            F.filter(
                F.arrays_zip(_stretches("_read", rounds, parts).alias("a"), _stretches("codes", rounds, parts).alias("b")),
                lambda z: z["a"]["bases"] == z["b"]["bases"],
            ),
            lambda z: z["a"]["part"],
        )
    )
    return measured.filter(F.col("part") == first).select(key, "code_id", "name", "d")


def decode_min_unique(reads: DataFrame, codebook: DataFrame, rounds: int, max_hamming: int = 2, key: str = "puncta_id") -> DataFrame:
    """(key, hamming, code_id, name): reads whose least distance is within reach and attained by one code alone."""
    hits = close_codes(reads, codebook, rounds, max_hamming, key)
    tied = hits.groupBy(key, "d").agg(F.count("*").alias("n"), F.min(F.struct("code_id", "name")).alias("code"))
    best = tied.groupBy(key).agg(F.min(F.struct("d", "n", "code")).alias("b"))
    return best.filter("b.n = 1").select(key, F.col("b.d").alias("hamming"), "b.code.code_id", "b.code.name")


def decode_within_unique(reads: DataFrame, codebook: DataFrame, rounds: int, k: int = 0, key: str = "puncta_id") -> DataFrame:
    """(key, hamming, code_id, name): reads with exactly one code within distance k at all."""
    hits = close_codes(reads, codebook, rounds, k, key).groupBy(key).agg(
        F.count("*").alias("n"), F.min(F.struct("d", "code_id", "name")).alias("c")
    )
    return hits.filter("n = 1").select(key, F.col("c.d").alias("hamming"), "c.code_id", "c.name")


def decode_exact(reads: DataFrame, codebook: DataFrame, key: str = "puncta_id") -> DataFrame:
    """(key, code_id, name): reads equal to the codes of exactly one entry."""
    single = codebook.groupBy("codes").agg(F.count("*").alias("n"), F.first("code_id").alias("code_id"), F.first("name").alias("name"))
    single = single.filter("n = 1").select(F.col("codes").alias("bases"), "code_id", "name")
    return reads.join(single, "bases").select(key, "code_id", "name")


def decode_called(reads: DataFrame, codebook: DataFrame, rounds: int, key: str = "puncta_id") -> DataFrame:
    """(key, hamming): least distance to any code over the rounds that the read calls (0: not called).

    Uncalled rounds match every code, so the equi-join trick doesn't hold; distinct
    reads (at most 5 ** rounds) are measured instead of all of them.
    """
    distinct = reads.select("bases").distinct()
    codes = codebook.select("codes").distinct()
    least = (
        distinct.withColumn("pattern", F.transform("bases", lambda b: (b != 0)))
        .join(F.broadcast(codes.agg(F.collect_set("codes").alias("all"))))
        .select("bases", F.array_min(F.transform("all", lambda c: hamming_called(F.col("bases"), c))).alias("hamming"))
    )
    return reads.join(least, "bases").select(key, "hamming")


def tie_break(hits: DataFrame, confidence: DataFrame, key: str = "puncta_id", low: float = 10.0, drops: int = 2) -> DataFrame:
    """(key, code_id): the code kept by staged tie-breaking, -1 where none is.

    ``hits``: key, code_id, symbol, transcript, d, mismatches (1-based rounds);
    ``confidence``: key, conf (an array by round).  Codes at the read's least distance
    compete.  A read with more than ``drops`` rounds below ``low`` is given up.  Of the
    others, codes stay whose every mismatch lies in such a round; then a sole gene
    symbol wins (its smallest code), then a sole transcript, then the sole code with a
    transcript at all.
    """
    least = hits.groupBy(key).agg(F.min("d").alias("least"))
    best = hits.join(least, key).filter(F.col("d") == F.col("least")).join(confidence, key)
    weak = F.filter(F.sequence(F.lit(1), F.size("conf")), lambda r: F.element_at("conf", r) < low)
    kept = best.withColumn("weak", weak).filter(
        (F.size("weak") <= drops) & F.forall("mismatches", lambda m: F.array_contains("weak", m))
    )
    aligned = F.when(F.col("transcript") != "NoAlignment", F.col("code_id"))
    chosen = kept.groupBy(key).agg(
        F.count_distinct("symbol").alias("symbols"),
        F.count_distinct("transcript").alias("transcripts"),
        F.count(aligned).alias("aligned"),
        F.min("code_id").alias("first"),
        F.min(aligned).alias("first_aligned"),
    )
    code = (
        F.when((F.col("symbols") == 1) | (F.col("transcripts") == 1), F.col("first"))
        .when(F.col("aligned") == 1, F.col("first_aligned"))
        .otherwise(-1)
    )
    return least.select(key).join(chosen.select(key, code.alias("code_id")), key, "left").fillna(-1, ["code_id"])


def mismatches(assigned: DataFrame, codebook: DataFrame) -> DataFrame:
    """(round, n): over reads (bases, code_id), how often the code differs from the read in each round."""
    joined = assigned.join(codebook.select("code_id", "codes"), "code_id")
    differs = F.zip_with("bases", "codes", lambda a, b: F.when(a.eqNullSafe(b), 0).otherwise(1))
    exploded = joined.select(F.posexplode(differs).alias("pos", "v"))
    return exploded.groupBy((F.col("pos") + 1).alias("round")).agg(F.sum("v").alias("n"))


def mismatch_profile(reads: DataFrame, accepted: DataFrame, codebook: DataFrame, key: str = "puncta_id") -> DataFrame:
    """``mismatches`` of accepted reads, whose codes stand in a table of their own (``key`` names a read in both)."""
    return mismatches(reads.join(accepted.select(key, "code_id"), key), codebook)


def shuffle_columns(reads: DataFrame, rounds: int, seed: int, key: str = "puncta_id", bins: int = 1024) -> DataFrame:
    """Null reads: each round's bases are permuted over the reads independently of the other rounds.

    A round's order is that of a hash of (seed, round, key).  Positions come from bin
    counts plus ranks inside a bin, so no task orders a whole round.
    """
    long = reads.select(key, F.posexplode("bases").alias("r", "base"))
    digest = lambda who: F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(who), F.col("r"), F.col(key)).cast("binary"))
    give, take = _ranked(long.withColumn("h", digest("give")), ["r"], bins), _ranked(long.withColumn("h", digest("take")), ["r"], bins)
    mixed = take.select("r", "rank", F.col(key)).join(give.select("r", "rank", "base"), ["r", "rank"])
    return mixed.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("r", "base"))), lambda s: s["base"]).alias("bases")
    )


def _ranked(df: DataFrame, by: list[str], bins: int) -> DataFrame:
    """``df`` with ``rank``: position from 1 by hash ``h`` (hex) inside each group of ``by``."""
    width = len(f"{bins - 1:x}")
    df = df.withColumn("_bin", F.substring("h", 1, width))
    counts = df.groupBy(*by, "_bin").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.partitionBy(*by).orderBy("_bin").rowsBetween(W.unboundedPreceding, -1))
    starts = counts.withColumn("_start", F.coalesce(before, F.lit(0))).drop("_n")
    inside = F.row_number().over(W.partitionBy(*by, "_bin").orderBy("h"))
    return df.withColumn("_in", inside).join(starts, [*by, "_bin"]).withColumn("rank", F.col("_in") + F.col("_start")).drop("_in", "_start", "_bin")


def funnel(counts: dict[str, DataFrame]) -> DataFrame:
    """(stage, n): rows of each named table, in one union."""
    rows = [df.agg(F.count("*").alias("n")).select(F.lit(stage).alias("stage"), "n") for stage, df in counts.items()]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out


def false_discovery_rate(hits: DataFrame, null_hits: DataFrame) -> DataFrame:
    """One row: aligned reads, aligned null reads and their ratio."""
    both = hits.agg(F.count("*").alias("aligned")).join(null_hits.agg(F.count("*").alias("shuffled")))
    return both.withColumn("fdr", F.try_divide(F.col("shuffled"), F.col("aligned")))


def codebook_from_fasta(lines: DataFrame, value: str = "value") -> DataFrame:
    """(code_id, name, codes) of two-line FASTA records; A, C, G, T are 1..4 and other letters 0.

    ``lines``: value and line (its number from 0).  Headers lose their ``>``.
    """
    letters = F.create_map(*[x for k, c in enumerate("ACGT", 1) for x in (F.lit(c), F.lit(k))])
    named = lines.withColumn("record", F.floor(F.col("line") / 2).cast("long"))
    return named.groupBy("record").agg(
        F.max(F.when(F.col("line") % 2 == 0, F.regexp_replace(value, "^>", ""))).alias("name"),
        F.max(F.when(F.col("line") % 2 == 1, F.upper(F.trim(F.col(value))))).alias("seq"),
    ).select(
        F.col("record").alias("code_id"), "name", F.transform(F.split("seq", ""), lambda c: F.coalesce(letters[c], F.lit(0))).alias("codes")
    )


def disable_single_colour(codebook: DataFrame) -> DataFrame:
    """Codes of one base throughout become -1 in every round."""
    flat = F.size(F.array_distinct("codes")) == 1
    return codebook.withColumn("codes", F.when(flat, F.transform("codes", lambda c: F.lit(-1))).otherwise(F.col("codes")))


def distinct_codes(codebook: DataFrame, rounds: int) -> DataFrame:
    """(codes, code_id, name, n): distinct leading codes, labelled by their first entry up to ``_``."""
    lead = codebook.withColumn("codes", F.slice("codes", 1, rounds))
    return lead.groupBy("codes").agg(F.min("code_id").alias("code_id"), F.min_by("name", "code_id").alias("name"), F.count("*").alias("n")).withColumn(
        "name", F.split("name", "_")[0]
    )
