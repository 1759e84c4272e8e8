"""Registered queries and their SQL oracles: each operator over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import basecall, decode, kernels, match, normalize, puncta, register, simulate, tiles, volume
from ..sources import readers, sinks
from .fixtures import frame, sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

ROUNDS = 6


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its oracle."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = oracle
        return f

    return add


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


PIXELS, CODES, READS, VOXELS, POSITIONS, POINTS, TILES = (sql(n) for n in ("pixels_base", "codebook", "reads", "voxels", "positions", "points", "tiles"))

# --- normalisation ---------------------------------------------------------------------------------------------


def _norm_oracle(ties: str, by: str) -> str:
    key = f"{by}, " if by else ""
    part = f"PARTITION BY {key}channel" if by else "PARTITION BY channel"
    agg = "median(m)" if ties == "median" else "avg(m)"
    return f"""
WITH long AS (SELECT {key}1 AS channel, c1 AS value FROM {PIXELS} UNION ALL SELECT {key}2, c2 FROM {PIXELS}
              UNION ALL SELECT {key}3, c3 FROM {PIXELS} UNION ALL SELECT {key}4, c4 FROM {PIXELS}),
r AS (SELECT *, row_number() OVER ({part} ORDER BY value) AS k FROM long),
m AS (SELECT {key}k, avg(value) AS m FROM r GROUP BY {key}k)
SELECT {key}CAST(channel AS INTEGER) AS channel, value, round({agg}, 6) AS norm FROM r JOIN m USING ({key}k)
GROUP BY {key}channel, value"""


@query(_norm_oracle("median", "round"))
def qnorm_median(spark, d):
    """Value tables of quantile normalisation by round; ties take the median."""
    return rounded(normalize.rank_values(frame(spark, d, "pixels_base"), ["round"], ties="median"), "norm")


@query(_norm_oracle("mean", "round"))
def qnorm_mean(spark, d):
    return rounded(normalize.rank_values(frame(spark, d, "pixels_base"), ["round"], ties="mean"), "norm")


@query(_norm_oracle("median", ""))
def qnorm_pooled(spark, d):
    return rounded(normalize.rank_values(frame(spark, d, "pixels_base"), [], ties="median"), "norm")


@query(
    f"""WITH n AS ({_norm_oracle("median", "round")}), p AS {PIXELS}
SELECT puncta_id, round, c1, c2, c3, c4, n1.norm AS norm1, n2.norm AS norm2, n3.norm AS norm3, n4.norm AS norm4
FROM p {" ".join(f"JOIN (SELECT round AS r{k}, value AS v{k}, norm FROM n WHERE channel = {k}) n{k} ON round = r{k} AND c{k} = v{k}" for k in range(1, 5))}"""
)
def qnorm_pixels(spark, d):
    """Every pixel with its four normalised values."""
    out = normalize.quantile_normalize(frame(spark, d, "pixels_base"), ["round"])
    return rounded(out, "norm1", "norm2", "norm3", "norm4")


@query(
    f"""SELECT puncta_id, round, round((c1 - avg(c1) OVER w) / stddev_samp(c1) OVER w, 6) AS z
FROM {PIXELS} WINDOW w AS (PARTITION BY round)"""
)
def zscore_by_round(spark, d):
    out = normalize.zscore(frame(spark, d, "pixels_base"), "c1", ["round"])
    return rounded(out.select("puncta_id", "round", "z"), "z")


@query(f"SELECT {', '.join(f'round(2 * avg(c{k}), 6) AS cut_c{k}' for k in range(1, 5))} FROM {PIXELS}")
def exponential_cutoffs(spark, d):
    return rounded(normalize.exponential_cutoff(frame(spark, d, "pixels_base")), *(f"cut_c{k}" for k in range(1, 5)))


@query()
def whiten_channels(spark, d):
    """Covariances of the whitened channels (the identity)."""
    w = normalize.whiten(frame(spark, d, "pixels_base"))
    pairs = [(i, j) for i in range(1, 5) for j in range(i, 5)]
    return w.agg(*(F.round(F.covar_samp(f"white{i}", f"white{j}"), 4).alias(f"cov{i}{j}") for i, j in pairs))


# --- base calling and decoding ---------------------------------------------------------------------------------

_CALLS = f"""
WITH p AS (SELECT puncta_id, round, {", ".join(f"quantile_cont(c{k}, 0.9) AS p{k}" for k in range(1, 5))} FROM {PIXELS} GROUP BY ALL),
calls AS (SELECT *, CASE WHEN least(p1, p2, p3, p4) = 0 OR least(p1, p2, p3, p4) = greatest(p1, p2, p3, p4) THEN 0
  WHEN p1 = greatest(p1, p2, p3, p4) THEN 1 WHEN p2 = greatest(p2, p3, p4) THEN 2 WHEN p3 >= p4 THEN 3 ELSE 4 END AS base FROM p)"""


def _calls(spark, d):
    return basecall.base_calls(frame(spark, d, "pixels_base"))


@query(f"{_CALLS} SELECT puncta_id, round, round(p1, 6) AS p1, round(p2, 6) AS p2, round(p3, 6) AS p3, round(p4, 6) AS p4, base FROM calls")
def base_call(spark, d):
    """90th percentile of each channel and the call of every punctum and round."""
    return rounded(_calls(spark, d), "p1", "p2", "p3", "p4")


@query(
    f"""WITH s AS (SELECT puncta_id, round, c2, row_number() OVER w AS k, count(*) OVER (PARTITION BY puncta_id, round) AS n
  FROM {PIXELS} WINDOW w AS (PARTITION BY puncta_id, round ORDER BY c2)),
a AS (SELECT *, greatest(1.0, least(n, n * 0.9 + 0.5)) AS pos FROM s)
SELECT puncta_id, round, round(max(CASE WHEN k = floor(pos) THEN c2 END)
  + (max(pos) - floor(max(pos))) * (max(CASE WHEN k = least(floor(pos) + 1, n) THEN c2 END) - max(CASE WHEN k = floor(pos) THEN c2 END)), 6)::DOUBLE AS p1
FROM a GROUP BY puncta_id, round"""
)
def midpoint_percentiles(spark, d):
    out = basecall.channel_percentiles(frame(spark, d, "pixels_base"), ["puncta_id", "round"], ["c2"], 0.9, "midpoint")
    return rounded(out, "p1")


@query(
    f"""WITH p AS (SELECT puncta_id, round, {", ".join(f"quantile_cont(c{k}, 0.99) AS p{k}" for k in range(1, 5))} FROM {PIXELS} GROUP BY ALL),
c AS (SELECT puncta_id, round, {", ".join(f"CASE WHEN p{k} > {300 + 50 * k} THEN p{k} ELSE 0 END AS q{k}" for k in range(1, 5))} FROM p)
SELECT puncta_id, round, CASE WHEN greatest(q1, q2, q3, q4) = 0 THEN 0 WHEN q1 = greatest(q1, q2, q3, q4) THEN 1
  WHEN q2 = greatest(q2, q3, q4) THEN 2 WHEN q3 >= q4 THEN 3 ELSE 4 END AS base FROM c"""
)
def cutoff_calls(spark, d):
    return basecall.cutoff_calls(frame(spark, d, "pixels_base"), [350, 400, 450, 500]).select("puncta_id", "round", "base")


@query(f"{_CALLS} SELECT puncta_id, round, CASE WHEN base = 1 AND p2 <> 0 AND abs(p2 - p1) / p2 < 0.5 THEN 2 ELSE base END AS base FROM calls")
def bleed_correction(spark, d):
    return basecall.bleed_correction(_calls(spark, d), 0.5).select("puncta_id", "round", "base")


@query(
    f"""{_CALLS}, n AS (SELECT round, base, count(*) AS n FROM calls WHERE base > 0 GROUP BY ALL)
SELECT round, base, n, round(n / sum(n) OVER (PARTITION BY round), 6) AS fraction FROM n"""
)
def base_percentages(spark, d):
    return rounded(basecall.base_percentages(_calls(spark, d)), "fraction")


@query(
    f"""{_CALLS}, n AS (SELECT base, count(*) AS n FROM calls WHERE base > 0 GROUP BY ALL)
SELECT base, n, round(n / sum(n) OVER (), 6) AS fraction FROM n"""
)
def base_percentages_overall(spark, d):
    return rounded(basecall.base_percentages(_calls(spark, d), []), "fraction")


@query(
    f"""WITH n AS (SELECT round, c2 AS v, count(*) AS n FROM {PIXELS} GROUP BY ALL),
p AS (SELECT round, n / sum(n) OVER (PARTITION BY round) AS p FROM n)
SELECT round, round(-sum(p * log2(p)), 6) AS entropy FROM p GROUP BY round"""
)
def value_entropy(spark, d):
    return rounded(basecall.entropy(frame(spark, d, "pixels_base"), "c2", ["round"]), "entropy")


_PAIRS = f"""
WITH reads AS (SELECT DISTINCT bases FROM {READS}), codes AS {CODES},
h AS (SELECT bases, code_id, name, {" + ".join(f"CASE WHEN bases[{r}] <> codes[{r}] THEN 1 ELSE 0 END" for r in range(1, ROUNDS + 1))} AS d FROM reads, codes),
best AS (SELECT bases, min(d) AS hamming, arg_min(code_id, d * 1000000 + code_id) AS code_id, arg_min(name, d * 1000000 + code_id) AS name FROM h GROUP BY bases),
ties AS (SELECT bases, count(*) AS n FROM h JOIN best USING (bases) WHERE d = hamming GROUP BY bases),
within AS (SELECT bases, count(*) AS n, min(d) AS hamming, min(code_id) AS code_id, min(name) AS name FROM h WHERE d <= 1 GROUP BY bases),
accepted AS (SELECT * FROM best JOIN ties USING (bases) WHERE hamming <= 2 AND n = 1),
all_reads AS {READS}"""


def _reads(spark, d):
    return frame(spark, d, "reads")


def _decoded(spark, d):
    """Distinct reads are decoded once; rows follow by join."""
    reads = _reads(spark, d)
    unique = reads.select("bases").distinct().withColumn("puncta_id", F.array_join("bases", ""))
    hits = decode.decode_min_unique(unique, frame(spark, d, "codebook"), ROUNDS, 2)
    return reads.withColumnRenamed("puncta_id", "id").withColumn("puncta_id", F.array_join("bases", "")).join(hits, "puncta_id").select(
        F.col("id").alias("puncta_id"), "bases", "hamming", "code_id", "name"
    )


@query(f"{_PAIRS} SELECT puncta_id, bases, hamming, a.code_id, a.name FROM all_reads JOIN accepted a USING (bases)")
def hamming_min_unique(spark, d):
    """Reads with one nearest code within distance 2."""
    return _decoded(spark, d)


@query(f"{_PAIRS} SELECT puncta_id, hamming, w.code_id, w.name FROM all_reads JOIN within w USING (bases) WHERE w.n = 1")
def hamming_within_unique(spark, d):
    reads = _reads(spark, d)
    unique = reads.select("bases").distinct().withColumn("read", F.array_join("bases", ""))
    hits = decode.decode_within_unique(unique, frame(spark, d, "codebook"), ROUNDS, 1, "read")
    return reads.withColumn("read", F.array_join("bases", "")).join(hits, "read").select("puncta_id", "hamming", "code_id", "name")


@query(
    f"""WITH c AS (SELECT codes, count(*) AS n, min(code_id) AS code_id, min(name) AS name FROM {CODES} GROUP BY codes)
SELECT puncta_id, code_id, name FROM {READS} r JOIN c ON r.bases = c.codes WHERE n = 1"""
)
def hamming_exact(spark, d):
    return decode.decode_exact(_reads(spark, d), frame(spark, d, "codebook"))


@query(
    f"""WITH h AS (SELECT bases, min({" + ".join(f"CASE WHEN bases[{r}] <> 0 AND bases[{r}] <> codes[{r}] THEN 1 ELSE 0 END" for r in range(1, ROUNDS + 1))}) AS hamming
  FROM (SELECT DISTINCT bases FROM {READS}), (SELECT DISTINCT codes FROM {CODES}) GROUP BY bases)
SELECT puncta_id, hamming FROM {READS} JOIN h USING (bases)"""
)
def hamming_called_rounds(spark, d):
    return decode.decode_called(_reads(spark, d), frame(spark, d, "codebook"), ROUNDS)


@query(f"{_PAIRS} SELECT a.name AS gene, count(*) AS count FROM all_reads JOIN accepted a USING (bases) GROUP BY a.name")
def decode_gene_counts(spark, d):
    """Decoded reads per gene: the flagship query."""
    return sinks.gene_counts(_decoded(spark, d))


@query(
    f"""{_PAIRS} SELECT CAST(r AS INTEGER) AS round, CAST(sum(CASE WHEN bases[r] <> codes[r] THEN 1 ELSE 0 END) AS BIGINT) AS n
FROM (SELECT bases, c.codes, unnest(range(1, {ROUNDS} + 1)) AS r FROM all_reads JOIN accepted a USING (bases) JOIN codes c ON c.code_id = a.code_id) GROUP BY r"""
)
def mismatch_profile(spark, d):
    return decode.mismatches(_decoded(spark, d).select("bases", "code_id"), frame(spark, d, "codebook"))


def _null_reads(spark, d):
    one = _reads(spark, d).groupBy("puncta_id").agg(F.min("bases").alias("bases"))
    return one, decode.shuffle_columns(one, ROUNDS, seed=7)


@query(
    f"""WITH one AS (SELECT puncta_id, min(bases) AS bases FROM {READS} GROUP BY puncta_id),
long AS (SELECT puncta_id, r, bases[r + 1] AS base FROM (SELECT *, unnest(range(0, {ROUNDS})) AS r FROM one)),
k AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY md5('7:give:' || r || ':' || puncta_id)) AS give,
  row_number() OVER (PARTITION BY r ORDER BY md5('7:take:' || r || ':' || puncta_id)) AS take FROM long)
SELECT t.puncta_id, list(g.base ORDER BY t.r) AS bases FROM k t JOIN k g ON t.r = g.r AND t.take = g.give GROUP BY t.puncta_id"""
)
def shuffle_null_reads(spark, d):
    """Reads whose rounds are permuted independently."""
    return _null_reads(spark, d)[1]


@query(
    f"""WITH one AS (SELECT puncta_id, min(bases) AS bases FROM {READS} GROUP BY puncta_id),
long AS (SELECT puncta_id, r, bases[r + 1] AS base FROM (SELECT *, unnest(range(0, {ROUNDS})) AS r FROM one)),
k AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY md5('7:give:' || r || ':' || puncta_id)) AS give,
  row_number() OVER (PARTITION BY r ORDER BY md5('7:take:' || r || ':' || puncta_id)) AS take FROM long),
null_reads AS (SELECT list(g.base ORDER BY t.r) AS bases FROM k t JOIN k g ON t.r = g.r AND t.take = g.give GROUP BY t.puncta_id),
c AS (SELECT codes FROM {CODES} GROUP BY codes HAVING count(*) = 1),
n AS (SELECT (SELECT count(*) FROM one JOIN c ON bases = codes) AS aligned, (SELECT count(*) FROM null_reads JOIN c ON bases = codes) AS shuffled)
SELECT aligned, shuffled, round(CASE WHEN aligned > 0 THEN shuffled / aligned END, 6) AS fdr FROM n"""
)
def shuffle_fdr(spark, d):
    one, shuffled = _null_reads(spark, d)
    codes = frame(spark, d, "codebook")
    return rounded(decode.false_discovery_rate(decode.decode_exact(one, codes), decode.decode_exact(shuffled, codes)), "fdr")


@query(
    f"""{_PAIRS} SELECT 'segmented' AS stage, count(*) AS n FROM all_reads
UNION ALL SELECT 'complete', count(*) FROM all_reads WHERE NOT list_contains(bases, 0)
UNION ALL SELECT 'aligned', count(*) FROM all_reads JOIN accepted USING (bases)"""
)
def read_funnel(spark, d):
    reads = _reads(spark, d)
    return decode.funnel({"segmented": reads, "complete": basecall.complete_reads(reads), "aligned": _decoded(spark, d)})


@query(f"SELECT bases, count(*) AS n FROM {READS} GROUP BY bases")
def barcode_histogram(spark, d):
    return _reads(spark, d).groupBy("bases").agg(F.count("*").alias("n"))


@query(
    f"""SELECT codes[1:4] AS codes, min(code_id) AS code_id, split_part(arg_min(name, code_id), '_', 1) AS name, count(*) AS n
FROM {CODES} GROUP BY codes[1:4]"""
)
def codebook_dedup(spark, d):
    return decode.distinct_codes(frame(spark, d, "codebook"), 4)


@query(f"SELECT code_id, name, CASE WHEN len(list_distinct(codes[1:2])) = 1 THEN [-1, -1] ELSE codes[1:2] END AS codes FROM {CODES}")
def disable_single_colour(spark, d):
    return decode.disable_single_colour(frame(spark, d, "codebook").withColumn("codes", F.slice("codes", 1, 2)))


@query(f"SELECT code_id, list_transform(codes, lambda c: [2, 1, 4, 3][c]) AS codes FROM {CODES}")
def permute_bases(spark, d):
    return frame(spark, d, "codebook").select("code_id", X.permute_bases(F.col("codes")).alias("codes"))


@query(
    f"""{_PAIRS.replace("all_reads AS", "unused AS")}, cand AS (
  SELECT bases, h.code_id, h.name AS symbol, CASE WHEN h.code_id % 3 = 0 THEN 'NoAlignment' ELSE 'T' || (h.code_id % 50) END AS transcript,
    list_filter([{", ".join(f"CASE WHEN bases[{r}] <> codes[{r}] THEN {r} END" for r in range(1, ROUNDS + 1))}], lambda v: v IS NOT NULL) AS mm, h.d
  FROM h JOIN codes USING (code_id) WHERE h.d <= 2),
least AS (SELECT bases, min(d) AS d FROM cand GROUP BY bases),
conf AS (SELECT bases, list_filter([{", ".join(f"CASE WHEN (bases[{r}] * 7 + {r}) % 20 < 10 THEN {r} END" for r in range(1, ROUNDS + 1))}], lambda v: v IS NOT NULL) AS weak FROM reads),
kept AS (SELECT c.* FROM cand c JOIN least USING (bases, d) JOIN conf USING (bases)
  WHERE len(weak) <= 3 AND len(list_filter(mm, lambda m: NOT list_contains(weak, m))) = 0),
chosen AS (SELECT bases, CASE WHEN count(DISTINCT symbol) = 1 OR count(DISTINCT transcript) = 1 THEN min(code_id)
  WHEN count(*) FILTER (WHERE transcript <> 'NoAlignment') = 1 THEN min(code_id) FILTER (WHERE transcript <> 'NoAlignment') ELSE -1 END AS code_id
  FROM kept GROUP BY bases)
SELECT array_to_string(bases, '') AS read, coalesce(code_id, -1) AS code_id FROM least LEFT JOIN chosen USING (bases)"""
)
def tie_break(spark, d):
    """Staged tie-breaking of every distinct read by confidence, gene and transcript."""
    reads = _reads(spark, d).select("bases").distinct().withColumn("read", F.array_join("bases", ""))
    codes = frame(spark, d, "codebook")
    hits = decode.close_codes(reads, codes, ROUNDS, 2, "read").withColumnRenamed("name", "symbol")
    hits = hits.join(codes.select("code_id", "codes"), "code_id").join(reads, "read")
    places = F.filter(F.sequence(F.lit(1), F.lit(ROUNDS)), lambda r: F.element_at("bases", r) != F.element_at("codes", r))
    hits = hits.withColumn("mismatches", places).withColumn(
        "transcript", F.when(F.col("code_id") % 3 == 0, "NoAlignment").otherwise(F.concat(F.lit("T"), F.col("code_id") % 50))
    )
    conf = reads.select("read", F.transform("bases", lambda b, i: ((b * 7 + i + 1) % 20).cast("double")).alias("conf"))
    return decode.tie_break(hits, conf, "read", 10.0, 3)


# --- puncta ----------------------------------------------------------------------------------------------------


@query(
    f"""WITH m AS (SELECT puncta_id, round, {" + ".join(f"CAST(median(c{k}) = 0 AS INT)" for k in range(1, 5))} AS zero FROM {PIXELS} GROUP BY ALL)
SELECT puncta_id, CAST(count(*) FILTER (WHERE zero > 3) AS BIGINT) AS missing FROM m GROUP BY puncta_id HAVING count(*) FILTER (WHERE zero > 3) <= 2"""
)
def signal_complete(spark, d):
    return puncta.signal_complete(frame(spark, d, "pixels_base"), 2)


@query(
    f"""WITH r AS (SELECT puncta_id, round, avg(c1) > 800 AND avg(c2) > 800 AS bright FROM {PIXELS} GROUP BY ALL)
SELECT puncta_id FROM r GROUP BY puncta_id HAVING NOT bool_or(bright)"""
)
def artifact_filter(spark, d):
    return puncta.drop_artifacts(frame(spark, d, "pixels_base"), ["c1", "c2"], 800)


@query(f"SELECT puncta_id, count(*) AS n_voxels FROM {PIXELS} GROUP BY puncta_id HAVING count(*) BETWEEN 3 AND 6")
def size_filter(spark, d):
    sizes = frame(spark, d, "pixels_base").groupBy("puncta_id").agg(F.count("*").alias("n_voxels"))
    return puncta.filter_by_size(sizes, 3, 6)


@query(
    f"""SELECT * FROM {PIXELS} WHERE least(c1, c2, c3, c4) > 0
AND CAST(c1 > 900 AS INT) + CAST(c2 > 900 AS INT) + CAST(c3 > 800 AS INT) + CAST(c4 > 800 AS INT) < 2"""
)
def nonzero_junk_masks(spark, d):
    return puncta.junk_mask(puncta.nonzero_mask(frame(spark, d, "pixels_base")), [900, 900, 800, 800], 2)


@query(
    f"""SELECT puncta_id, round, {", ".join(f"CAST(median(c{k}) AS DOUBLE) AS med{k}, max(c{k}) AS max{k}" for k in range(1, 5))} FROM {PIXELS} GROUP BY ALL"""
)
def median_max(spark, d):
    return puncta.channel_stats(frame(spark, d, "pixels_base"))


@query(
    f"""WITH l AS (SELECT round, puncta_id % 50 AS bin, 1 AS channel, c1 AS v FROM {PIXELS} UNION ALL SELECT round, puncta_id % 50, 2, c2 FROM {PIXELS}
  UNION ALL SELECT round, puncta_id % 50, 3, c3 FROM {PIXELS} UNION ALL SELECT round, puncta_id % 50, 4, c4 FROM {PIXELS}),
k AS (SELECT *, row_number() OVER (PARTITION BY round, bin, channel ORDER BY v DESC) AS k FROM l)
SELECT round, bin, CAST(channel AS INTEGER) AS channel, round(avg(v), 6) AS top FROM k WHERE k <= 5 GROUP BY ALL"""
)
def top_mean(spark, d):
    rows = frame(spark, d, "pixels_base").withColumn("bin", F.col("puncta_id") % 50)
    return rounded(puncta.top_mean(rows, 5, ["round", "bin"]), "top")


_SUMMED = f"(SELECT y, x, z, CAST(sum(value) AS BIGINT) AS value FROM {VOXELS} GROUP BY ALL)"


@query(
    f"""SELECT x AS label, count(*) AS n_voxels, round(sum(y * value) / sum(value), 6) AS cy, round(sum(x * value) / sum(value), 6) AS cx,
  round(sum(z * value) / sum(value), 6) AS cz, list(CAST(y + (x - 1) * 50 + (z - 1) * 600 AS INTEGER) ORDER BY y + (x - 1) * 50 + (z - 1) * 600) AS voxels
FROM {_SUMMED} GROUP BY x"""
)
def weighted_centroids(spark, d):
    v = volume.sum_channels(frame(spark, d, "voxels"), volume.AXES)
    v = v.withColumn("lin_idx", X.sub2ind(50, 12, F.col("y"), F.col("x"), F.col("z"))).withColumn("label", F.col("x"))
    return rounded(puncta.label_puncta(v), "cy", "cx", "cz")


@query(f"SELECT z AS label, count(*) AS n_voxels, round(avg(y), 6) AS cy, round(avg(x), 6) AS cx, round(avg(z), 6) AS cz FROM {VOXELS} GROUP BY z")
def plain_centroids(spark, d):
    return rounded(puncta.centroids(frame(spark, d, "voxels").withColumn("label", F.col("z")), "label"), "cy", "cx", "cz")


_WIDE = f"""(SELECT round, y, x, z, {", ".join(f"CAST(coalesce(sum(value) FILTER (WHERE channel = '{c}'), 0) AS BIGINT) AS c{k}" for k, c in ((1, "A"), (2, "N"), (3, "R")))},
  CAST(0 AS BIGINT) AS c4 FROM {VOXELS} GROUP BY round, y, x, z)"""


def _wide(spark, d):
    v = frame(spark, d, "voxels")
    sums = [F.coalesce(F.sum(F.when(F.col("channel") == c, F.col("value"))), F.lit(0)).alias(f"c{k}") for k, c in ((1, "A"), (2, "N"), (3, "R"))]
    return v.groupBy("round", "y", "x", "z").agg(*sums).withColumn("c4", F.lit(0).cast("long"))


@query(
    f"""WITH p AS (SELECT DISTINCT CAST(s_suppkey % 20 AS BIGINT) AS puncta_id, CAST(s_suppkey % 50 + 1 AS INT) AS y, CAST(s_suppkey % 12 + 1 AS INT) AS x, 3 AS z FROM supplier),
v AS {_WIDE}, r AS (SELECT DISTINCT round FROM v)
SELECT puncta_id, p.y, p.x, p.z, r.round, coalesce(c1, 0) AS c1, coalesce(c2, 0) AS c2, coalesce(c3, 0) AS c3, coalesce(c4, 0) AS c4
FROM p CROSS JOIN r LEFT JOIN v ON v.y = p.y AND v.x = p.x AND v.z = p.z AND v.round = r.round"""
)
def gather_pixels(spark, d):
    s = F.col("s_suppkey")
    at = frame(spark, d, "supplier").select(
        (s % 20).alias("puncta_id"), (s % 50 + 1).cast("int").alias("y"), (s % 12 + 1).cast("int").alias("x"), F.lit(3).alias("z")
    )
    return puncta.gather_pixels(at.distinct(), _wide(spark, d))


@query(
    f"""WITH t AS (SELECT x AS id, y AS step, CAST(sum(value) AS DOUBLE) AS value FROM {VOXELS} GROUP BY ALL),
e AS (SELECT a.id AS peak, b.id AS neighbour, corr(a.value, b.value) AS r, sum(b.value) AS s FROM t a JOIN t b ON a.step = b.step AND abs(a.id - b.id) = 1 GROUP BY ALL)
SELECT peak, round(sum(CASE WHEN r > 0.1 THEN s ELSE 0 END), 3) AS corr_sum, count(*) FILTER (WHERE r > 0.1) AS n FROM e GROUP BY peak"""
)
def correlated_neighbours(spark, d):
    t = frame(spark, d, "voxels").groupBy(F.col("x").alias("id"), F.col("y").alias("step")).agg(F.sum("value").cast("double").alias("value"))
    pairs = spark.range(1, 13).select(F.col("id").cast("int").alias("peak"), F.explode(F.array((F.col("id") - 1).cast("int"), (F.col("id") + 1).cast("int"))).alias("neighbour"))
    return rounded(puncta.correlated_mean(t, pairs, 0.1), "corr_sum", digits=3)


@query("SELECT event_id FROM events ORDER BY md5('3:' || event_id), event_id LIMIT 100")
def random_sample(spark, d):
    """100 rows without replacement (the sampling operator itself)."""
    return puncta.sample(frame(spark, d, "events").select("event_id"), 100, 3, "event_id")


@query(f"SELECT id, y, x, z FROM {POINTS} WHERE sqrt(y * y + x * x + z * z) <= 25")
def points_in_radius(spark, d):
    return puncta.near_points(frame(spark, d, "points"), (0.0, 0.0, 0.0), 25).select("id", "y", "x", "z")


@query(
    f"""WITH f AS (SELECT * FROM {_SUMMED} WHERE value > 1000), c AS (SELECT value AS cut FROM f ORDER BY value DESC LIMIT 1 OFFSET 41)
SELECT y, x, z, value FROM f, c WHERE (SELECT count(*) FROM f) <= 42 OR value > cut"""
)
def brightest_peaks(spark, d):
    return puncta.brightest_peaks(volume.sum_channels(frame(spark, d, "voxels"), volume.AXES), 4200, 1000, 100)


# --- volumes ---------------------------------------------------------------------------------------------------


@query(f"SELECT round, y, x, z, CAST(sum(value) AS BIGINT) AS value FROM {VOXELS} GROUP BY ALL")
def channel_sum(spark, d):
    return volume.sum_channels(frame(spark, d, "voxels"))


@query(f"SELECT y, x, z, round(avg(value), 6) AS value FROM {VOXELS} GROUP BY ALL")
def channel_mean(spark, d):
    return rounded(volume.mean_volumes(frame(spark, d, "voxels")), "value")


_ROUND_SUM = f"(SELECT round, y, x, z, CAST(sum(value) AS BIGINT) AS value FROM {VOXELS} GROUP BY ALL)"


@query(
    f"""WITH s AS {_ROUND_SUM}, c AS (SELECT round, quantile_cont(value, 0.99) AS cut FROM s GROUP BY round),
k AS (SELECT s.round, y, x, z, least(value, cut) AS value FROM s JOIN c ON s.round = c.round)
SELECT round, y, x, z, round((value - min(value) OVER w) / max(value) OVER w * 65535, 4) AS value FROM k WINDOW w AS (PARTITION BY round)"""
)
def clamp_rescale(spark, d):
    v = volume.sum_channels(frame(spark, d, "voxels"))
    return rounded(volume.rescale(volume.clamp_percentile(v, p=0.99)), "value", digits=4)


_DENSE = f"""(SELECT r.round, g.y, g.x, g.z, coalesce(v.value, 0) AS value FROM (SELECT DISTINCT round FROM {VOXELS}) r
  CROSS JOIN (SELECT DISTINCT y, x, z FROM {VOXELS}) g LEFT JOIN {_ROUND_SUM} v ON v.round = r.round AND v.y = g.y AND v.x = g.x AND v.z = g.z)"""


def _zero_counts(spark, d):
    """Zeros are rounds without a voxel at a place: counted, not filled in."""
    v = volume.sum_channels(frame(spark, d, "voxels"))
    rounds = v.select("round").distinct().count()
    return v.groupBy(*volume.AXES).agg(F.sum("value").alias("total"), (rounds - F.count("*") + F.count_if(F.col("value") == 0)).alias("zeros"))


@query(f"SELECT y, x, z, CAST(sum(value) AS BIGINT) AS total, count(*) FILTER (WHERE value = 0) AS zeros FROM {_DENSE} GROUP BY ALL")
def zero_counts(spark, d):
    return _zero_counts(spark, d)


@query(
    f"""WITH c AS (SELECT y, x, z, count(*) FILTER (WHERE value = 0) AS zeros FROM {_DENSE} GROUP BY ALL)
SELECT min(y) AS y0, max(y) AS y1, min(x) AS x0, max(x) AS x1, min(z) AS z0, max(z) AS z1 FROM c WHERE zeros <= 2"""
)
def crop_bounds(spark, d):
    return volume.crop_bounds(_zero_counts(spark, d), 2)


@query(f"SELECT round, y - 9 AS y, x - 2 AS x, z, channel, value FROM {VOXELS} WHERE y BETWEEN 10 AND 40 AND x BETWEEN 3 AND 9")
def crop_volume(spark, d):
    return volume.crop(frame(spark, d, "voxels"), {"y": (10, 40), "x": (3, 9)})


@query(
    f"""WITH c AS (SELECT y, x, z, count(*) FILTER (WHERE value = 0) AS zeros FROM {_DENSE} GROUP BY ALL)
SELECT round(avg(CASE WHEN zeros <= 2 THEN 1.0 ELSE 0.0 END), 6) AS usable FROM c"""
)
def usable_fraction(spark, d):
    return rounded(volume.usable_fraction(_zero_counts(spark, d), 2), "usable")


for _axis, _rest in (("z", "y, x"), ("y", "x, z"), ("x", "y, z")):

    def _project(spark, d, axis=_axis):
        return volume.project_max(frame(spark, d, "voxels"), axis, ["channel"])

    QUERIES[f"max_projection_{_axis}"] = _project
    ORACLES[f"max_projection_{_axis}"] = f"SELECT channel, {_rest}, max(value) AS value FROM {VOXELS} GROUP BY ALL"


@query(f"SELECT y + 3 AS y, x - 2 AS x, z + 1 AS z, value FROM {_SUMMED} WHERE y + 3 BETWEEN 1 AND 50 AND x - 2 BETWEEN 1 AND 12 AND z + 1 BETWEEN 1 AND 7")
def translate_volume(spark, d):
    return volume.translate(volume.sum_channels(frame(spark, d, "voxels"), volume.AXES), (3, -2, 1), (50, 12, 7)).select("y", "x", "z", "value")


@query(f"SELECT 51 - y AS y, x, z, value FROM {_SUMMED}")
def flip_volume(spark, d):
    return volume.flip(volume.sum_channels(frame(spark, d, "voxels"), volume.AXES), 50)


@query(
    f"""SELECT CAST(floor((y - 1) / 4) + 1 AS INT) AS y, CAST(floor((x - 1) / 4) + 1 AS INT) AS x, CAST(floor((z - 1) / 4) + 1 AS INT) AS z, round(avg(value), 6) AS value
FROM {_SUMMED} GROUP BY ALL"""
)
def block_downsample(spark, d):
    return rounded(volume.downsample(volume.sum_channels(frame(spark, d, "voxels"), volume.AXES), 4), "value")


@query(
    f"""SELECT CAST((y - 1) / 2 + 1 AS INT) AS y, CAST((x - 1) / 2 + 1 AS INT) AS x, CAST((z - 1) / 2 + 1 AS INT) AS z, value
FROM {_SUMMED} WHERE (y - 1) % 2 = 0 AND (x - 1) % 2 = 0 AND (z - 1) % 2 = 0"""
)
def nearest_downsample(spark, d):
    return volume.downsample_nearest(volume.sum_channels(frame(spark, d, "voxels"), volume.AXES), 2).select("y", "x", "z", "value")


@query(
    f"""WITH s AS {_SUMMED}
SELECT a.y, a.x, a.z, a.value FROM s a LEFT JOIN s b ON abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 AND abs(a.z - b.z) <= 1
  AND NOT (a.y = b.y AND a.x = b.x AND a.z = b.z) WHERE a.y BETWEEN 2 AND 49 AND a.x BETWEEN 2 AND 11 AND a.z BETWEEN 2 AND 6
GROUP BY ALL HAVING count(b.value) = 0 OR a.value > max(b.value)"""
)
def local_maxima(spark, d):
    return volume.local_maxima(volume.sum_channels(frame(spark, d, "voxels"), volume.AXES), (50, 12, 7)).select("y", "x", "z", "value")


@query(
    f"""WITH v AS (SELECT *, (y * 7 + x * 3 + z) % 5 = 0 AS hole FROM {_SUMMED}),
n AS (SELECT a.y, a.x, a.z, avg(b.value) FILTER (WHERE abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 AND abs(a.z - b.z) <= 1) AS f1, avg(b.value) AS f2
  FROM v a JOIN v b ON abs(a.y - b.y) <= 2 AND abs(a.x - b.x) <= 2 AND abs(a.z - b.z) <= 2 AND NOT b.hole WHERE a.hole GROUP BY ALL)
SELECT v.y, v.x, v.z, round(CASE WHEN hole THEN coalesce(f1, f2, 0.0) ELSE value END, 4) AS value FROM v LEFT JOIN n ON v.y = n.y AND v.x = n.x AND v.z = n.z"""
)
def hole_fill(spark, d):
    v = volume.sum_channels(frame(spark, d, "voxels"), volume.AXES).withColumn("hole", (F.col("y") * 7 + F.col("x") * 3 + F.col("z")) % 5 == 0)
    return rounded(volume.fill_holes(v, (50, 12, 7), 2), "value", digits=4).select("y", "x", "z", "value")


@query(
    f"""WITH p AS (SELECT y, x, CAST(sum(value) AS BIGINT) AS value FROM {VOXELS} GROUP BY ALL)
SELECT a.y, a.x, CAST(sum(b.value) AS BIGINT) AS value FROM p a JOIN p b ON b.y BETWEEN a.y - 5 AND a.y + 4 AND b.x BETWEEN a.x - 5 AND a.x + 4 GROUP BY ALL"""
)
def box_sum(spark, d):
    p = frame(spark, d, "voxels").groupBy("y", "x").agg(F.sum("value").alias("value"))
    return volume.box_sum(p, 5, 4)


@query(
    f"""SELECT name, y, x, CAST(sum(10) AS BIGINT) AS heat FROM (
  SELECT name, unnest(range(greatest(y - 3, 1), least(y + 3, 60) + 1)) AS y, x0 AS x FROM (
    SELECT name, y, unnest(range(greatest(x - 3, 1), least(x + 3, 24) + 1)) AS x0 FROM {POSITIONS})) GROUP BY ALL"""
)
def gene_heat_map(spark, d):
    out = volume.heat_map(frame(spark, d, "positions"), 3, (60, 24), 10, ["name"])
    return out.select("name", F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x"), "heat")


_HOURS = "(SELECT CAST(day(ts) * 24 + hour(ts) AS INT) AS y, event_type AS k, count(*) AS value FROM events GROUP BY ALL)"


@query(
    f"""WITH h AS {_HOURS}, a AS (SELECT * FROM h WHERE k = (SELECT min(event_type) FROM events)), b AS (SELECT * FROM h WHERE k = (SELECT max(event_type) FROM events)),
s AS (SELECT d, sum(a.value * b.value) AS score FROM (SELECT unnest(range(-6, 7)) AS d) JOIN b ON true JOIN a ON a.y = b.y + d GROUP BY d)
SELECT CAST(d AS INTEGER) AS d_y, CAST(score AS BIGINT) AS score FROM s ORDER BY score DESC, d LIMIT 1"""
)
def lag_correlation(spark, d):
    e = frame(spark, d, "events")
    hours = e.groupBy((F.day("ts") * 24 + F.hour("ts")).alias("y"), F.col("event_type").alias("k")).agg(F.count("*").alias("value"))
    ends = e.agg(F.min("event_type"), F.max("event_type")).first()
    return volume.best_shift(hours.filter(F.col("k") == ends[0]), hours.filter(F.col("k") == ends[1]), 6, ["y"])


@query(f"SELECT *, {', '.join(f'c{k} = greatest(c1, c2, c3, c4) AS win_c{k}' for k in range(1, 5))} FROM {PIXELS}")
def winner_masks(spark, d):
    return volume.winner_masks(frame(spark, d, "pixels_base"), X.CHANNELS)


@query(
    f"""WITH a AS (SELECT y, x, CAST(max(value) AS BIGINT) AS v FROM {VOXELS} WHERE round = 1 GROUP BY ALL), b AS (SELECT y, x, CAST(max(value) AS BIGINT) AS v FROM {VOXELS} WHERE round = 2 GROUP BY ALL),
e AS (SELECT abs(coalesce(a.v, 0) - coalesce(b.v, 0)) / 65535.0 AS e FROM a FULL JOIN b ON a.y = b.y AND a.x = b.x)
SELECT count(*) AS n, round(avg(e), 6) AS mean_error, round(max(e), 6) AS max_error FROM e"""
)
def compare_volumes(spark, d):
    one = lambda r: volume.project_max(frame(spark, d, "voxels").filter(F.col("round") == r))
    return rounded(volume.compare_volumes(one(1), one(2), ["y", "x"]), "mean_error", "max_error")


@query(
    f"""WITH m AS (SELECT * FROM (SELECT round, y, x, z, max(value) AS value FROM {VOXELS} WHERE channel = 'A' GROUP BY ALL UNION ALL SELECT round, y, x, z, max(value) FROM {VOXELS} WHERE channel = 'N' GROUP BY ALL UNION ALL SELECT round, y, x, z, max(value) FROM {VOXELS} WHERE channel = 'R' GROUP BY ALL))
SELECT y, x, z, max(value) AS value FROM m GROUP BY ALL"""
)
def max_combine(spark, d):
    v = frame(spark, d, "voxels")
    return volume.max_combine(*(v.filter(F.col("channel") == c) for c in "ANR"))


@query(
    f"""WITH c AS (SELECT channel AS fov, y, x, avg(CASE WHEN value % 3 = 0 THEN 0 ELSE 0.5 END) AS m FROM {VOXELS} GROUP BY ALL)
SELECT fov, avg(CASE WHEN m < 1 THEN 1.0 ELSE 0.0 END) > 0.5 AS empty FROM c GROUP BY fov"""
)
def tile_empty(spark, d):
    v = frame(spark, d, "voxels").select(F.col("channel").alias("fov"), "y", "x", F.when(F.col("value") % 3 == 0, 0.0).otherwise(0.5).alias("value"))
    return volume.tile_is_empty(v, 0.5)


@query(f"SELECT puncta_id, round, round(least(1, c1 * 0.001::DOUBLE), 6) AS red, round(least(1, c2 * 0.001::DOUBLE + c4 * 0.0005::DOUBLE), 6) AS green, round(least(1, c3 * 0.001::DOUBLE), 6) AS blue FROM {PIXELS}")
def composite_rgb(spark, d):
    weights = [[0.001, 0, 0, 0], [0, 0.001, 0, 0.0005], [0, 0, 0.001, 0]]
    out = volume.composite_rgb(frame(spark, d, "pixels_base"), weights, X.CHANNELS)
    return rounded(out.select("puncta_id", "round", "red", "green", "blue"), "red", "green", "blue")


@query(f"SELECT y, x, z, CAST(y + (x - 1) * 50 + (z - 1) * 600 AS INTEGER) AS i, y AS y2, x AS x2, z AS z2 FROM (SELECT DISTINCT y, x, z FROM {VOXELS})")
def linear_index(spark, d):
    v = frame(spark, d, "voxels").select("y", "x", "z").distinct().withColumn("i", X.sub2ind(50, 12, F.col("y"), F.col("x"), F.col("z")))
    return v.withColumns(dict(zip(("y2", "x2", "z2"), (c.cast("int") for c in X.ind2sub(50, 12, F.col("i"))))))


@query(f"SELECT label, y, x, CAST(min(value) OVER (PARTITION BY label, x ORDER BY y RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS BIGINT) AS low FROM (SELECT z AS label, y, x, CAST(sum(value) AS BIGINT) AS value FROM {VOXELS} GROUP BY ALL)")
def erode_lines(spark, d):
    from pyspark.sql import Window as W

    p = frame(spark, d, "voxels").groupBy(F.col("z").alias("label"), "y", "x").agg(F.sum("value").alias("value"))
    return p.select("label", "y", "x", F.min("value").over(W.partitionBy("label", "x").orderBy("y").rangeBetween(-1, 1)).alias("low"))


def _box_oracle(radius: int) -> str:
    """A grey opening of the summed voxels, axis after axis."""
    steps, of = [], "v"
    for i, (f, a) in enumerate((f, a) for f in ("min", "max") for a in volume.AXES):
        rest = ", ".join(b for b in volume.AXES if b != a)
        near = f"RANGE BETWEEN {radius} PRECEDING AND {radius} FOLLOWING"
        steps.append(f"s{i} AS (SELECT y, x, z, {f}(value) OVER (PARTITION BY {rest} ORDER BY {a} {near}) AS value FROM {of})")
        of = f"s{i}"
    return f"WITH v AS (SELECT y, x, z, CAST(sum(value) AS BIGINT) AS value FROM {VOXELS} GROUP BY ALL), {', '.join(steps)} SELECT * FROM {of}"


@query(_box_oracle(1))
def open_box(spark, d):
    return volume.morphology(volume.sum_channels(frame(spark, d, "voxels"), volume.AXES), 1)


def _volume(spark, d):
    return volume.sum_channels(frame(spark, d, "voxels"), volume.AXES).withColumn("value", F.col("value").cast("double"))


@query()
def open_sphere_blocks(spark, d):
    return kernels.map_blocks(_volume(spark, d), lambda b: kernels.open_sphere(b, 2), (25, 12, 7), 4)


@query()
def segment_volume(spark, d):
    v = frame(spark, d, "voxels").groupBy("round", "y", "x", "z").agg(F.sum("value").cast("double").alias("value")).withColumnRenamed("round", "fov")
    return kernels.segment(v)


@query()
def upsample_z(spark, d):
    return rounded(kernels.upsample_z(_volume(spark, d), 0.4 / 0.165, 7), "value", digits=4)


# --- matching, registration, tiles -----------------------------------------------------------------------------

_NN2 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
p AS (SELECT m.vec_id AS m_id, f.vec_id AS f_id, list_sum(list_transform(list_zip(m.v, f.v), lambda q: (q[1] - q[2]) * (q[1] - q[2]))) AS d
  FROM v m, v f WHERE m.vec_id % 2 = 0 AND f.vec_id % 2 = 1),
k AS (SELECT *, row_number() OVER (PARTITION BY m_id ORDER BY d, f_id) AS k FROM p),
nn AS (SELECT m_id, max(CASE WHEN k = 1 THEN f_id END) AS f_id, max(CASE WHEN k = 1 THEN d END) AS d1, max(CASE WHEN k = 2 THEN d END) AS d2 FROM k WHERE k <= 2 GROUP BY m_id)"""


def _two_nearest(spark, d):
    keys = frame(spark, d, "embeddings").select(F.col("vec_id").alias("key_id"), F.col("embedding").alias("ivec"))
    return match.two_nearest(keys.filter("key_id % 2 = 0"), keys.filter("key_id % 2 = 1"))


@query(f"{_NN2} SELECT m_id, f_id, round(d1, 5) AS d1, round(d2, 5) AS d2 FROM nn")
def two_nearest(spark, d):
    """The two nearest odd vectors of every even one."""
    return rounded(_two_nearest(spark, d), "d1", "d2", digits=5)


@query(f"{_NN2} SELECT m_id, f_id FROM nn WHERE d1 * 1.05 < d2")
def ratio_matches(spark, d):
    return match.ratio_test(_two_nearest(spark, d), 1.05).select("m_id", "f_id")


@query(f"{_NN2} SELECT m_id, f_id FROM nn WHERE f_id IN (SELECT f_id FROM nn GROUP BY f_id HAVING count(*) = 1)")
def unambiguous_matches(spark, d):
    return match.drop_ambiguous(_two_nearest(spark, d)).select("m_id", "f_id")


@query(f"{_NN2} SELECT m_id, f_id FROM nn WHERE d1 < (SELECT avg(d1) FROM nn)")
def below_mean_matches(spark, d):
    return match.below_mean(_two_nearest(spark, d)).select("m_id", "f_id")


@query(f"{_NN2} SELECT m_id, f_id FROM nn WHERE d1 <= (SELECT avg(d1) + 2 * stddev_samp(d1) FROM nn)")
def far_match_rejection(spark, d):
    return match.drop_far(_two_nearest(spark, d)).select("m_id", "f_id")


@query(
    f"""WITH p AS {POINTS}, j AS (SELECT a.id AS p_id, b.id AS t_id, sqrt((a.y - b.y) ** 2 + (a.x - b.x) ** 2 + (a.z - b.z) ** 2) AS distance
  FROM p a, p b WHERE a.id % 2 = 0 AND b.id % 2 = 1),
k AS (SELECT *, row_number() OVER (PARTITION BY p_id ORDER BY distance, t_id) AS k FROM j WHERE distance <= 20)
SELECT p_id, t_id, round(distance, 6) AS distance FROM k WHERE k = 1"""
)
def nearest_point_grid(spark, d):
    p = frame(spark, d, "points")
    return rounded(match.nearest_point(p.filter("id % 2 = 0"), p.filter("id % 2 = 1"), 20.0), "distance")


@query(
    f"""WITH p AS {POINTS}, m AS (SELECT id, y, x, z, 2 * y + 3 AS fy, x * 1.5 - 1 AS fx, z + (label % 3) AS fz FROM p)
SELECT round(regr_slope(fy, y), 6) AS scale_y, round(regr_intercept(fy, y), 6) AS shift_y, round(regr_slope(fx, x), 6) AS scale_x, round(regr_intercept(fx, x), 6) AS shift_x,
  round(regr_slope(fz, z), 6) AS scale_z, round(regr_intercept(fz, z), 6) AS shift_z FROM m"""
)
def affine_scale_shift(spark, d):
    return rounded(register.fit_scale_shift(_matches(spark, d)), *(f"{k}_{a}" for k in ("scale", "shift") for a in "yxz"))


def _matches(spark, d):
    return frame(spark, d, "points").select(
        "label", F.col("y").alias("my"), F.col("x").alias("mx"), F.col("z").alias("mz"),
        (2 * F.col("y") + 3).alias("fy"), (F.col("x") * 1.5 - 1).alias("fx"), (F.col("z") + F.col("label") % 3).alias("fz"),
    )


@query(
    f"""SELECT id, y * 2 + 3 AS y, x + 0.5::DOUBLE * z AS x, z - 1 AS z FROM {POINTS}"""
)
def apply_affine(spark, d):
    y, x, z = X.apply_affine([2, 0, 0, 3, 0, 1, 0.5, 0, 0, 0, 1, -1], F.col("y"), F.col("x"), F.col("z"))
    return frame(spark, d, "points").select("id", y.alias("y"), x.alias("x"), z.alias("z"))


def _affine_oracle() -> str:
    """Least squares by the inverse of the 3 x 3 covariances (cofactors), the shift by the means."""
    inverse = {
        "yy": "xx * zz - xz * xz", "yx": "yz * xz - yx * zz", "yz": "yx * xz - yz * xx",
        "xx": "yy * zz - yz * yz", "xz": "yx * yz - yy * xz", "zz": "yy * xx - yx * yx",
    }
    pairs = ", ".join(f"covar_pop({k[0]}, {k[1]}) AS {k}" for k in inverse)
    towards = ", ".join(f"covar_pop({a}, f{f}) AS {a}f{f}" for f in "yxz" for a in "yxz")
    means = ", ".join(f"avg({c}) AS m_{c}" for c in ("y", "x", "z", "fy", "fx", "fz"))
    cofactors = ", ".join(f"({v}) / (yy * (xx * zz - xz * xz) - yx * (yx * zz - yz * xz) + yz * (yx * xz - yz * xx)) AS i_{k}" for k, v in inverse.items())
    name = lambda a, b: f"i_{a}{b}" if a + b in inverse else f"i_{b}{a}"
    slopes = ", ".join(f"{' + '.join(f'{name(a, b)} * {b}f{f}' for b in 'yxz')} AS b_{f}{a}" for f in "yxz" for a in "yxz")
    row = lambda f: [*(f"b_{f}{a}" for a in "yxz"), f"m_f{f} - {' - '.join(f'b_{f}{a} * m_{a}' for a in 'yxz')}"]
    return f"""WITH m AS (SELECT y, x, z, 2 * y + 3 AS fy, x * 1.5 - 1 AS fx, z + (label % 3) AS fz FROM {POINTS}),
s AS (SELECT {pairs}, {towards}, {means} FROM m), i AS (SELECT *, {cofactors} FROM s), b AS (SELECT *, {slopes} FROM i)
SELECT [{", ".join(f"round({c}, 6) + 0.0::DOUBLE" for f in "yxz" for c in row(f))}] AS matrix FROM b"""


@query(_affine_oracle())
def affine_full(spark, d):
    matrix = register.fit_affine(_matches(spark, d))
    return spark.createDataFrame([([round(v, 6) + 0.0 for v in matrix],)], "matrix array<double>")


@query()
def ransac_by_group(spark, d):
    out = register.fit_robust(_matches(spark, d), ["label"], voxel=(1.0, 1.0, 1.0))
    return out.withColumn("matrix", F.transform("matrix", lambda v: F.round(v, 6)))


@query()
def tps_warp(spark, d):
    grid = np.array([(y, x, z) for y in (1, 50) for x in (1, 12) for z in (1, 7)] + [(25, 6, 4)], float)
    spline = register.ThinPlate(grid, grid + np.array([[0, 0, 0]] * 8 + [[2, 1, 0]]))
    return rounded(register.warp_voxels_tps(_volume(spark, d), spline, (50, 12, 7)), "value", digits=4)


@query(
    f"""WITH v AS (SELECT y, x, z, CAST(sum(value) AS DOUBLE) AS value FROM {VOXELS} GROUP BY ALL),
t AS (SELECT ty.range AS y, tx.range AS x, tz.range AS z FROM range(1, 51) ty, range(1, 13) tx, range(1, 8) tz),
o AS (SELECT *, y - 1.5::DOUBLE AS oy, x - 0.25::DOUBLE AS ox FROM t)
SELECT CAST(o.y AS INTEGER) AS y, CAST(o.x AS INTEGER) AS x, CAST(o.z AS INTEGER) AS z, round(sum(value * (1 - abs(oy - v.y)) * (1 - abs(ox - v.x))), 4) AS value
FROM o JOIN v ON v.z = o.z AND abs(oy - v.y) < 1 AND abs(ox - v.x) < 1 GROUP BY ALL"""
)
def affine_warp(spark, d):
    return rounded(register.warp_voxels_affine(_volume(spark, d), [1, 0, 0, 1.5, 0, 1, 0, 0.25, 0, 0, 1, 0], (50, 12, 7)), "value", digits=4)


@query(
    f"""WITH p AS {POINTS}, q AS (SELECT a.id, b.y - a.y AS dy, b.x - a.x AS dx, b.z - a.z AS dz FROM p a, p b),
r AS (SELECT *, sqrt(dy * dy + dx * dx + dz * dz) AS r FROM q),
k AS (SELECT id, (r - 3) / 57 AS s_r, (atan2(dy, dx) + pi()) / (2 * pi()) AS s_t, acos(dz / r) / pi() AS s_p FROM r WHERE r > 3 AND r < 60)
SELECT id, {", ".join(f"CAST(least(floor(s_{k} * 10), 9) AS INTEGER) AS b_{k}" for k in "rtp")}, count(*) AS n FROM k GROUP BY ALL"""
)
def shape_contexts(spark, d):
    return match.shape_context(frame(spark, d, "points"), 60.0)


_SNAKE = f"(SELECT fov, CASE WHEN CAST(floor(fov / 7) AS INT) % 2 = 0 THEN fov % 7 ELSE 6 - fov % 7 END AS row, CAST(floor(fov / 7) AS INT) AS col FROM {TILES})"


@query(f"SELECT DISTINCT fov, row, col FROM {_SNAKE}")
def snake_tiles(spark, d):
    return tiles.tile_map(frame(spark, d, "tiles"), 7)


@query(f"SELECT DISTINCT fov, col AS row, 6 - row AS col FROM {_SNAKE}")
def turned_tiles(spark, d):
    return tiles.tile_map(frame(spark, d, "tiles"), 7, turn=True)


@query(f"WITH t AS (SELECT DISTINCT * FROM {_SNAKE}) SELECT a.fov, b.fov AS near FROM t a, t b WHERE abs(a.row - b.row) <= 1 AND abs(a.col - b.col) <= 1")
def tile_neighbours(spark, d):
    return tiles.neighbours(tiles.tile_map(frame(spark, d, "tiles"), 7))


@query(f"SELECT fov, CAST(ntile(6) OVER (ORDER BY fov) AS INTEGER) AS instance FROM (SELECT DISTINCT fov FROM {TILES}) WHERE fov % 10 <> 3")
def fov_split(spark, d):
    t = frame(spark, d, "tiles")
    return tiles.split_fovs(t, 6, t.filter("fov % 10 = 3"))


@query(
    f"""WITH p AS (SELECT CAST(l_suppkey % 20 AS INT) AS fixed, CAST(l_partkey % 20 AS INT) AS moving FROM lineitem)
SELECT fixed, moving FROM p GROUP BY ALL HAVING count(*) >= 140 UNION SELECT fov, fov FROM {TILES}"""
)
def match_lists(spark, d):
    pairs = frame(spark, d, "lineitem").select((F.col("l_suppkey") % 20).cast("int").alias("fixed"), (F.col("l_partkey") % 20).cast("int").alias("moving"))
    return tiles.match_lists(pairs, frame(spark, d, "tiles"), 140)


@query(
    f"""WITH f AS (SELECT DISTINCT fov FROM {TILES}), p AS (SELECT CAST(puncta_id % 90 AS INT) AS fov FROM {PIXELS}), c AS (SELECT CAST(puncta_id % 80 AS INT) AS fov FROM {READS} WHERE NOT list_contains(bases, 0)),
u AS (SELECT CAST(puncta_id % 50 AS INT) AS fov, round(avg(CASE WHEN c1 > 500 THEN 1.0 ELSE 0.0 END), 6) AS frac_usable FROM {PIXELS} GROUP BY 1)
SELECT f.fov, n_centroids, n_complete, frac_usable FROM f LEFT JOIN (SELECT fov, count(*) AS n_centroids FROM p GROUP BY fov) a USING (fov)
LEFT JOIN (SELECT fov, count(*) AS n_complete FROM c GROUP BY fov) b USING (fov) LEFT JOIN u USING (fov)"""
)
def completion_report(spark, d):
    p = frame(spark, d, "pixels_base")
    fov = lambda n: (F.col("puncta_id") % n).cast("int").alias("fov")
    usable = p.select(fov(50), (F.col("c1") > 500).cast("double").alias("u")).groupBy("fov").agg(F.round(F.avg("u"), 6).alias("frac_usable"))
    return tiles.completion(frame(spark, d, "tiles"), p.select(fov(90)), basecall.complete_reads(_reads(spark, d)).select(fov(80)), usable)


@query(
    f"""WITH t AS (SELECT DISTINCT * FROM {_SNAKE}), p AS (SELECT CAST(round AS INT) AS fov, y, x, max(value) AS value FROM {VOXELS} GROUP BY ALL)
SELECT y + 45 * row AS y, x + 10 * col AS x, arg_max(value, t.fov) AS value FROM p JOIN t USING (fov) GROUP BY ALL"""
)
def mosaic(spark, d):
    p = volume.project_max(frame(spark, d, "voxels").withColumnRenamed("round", "fov"), "z", ["fov"])
    return tiles.mosaic(tiles.tile_map(frame(spark, d, "tiles"), 7), p, 50, 12, 0.1)


@query(f"SELECT id, x * 2 + 100 * col AS x, y * 2 + 200 * row AS y, z, fov FROM (SELECT *, CAST(id % 5 AS INT) AS fov FROM {POINTS}) JOIN (SELECT DISTINCT * FROM {_SNAKE}) USING (fov)")
def lift_points(spark, d):
    p = frame(spark, d, "points").withColumn("fov", (F.col("id") % 5).cast("int"))
    return tiles.lift(p, tiles.tile_map(frame(spark, d, "tiles"), 7), 100, 200, 2.0).select("id", "x", "y", "z", "fov")


# --- reads across experiments, reports, sources and sinks ------------------------------------------------------


@query(f"WITH a AS (SELECT name, count(*) AS n_a FROM {POSITIONS} WHERE y <= 30 GROUP BY name), b AS (SELECT name, count(*) AS n_b FROM {POSITIONS} WHERE x > 20 GROUP BY name) SELECT name, coalesce(n_a, 0) AS n_a, coalesce(n_b, 0) AS n_b FROM a FULL JOIN b USING (name)")
def aligned_counts(spark, d):
    p = frame(spark, d, "positions")
    return tiles.aligned_counts(p.filter("y <= 30"), p.filter("x > 20"))


@query(f"WITH a AS (SELECT name, count(*) AS n_a FROM {POSITIONS} WHERE y <= 30 GROUP BY name), b AS (SELECT name, count(*) AS n_b FROM {POSITIONS} WHERE x > 20 GROUP BY name) SELECT round(corr(coalesce(n_a, 0), coalesce(n_b, 0)), 6) AS r FROM a FULL JOIN b USING (name)")
def count_correlation(spark, d):
    p = frame(spark, d, "positions")
    return tiles.aligned_counts(p.filter("y <= 30"), p.filter("x > 20")).agg(F.round(F.corr("n_a", "n_b"), 6).alias("r"))


@query("SELECT r_name AS name, count(DISTINCT n_nationkey) AS n_truth, count(DISTINCT CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey END) AS n_found FROM region JOIN nation ON r_regionkey = n_regionkey GROUP BY r_name")
def truth_recovery(spark, d):
    n = frame(spark, d, "nation").join(frame(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("name"), "n_nationkey")
    return simulate.recovery(n, n.filter("n_nationkey % 2 = 0"))


@query("SELECT p_partkey, p_brand AS name FROM part WHERE p_brand IN (SELECT p_brand FROM part WHERE p_size > 48)")
def valid_barcodes(spark, d):
    p = frame(spark, d, "part").select("p_partkey", F.col("p_brand").alias("name"), "p_size")
    return tiles.valid_by_label(p, p.filter("p_size > 48")).select("p_partkey", "name")


@query("SELECT p_partkey, p_brand AS name FROM part WHERE p_brand NOT IN (SELECT p_brand FROM part WHERE p_size > 48)")
def invalid_barcodes(spark, d):
    p = frame(spark, d, "part").select("p_partkey", F.col("p_brand").alias("name"), "p_size")
    return tiles.valid_by_label(p, p.filter("p_size > 48"), False).select("p_partkey", "name")


@query(f"WITH c AS (SELECT y, x, CAST((y + x) % 6 AS INT) AS cell_id FROM (SELECT DISTINCT CAST(floor((y - 1) / 1) AS INT) + 1 AS y, CAST(month(l_shipdate) AS INT) AS x FROM (SELECT CAST(l_quantity AS INT) AS y, l_shipdate FROM lineitem))) SELECT event_id, cell_id FROM {POSITIONS} p JOIN c ON CAST(floor(p.y / 2.0 + 0.5) AS INT) = c.y AND CAST(floor(p.x / 2.0 + 0.5) AS INT) = c.x WHERE cell_id > 0")
def reads_in_cells(spark, d):
    cells = frame(spark, d, "voxels").select("y", "x").distinct().withColumn("cell_id", ((F.col("y") + F.col("x")) % 6).cast("int"))
    return tiles.assign_cells(frame(spark, d, "positions"), cells, 2.0).select("event_id", "cell_id")


@query(f"SELECT hamming AS ref_id, count(DISTINCT x) AS votes FROM {POSITIONS} GROUP BY hamming")
def round_votes(spark, d):
    return tiles.round_votes(frame(spark, d, "positions").select(F.col("hamming").alias("ref_id"), F.col("x").alias("round")))


@query(f"SELECT name AS gene, count(*) AS count FROM {POSITIONS} WHERE hamming <= 1 GROUP BY name HAVING count(*) >= 5")
def gene_count_cutoff(spark, d):
    return sinks.gene_counts(frame(spark, d, "positions").filter("hamming <= 1"), 5)


@query(f"SELECT event_id, name FROM {POSITIONS} WHERE lower(name) LIKE '%c%'")
def gene_search(spark, d):
    return frame(spark, d, "positions").filter(F.col("name").ilike("%c%")).select("event_id", "name")


@query(f"SELECT hamming, CAST(floor((y + x) / 7) AS INT) AS bucket, count(*) AS n FROM {POSITIONS} GROUP BY ALL")
def distance_histogram(spark, d):
    return tiles.nearest_distances(frame(spark, d, "positions").withColumn("distance", F.col("y") + F.col("x")), 7)


@query(f"SELECT z AS distance, count(*) FILTER (WHERE hamming = 0) AS good, count(*) FILTER (WHERE hamming <> 0) AS bad FROM {POSITIONS} GROUP BY z")
def spacing_quality(spark, d):
    return tiles.spacing_quality(frame(spark, d, "positions").select(F.col("z").alias("distance"), (F.col("hamming") == 0).alias("good")))


@query(f"SELECT name AS gene, CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y, CAST(z AS BIGINT) AS z FROM {POSITIONS}")
def export_gene_positions(spark, d):
    return sinks.gene_positions(frame(spark, d, "positions"))


_LETTERS = " || ".join(f"substr('NACGT', bases[{r}] + 1, 1)" for r in range(1, ROUNDS + 1))
_MARKS = " || ".join(f"chr(33 + least(bases[{r}] * 11, 40))" for r in range(1, ROUNDS + 1))


@query(f"SELECT '@' || puncta_id || chr(10) || {_LETTERS} || chr(10) || '+' || chr(10) || {_MARKS} AS record FROM {READS}")
def export_fastq(spark, d):
    reads = _reads(spark, d).withColumn("confidence", F.transform("bases", lambda b: (b * 11).cast("double")))
    return sinks.fastq(reads, F.col("puncta_id").cast("string"))


@query(f"SELECT name || chr(9) || array_to_string(codes, '') || chr(9) || code_id || chr(9) || '0' || chr(9) || '1' AS line FROM {CODES}")
def export_tsv(spark, d):
    c = frame(spark, d, "codebook").select("name", F.col("codes").alias("bases"), F.col("code_id").alias("x"), F.lit(0).alias("y"), F.lit(1).alias("z"))
    return sinks.tsv_line(c)


@query(
    f"""SELECT '<read x="' || x || '" y="' || y || '" z="' || z || '">' || chr(10) || '    <gene>' || name || '</gene>' || chr(10) || '</read>' AS xml FROM {POSITIONS}"""
)
def export_xml(spark, d):
    return sinks.read_xml_rows(frame(spark, d, "positions"))


@query(f"SELECT DISTINCT CAST(y + (x - 1) * 60 AS INTEGER) AS lin_idx, 100 AS value FROM {POSITIONS}")
def label_volume(spark, d):
    p = frame(spark, d, "positions").groupBy("name").agg(F.collect_set(X.sub2ind(60, 24, F.col("y"), F.col("x"), F.lit(1))).alias("voxels"))
    return sinks.label_volume(p)


@query(f"SELECT x, CAST(y AS INTEGER) AS y, 1 AS z, CASE WHEN hamming = 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS r, 0.5::DOUBLE AS g, CASE WHEN hamming = 3 THEN 1.0 ELSE 0.0 END::DOUBLE AS b, 1.0::DOUBLE AS a, z AS round FROM {POSITIONS}")
def point_cloud(spark, d):
    p = frame(spark, d, "positions").select(F.col("z").alias("round"), F.col("hamming").alias("base"), F.array(X.sub2ind(60, 24, F.col("y"), F.col("x"), F.lit(1))).alias("voxels"))
    colours = spark.createDataFrame([(k, float(k == 0), 0.5, float(k == 3)) for k in range(4)], "base int, r double, g double, b double")
    out = sinks.point_cloud(p, 60, 24, colours)
    return out.withColumns({c: F.col(c).cast("int") for c in "xyz"})


_NAMES = "format('exp{}_round{:03d}_ch{:02d}{}.{}', CASE WHEN s_suppkey % 3 = 0 THEN '-downsample' ELSE '' END, s_suppkey % 9 + 1, s_suppkey % 4, CASE s_suppkey % 5 WHEN 0 THEN '_affine' WHEN 1 THEN '_registered' ELSE '' END, 'npy')"


@query(
    f"""SELECT {_NAMES} AS path, 'exp' AS base, CASE WHEN s_suppkey % 3 = 0 THEN 'downsample' ELSE 'full' END AS scale, CAST(s_suppkey % 9 + 1 AS INT) AS round,
  format('ch{{:02d}}', s_suppkey % 4) AS channel, CASE s_suppkey % 5 WHEN 0 THEN 'affine' WHEN 1 THEN 'registered' END AS variant, 'npy' AS extension FROM supplier"""
)
def parse_file_names(spark, d):
    return tiles.parse_names(_file_names(spark, d))


def _file_names(spark, d):
    s = F.col("s_suppkey")
    return frame(spark, d, "supplier").select(
        F.concat(
            F.lit("exp"), F.when(s % 3 == 0, "-downsample").otherwise(""), F.format_string("_round%03d_ch%02d", s % 9 + 1, s % 4),
            F.when(s % 5 == 0, "_affine").when(s % 5 == 1, "_registered").otherwise(""), F.lit(".npy"),
        ).alias("path")
    )


@query(
    """WITH c AS (SELECT DISTINCT CAST(s_suppkey % 9 + 1 AS INT) AS round, format('ch{:02d}', s_suppkey % 4) AS channel FROM supplier WHERE s_suppkey % 36 < 30)
SELECT r.round, k.channel FROM (SELECT DISTINCT round FROM c) r CROSS JOIN (SELECT DISTINCT channel FROM c) k WHERE (r.round, k.channel) NOT IN (SELECT (round, channel) FROM c)"""
)
def missing_files(spark, d):
    names = _file_names(spark, d.rstrip("/")).join(
        frame(spark, d, "supplier").filter("s_suppkey % 36 < 30").select(F.format_string("_round%03d_ch%02d", F.col("s_suppkey") % 9 + 1, F.col("s_suppkey") % 4).alias("stem")).distinct(),
        F.expr("substring_index(regexp_replace(regexp_replace(path, '^exp(-downsample)?', ''), '_(affine|registered)', ''), '.', 1) = stem"), "left_semi",
    )
    found = tiles.parse_names(names).select("round", "channel").distinct()
    return tiles.expected_files(found.select("round").distinct(), found.select("channel").distinct(), found)


@query("SELECT event_id, CAST((event_id % 12 - 1 + 12) % 12 + 1 AS BIGINT) AS k, CAST(floor(((event_id % 12 - 1 + 12) % 12) / 4) + 1 AS INTEGER) AS channel, CAST((event_id % 12 - 1 + 12) % 12 % 4 + 1 AS INTEGER) AS z FROM events")
def deinterleave(spark, d):
    e = frame(spark, d, "events").select("event_id", ((F.col("event_id") % 12 - 1 + 12) % 12 + 1).alias("k"))
    return readers.deinterleave(e, 4)


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS VARCHAR) AS k FROM events")
def json_props(spark, d):
    return readers.json_columns(frame(spark, d, "events").select("event_id", "props"), "props", "k string").select("event_id", "k")


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def hourly_counts(spark, d):
    from ..streaming.ingest import windowed_counts

    out = windowed_counts(frame(spark, d, "events"), "ts", "event_type")
    return out.withColumn("start", F.col("start").cast("timestamp_ntz"))


@query(
    r"""SELECT s_name, row_number() OVER (ORDER BY list_aggregate(list_transform(regexp_extract_all(s_name, '\d+|\D+'),
  lambda p: CASE WHEN regexp_matches(p, '^\d') THEN lpad(p, 20, '0') ELSE p END), 'string_agg', '')) AS place
FROM (SELECT DISTINCT s_name FROM supplier)"""
)
def natural_sort(spark, d):
    from pyspark.sql import Window as W

    names = frame(spark, d, "supplier").select("s_name").distinct()
    return names.select("s_name", F.row_number().over(W.orderBy(readers.natural_order("s_name"))).cast("long").alias("place"))


@query()
def simulated_rounds(spark, d):
    """A simulated experiment over the whole codebook, a punctum for each ten codes in a volume that grows with them: blobs, noise."""
    codes = frame(spark, d, "codebook").withColumn("code_id", F.col("code_id") - 1)  # the keys of part count from 1
    n = codes.count() // 10
    size = (2 * n, 40, 12)
    truth = simulate.assign_codes(simulate.puncta(spark, n, size, 5), codes, 5)
    return rounded(simulate.add_noise(simulate.render(truth, 4, size, seed=5), 50.0, seed=5), "value", digits=4)
