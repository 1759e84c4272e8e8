"""Secret scans, native: base patterns plus a randomness test battery with false-discovery control.

Only built-in column functions are used.  Positions of regex matches, for which Spark
has no function, come from ``split`` and ``regexp_extract_all`` of the same pattern:
both walk the same leftmost, non-overlapping matches, so the lengths of the pieces
before a match and of the matches before it add up to its start, in code points.

The battery looks at tokens of 20 and more characters of the usual encodings that hold
letters and digits.  The encoding (hex, base32, base36, base62, base64) is inferred
from the characters that occur.  Its three tests are judged twice:

* Could the token be random in its alphabet?  Chi-squared for uniformity, runs about the
  middle of the alphabet and lag-1 serial correlation; a token that any of them rejects
  (Bonferroni) is too regular and no secret.
* Could it be text?  Uniformity: characters coincide as often as they do in prose.  Runs:
  letters, capitals and digits come in runs, as in words, names and numbers.  Serial
  correlation: vowels and consonants take turns.  The three p-values, one-sided towards
  randomness, are combined by Fisher's method, and the Benjamini-Hochberg procedure, run
  over the whole table within classes of length, decides which tokens are reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize, table

# The base patterns, in the order of their kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A maximal run of 16 or more is what stays of ``[0-9a-f]+``; the same holds for 14 or more after ``AKIA``.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_LEAST = 12
KINDS = ("assign", "access", "hex", "random")
TOKEN_LEAST = 20
TOKEN = rf"[A-Za-z0-9+/_=-]{{{TOKEN_LEAST},}}"

#: Level of the test of randomness of each token, and of the false-discovery control.
REJECT, FDR = 0.001, 0.05
#: Text as the hypothesis to be rejected: chance that two characters of it are equal, that three are, that a run of
#: letters or digits ends at a character (in tokens of one case, of both cases), that a vowel and a consonant are neighbours.
EQUAL_TWO, EQUAL_THREE, RUN_ENDS, RUN_ENDS_MIXED, TURNS = 0.06, 0.0055, 0.08, 0.2, 0.55
#: Tails of binomials are summed up to this many trials; beyond, the Chernoff bound stands for them.
SUMMED = 300
#: Lower ends of the length classes of the false-discovery control; bins of -log10 p are 0.1 wide, up to 30.
LENGTHS = (20, 32, 64, 128)
BINS = 300
#: Positions are added up in stretches of so many matches.
STRIDE = 256
#: Characters that may stand for hidden ones: the first that a text doesn't hold.
HIDING = ("\ufdd0", "\ufdd1", "\ufdd2", "\x01")

# Fixed values: (name, pattern, alphabet in the order of its codes).
_UPPER, _LOWER, _DIGIT = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
ENCODINGS = (
    ("hex", "^[0-9a-f]+$", _DIGIT + "abcdef"),
    ("HEX", "^[0-9A-F]+$", _DIGIT + "ABCDEF"),
    ("base32", "^[A-Z2-7]+=*$", _UPPER + "234567"),
    ("base36", "^[a-z0-9]+$", _DIGIT + _LOWER),
    ("BASE36", "^[A-Z0-9]+$", _DIGIT + _UPPER),
    ("base62", "^[A-Za-z0-9]+$", _UPPER + _LOWER + _DIGIT),
    ("base64url", "^[A-Za-z0-9_-]+=*$", _UPPER + _LOWER + _DIGIT + "-_"),
    ("base64", "", _UPPER + _LOWER + _DIGIT + "+/"),
)


def once(value: Column, f) -> Column:
    """f(value), with ``value`` evaluated a single time however often f names it."""
    return F.transform(F.array(value), f)[0]


def _running(lengths: Column) -> Column:
    """Sums of an integer array up to and including each place; stretch by stretch, so that long arrays stay cheap."""

    def scan(xs: Column) -> Column:
        grow = lambda state, x: F.struct(
            (state["at"] + x).alias("at"), F.concat(state["out"], F.array(state["at"] + x)).alias("out")
        )
        return F.aggregate(xs, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), grow, lambda s: s["out"])

    def whole(xs: Column) -> Column:
        stretches = F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / STRIDE).cast("int"))
        inner = F.transform(stretches, lambda c: scan(F.slice(xs, c * STRIDE + 1, STRIDE)))
        return once(inner, joined)

    def joined(inner: Column) -> Column:
        before = once(scan(F.transform(inner, lambda x: F.element_at(x, -1))), lambda t: F.concat(F.array(F.lit(0)), t))
        return F.flatten(F.zip_with(inner, F.slice(before, F.lit(1), F.size(inner)), lambda xs, b: F.transform(xs, lambda x: x + b)))

    return F.when(F.size(lengths) > 0, once(lengths, whole)).otherwise(F.array().cast("array<int>"))


def all_spans(text: Column, pattern: str) -> Column:
    """array<struct<start,end,what>> of all matches of ``pattern``; empty where nothing matches."""

    def found(matches: Column, pieces: Column) -> Column:
        lengths = F.zip_with(matches, F.slice(pieces, F.lit(1), F.size(matches)), lambda m, p: F.length(m) + F.length(p))
        return F.zip_with(
            matches, _running(lengths), lambda m, end: F.struct((end - F.length(m)).alias("start"), end.alias("end"), m.alias("what"))
        )

    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("p"))
    spans = once(both, lambda x: found(x["m"], x["p"]))
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast("array<struct<start:int,end:int,what:string>>"))


def _value_is_long(match: Column) -> Column:
    return F.length(F.regexp_extract(match, ASSIGN, 2)) >= ASSIGN_LEAST


#: Pattern of each base kind and what its matches must pass.
BASE = ((ASSIGN, _value_is_long), (ACCESS, None), (HEX, None))


def base_spans(text: Column) -> Column:
    """array<struct<start,end,kind>>: the matches of each base kind, kind by kind."""

    def of(kind: int, pattern: str, keep) -> Column:
        spans = all_spans(text, pattern)
        if keep is not None:
            spans = F.filter(spans, lambda s: keep(s["what"]))
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind")))

    return F.concat(*(of(kind, *rule) for kind, rule in enumerate(BASE)))


def _hidden(text: Column, pattern: str, sign: Column, wanted) -> Column:
    """``text`` with the matches that ``wanted`` (of the match and its number) names replaced by as many signs."""

    def cut(x: Column) -> Column:
        signs = F.transform(x["m"], lambda m, i: F.when(wanted(m, i), F.repeat(sign, F.length(m))).otherwise(m))
        return F.array_join(F.zip_with(x["p"], F.concat(signs, F.array(F.lit(""))), lambda p, m: F.concat(p, m)), "")

    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("p"))
    return F.when(text.rlike(pattern), once(both, cut)).otherwise(text)


def without_base(text: Column, bases: Column, sign: Column) -> Column:
    """``text`` with every character of a base span replaced by ``sign``.

    Base spans mostly lie apart or inside each other (a hex run that is the value of an
    assignment); then the patterns, one after the other, hide just these spans, in time
    linear in the text.  Where spans cross, each is cut out by its positions.
    """

    def by_pattern(part: Column, pattern: str, keep) -> Column:
        wanted = lambda m, _: F.lit(True) if keep is None else keep(m)
        return once(part, lambda t: _hidden(t, pattern, sign, wanted))

    def by_position(part: Column, kind: int) -> Column:
        def gap(x: Column, s: Column, i: Column) -> Column:
            at = F.when(i > 0, F.get(x["s"], i - 1)["end"]).otherwise(F.lit(0))
            return once(at, lambda at: F.substring(x["t"], at + 1, s["start"] - at))

        def cut(x: Column) -> Column:
            parts = F.transform(x["s"], lambda s, i: F.concat(gap(x, s, i), F.repeat(sign, s["end"] - s["start"])))
            last = F.substring(x["t"], F.element_at(x["s"], -1)["end"] + 1, F.length(x["t"]))
            return F.when(F.size(x["s"]) > 0, F.array_join(F.concat(parts, F.array(last)), "")).otherwise(x["t"])

        own = F.filter(bases, lambda s: s["kind"] == kind)
        return once(F.struct(part.alias("t"), own.alias("s")), cut)

    apart = crossed = text
    for kind, rule in enumerate(BASE):
        apart, crossed = by_pattern(apart, *rule), by_position(crossed, kind)
    crossing = F.aggregate(
        F.array_sort(bases),
        F.struct(F.lit(0).alias("reach"), F.lit(False).alias("cross")),
        lambda state, s: F.struct(
            F.greatest(state["reach"], s["end"]).alias("reach"),
            (state["cross"] | ((s["start"] < state["reach"]) & (s["end"] > state["reach"]))).alias("cross"),
        ),
        lambda state: state["cross"],
    )
    return F.when(F.size(bases) == 0, text).when(crossing, crossed).otherwise(apart)


def _tail(z: Column) -> Column:
    """P(N > |z|) of the standard normal (Abramowitz and Stegun 26.2.17)."""
    z = F.abs(z)
    t = 1 / (1 + 0.2316419 * z)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.exp(-z * z / 2) * 0.3989422804014327 * poly


def _codes(token: Column) -> Column:
    """The token's characters as places in its inferred alphabet, padding left out."""
    bare = F.regexp_replace(token, "=+$", "")
    alphabet = F.lit(ENCODINGS[-1][2])
    for _, pattern, letters in reversed(ENCODINGS[:-1]):
        alphabet = F.when(token.rlike(pattern), F.lit(letters)).otherwise(alphabet)
    places = F.transform(F.split(bare, ""), lambda c: F.greatest(F.instr(alphabet, c) - 1, F.lit(0)))
    return F.struct(places.alias("codes"), F.length(alphabet).alias("k"))


def _lower_tail(t: Column, m: Column, s: Column) -> Column:
    """P(X <= t) of m trials of chance s, summed term by term."""
    ratio = s / (1 - s)
    step = lambda a, k: F.struct((a["term"] * (m - k) / (k + 1) * ratio).alias("term"), (a["sum"] + a["term"]).alias("sum"))
    start = F.struct(F.pow(1 - s, m).alias("term"), F.lit(0.0).alias("sum"))
    return F.when(t < 0, F.lit(0.0)).otherwise(F.aggregate(F.sequence(F.lit(0), F.greatest(t, F.lit(0))), start, step, lambda a: a["sum"]))


def _chernoff(t: Column, m: Column, s: Column) -> Column:
    """An upper bound of the tail that begins at t and leads away from the mean m s."""
    share = t / m
    part = lambda x, y: F.when(x > 0, x * F.log(x / y)).otherwise(F.lit(0.0))
    return F.exp(-m * (part(share, s) + part(1 - share, 1 - s)))


def _few(t: Column, m: Column, s: Column) -> Column:
    """p-value of t successes or fewer."""
    return F.when((m <= 0) | (t >= m * s), F.lit(1.0)).when(m <= SUMMED, _lower_tail(t, m, s)).otherwise(_chernoff(t, m, s))


def _many(t: Column, m: Column, s: Column) -> Column:
    """p-value of t successes or more."""
    exact = once(1 - _lower_tail(t - 1, m, s), lambda p: F.when(p > 1e-9, p).otherwise(F.least(F.lit(1e-9), _chernoff(t, m, s))))
    return F.when((m <= 0) | (t <= m * s), F.lit(1.0)).when(m <= SUMMED, exact).otherwise(_chernoff(t, m, s))


def text_p(token: Column) -> Column:
    """p-value of the hypothesis that the token is text, by the three tests together."""
    plain = F.regexp_replace(token, "[^A-Za-z0-9]", "")
    vowels = "aeiouAEIOU"
    letters = "".join(c for c in _UPPER + _LOWER if c not in vowels)

    def measured(x: Column) -> Column:
        case = F.translate(x, _UPPER + _LOWER + _DIGIT, "U" * 26 + "l" * 26 + "D" * 10)
        voice = F.translate(x, vowels + letters + _DIGIT, "v" * 10 + "c" * 42 + "D" * 10)
        chars = F.split(F.lower(x), "")
        same = once(chars, lambda cs: F.aggregate(
            F.transform(F.array_distinct(cs), lambda c: F.size(F.filter(cs, lambda y: y == c))),
            F.lit(0.0), lambda a, o: a + o.cast("double") * (o - 1) / 2,
        ))
        mixed = x.rlike("[a-z]") & x.rlike("[A-Z]")
        return F.struct(
            F.length(x).alias("n"),
            same.alias("same"),
            # the capital that begins a word ends no run
            F.regexp_count(case, F.lit("l(?=[UD])|U(?=D)|D(?=[Ul])")).alias("ends"),
            F.when(mixed, F.lit(RUN_ENDS_MIXED)).otherwise(F.lit(RUN_ENDS)).alias("usual"),
            F.regexp_count(voice, F.lit("[vc](?=[vc])")).alias("pairs"),
            F.regexp_count(voice, F.lit("v(?=c)|c(?=v)")).alias("turns"),
        )

    def combined(x: Column) -> Column:
        n = x["n"].cast("double")
        two, three = EQUAL_TWO, EQUAL_THREE
        pairs = n * (n - 1) / 2
        variance = pairs * (two - two * two) + n * (n - 1) * (n - 2) * (three - two * two)
        z = (x["same"] - pairs * two) / F.sqrt(variance)
        uniform = F.when(z < 0, _tail(z)).otherwise(F.lit(1.0))
        runs = _many(x["ends"], x["n"] - 1, x["usual"])
        serial = _few(x["turns"], x["pairs"], F.lit(TURNS))
        log = lambda p: -F.log(F.greatest(p, F.lit(1e-300)))
        # Fisher: twice the sum is chi-squared with six degrees of freedom
        return once(log(uniform) + log(runs) + log(serial), lambda h: F.least(F.lit(1.0), F.exp(-h) * (1 + h + h * h / 2)))

    tested = once(once(plain, measured), combined)
    return F.when(F.length(plain) < TOKEN_LEAST / 2, F.lit(1.0)).otherwise(tested)


def token_tests(token: Column) -> Column:
    """struct<n, random, bin>: length, p of the battery under randomness, and -log10 p under text in tenths.

    Each character is looked at a fixed number of times, so long tokens cost in
    proportion to their length.
    """

    def sums(c: Column) -> Column:
        codes, k = c["codes"], c["k"].cast("double")
        total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x.cast("double"))
        n = F.size(codes)
        pairs = F.arrays_zip(F.slice(codes, F.lit(1), n - 1).alias("a"), F.slice(codes, F.lit(2), n - 1).alias("b"))
        high = lambda x: x >= k / 2
        counts = F.transform(F.array_distinct(codes), lambda x: F.size(F.filter(codes, lambda y: y == x)))
        return F.struct(
            n.cast("double").alias("n"),
            k.alias("k"),
            total(codes).alias("x"),
            total(F.transform(codes, lambda x: x * x)).alias("xx"),
            total(F.transform(pairs, lambda q: q["a"] * q["b"])).alias("xy"),
            (F.element_at(codes, 1) + F.element_at(codes, -1)).cast("double").alias("ends"),
            total(F.transform(codes, lambda x: high(x).cast("int"))).alias("high"),
            total(F.transform(pairs, lambda q: (high(q["a"]) != high(q["b"])).cast("int"))).alias("turns"),
            total(F.transform(counts, lambda o: o * o)).alias("squares"),
        )

    def battery(s: Column) -> Column:
        n, k = s["n"], s["k"]
        chi = k / n * s["squares"] - n
        uniform = F.try_divide(chi - (k - 1), F.sqrt(2 * (k - 1) * (1 - 1 / n)))
        p_uniform = F.when(uniform > 0, _tail(uniform)).otherwise(F.lit(1.0))
        # runs about the middle of the alphabet: their number less one is that of the turns
        both = 2 * s["high"] * (n - s["high"])
        spread = F.try_divide(both * (both - n), n * n * (n - 1))
        p_runs = F.when(spread > 0, 2 * _tail((s["turns"] - both / n) / F.sqrt(spread))).otherwise(F.lit(0.0))
        # lag-1 serial correlation
        mean = s["x"] / n
        variance = s["xx"] - n * mean * mean
        together = s["xy"] - mean * (2 * s["x"] - s["ends"]) + (n - 1) * mean * mean
        p_serial = F.when(variance > 1e-9, 2 * _tail((together / variance + 1 / n) * F.sqrt(n))).otherwise(F.lit(0.0))
        return F.least(F.lit(1.0), 3 * F.least(p_uniform, p_runs, p_serial))

    random = once(once(_codes(token), sums), battery)
    bin_ = F.least(F.floor(-F.log10(F.greatest(text_p(token), F.lit(1e-300))) * 10), F.lit(BINS)).cast("int")
    return F.struct(F.length(token).alias("n"), random.alias("random"), bin_.alias("bin"))


def _length_class(n: Column) -> Column:
    out = F.lit(0)
    for k, least in enumerate(LENGTHS):
        out = F.when(n >= least, F.lit(k)).otherwise(out)
    return out


def _mixed(token: Column) -> Column:
    return token.rlike("[0-9]") & token.rlike("[A-Za-z]")


def sign_for(text: Column) -> Column:
    """A character that the text doesn't hold, of HIDING; null if it holds all of them."""
    return F.coalesce(*(F.when(~F.contains(text, F.lit(c)), F.lit(c)) for c in HIDING))


def analysis(text: Column) -> Column:
    """struct<base, tokens>: base spans, and struct<start,end,kind,test> of every token of what they leave.

    Only tokens of letters and digits have a test.
    """

    def tokens(bases: Column) -> Column:
        # any sign outside the tokens' characters does here
        spans = all_spans(without_base(text, bases, F.lit(HIDING[-1])), TOKEN)
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.lit(KINDS.index("random")).alias("kind"),
            F.when(_mixed(s["what"]), token_tests(s["what"])).alias("test"),
        ))

    none = F.array().cast("array<struct<start:int,end:int,kind:int,test:struct<n:int,random:double,bin:int>>>")
    return once(base_spans(text), lambda bases: F.struct(bases.alias("base"), F.when(text.rlike(TOKEN), tokens(bases)).otherwise(none).alias("tokens")))


def discovery_bins(tokens: DataFrame, fdr: float = FDR) -> dict[int, int]:
    """Per length class the least bin of -log10 p that is a discovery (Benjamini-Hochberg over all rows).

    ``tokens``: one column, the tokens of each text.  Bins are counted in the executors;
    at most four classes' results reach the driver.
    """
    tests = tokens.toDF("tokens").select(F.explode("tokens.test").alias("t")).filter("t is not null").select("t.*")
    bins = (
        tests.filter(F.col("random") >= REJECT)
        .groupBy(_length_class(F.col("n")).alias("class"), "bin")
        .agg(F.count("*").alias("m"))
    )
    down = W.partitionBy("class").orderBy(F.desc("bin")).rowsBetween(W.unboundedPreceding, 0)
    ranked = bins.withColumn("rank", F.sum("m").over(down)).withColumn("all", F.sum("m").over(W.partitionBy("class")))
    passing = ranked.filter(F.pow(F.lit(10.0), -F.col("bin") / 10) <= fdr * F.col("rank") / F.col("all"))
    return {r[0]: r[1] for r in passing.groupBy("class").agg(F.min("bin")).collect()}


def _discovered(least: dict[int, int]):
    """Whether a token is a discovery; false where it has no test."""

    def test(s: Column) -> Column:
        floor = F.lit(BINS + 1)
        for number, bin_ in least.items():
            floor = F.when(_length_class(s["test"]["n"]) == number, F.lit(bin_)).otherwise(floor)
        return F.coalesce((s["test"]["random"] >= REJECT) & (s["test"]["bin"] >= floor), F.lit(False))

    return test


def _secrets(found: Column, least: dict[int, int]) -> Column:
    """array<struct<start,end,kind>> of an ``analysis``, by start, then end, then kind."""
    more = F.transform(F.filter(found["tokens"], _discovered(least)), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_sort(F.concat(found["base"], more))


def find_secrets(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """``docs`` with ``secrets``: array<struct<start,end,kind>> by start (a column of that name is replaced).

    Kinds are places in KINDS; positions are code points, ends exclusive.  The base
    matches of each kind are leftmost and do not overlap within their kind; the battery
    (kind random) tests what base matches leave of a token, if 20 characters or more.
    Null and empty texts have none.  Each row counts, copies included; an empty table gives no rows.
    """
    docs = docs.withColumn("text", F.col("text").cast("string"))
    found = docs.withColumn("secrets", analysis(F.coalesce(F.col("text"), F.lit(""))))
    return found.withColumn("secrets", _secrets(F.col("secrets"), discovery_bins(found.select("secrets.tokens"), fdr)))


def _listed(spans: Column) -> Column:
    """kind:start:end by start, then kind, comma-joined."""
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    name = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k + 1)
    return F.array_join(F.transform(keyed, lambda s: F.concat_ws(":", name(s["kind"]), s["start"], s["end"])), ",")


def redact(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``[secret]`` (touching spans become one); n_chars follows.

    Rows without secrets are unchanged; a null text stays null.  All other columns keep
    their values, whatever their names.
    """
    columns = docs.columns
    spans, found, text = "__secret_spans", F.col("__secret_spans"), F.col("text")
    looked = docs.withColumn(spans, analysis(F.coalesce(text.cast("string"), F.lit(""))))
    discovered = _discovered(discovery_bins(looked.select(f"{spans}.tokens"), fdr))
    secret = (F.size(found["base"]) > 0) | F.exists(found["tokens"], discovered)

    def signed(sign: Column) -> Column:
        flags = F.transform(found["tokens"], discovered)
        hide = lambda x: _hidden(x["t"], TOKEN, sign, lambda _, i: F.get(x["f"], i))
        return once(F.struct(without_base(text, found["base"], sign).alias("t"), flags.alias("f")), hide)

    def step(state: Column, s: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(s["start"] > state["at"], F.concat(state["out"], gap, F.lit("[secret]")))
            .when(state["out"] == "", F.lit("[secret]")).otherwise(state["out"]).alias("out"),
        )

    chosen = F.array_sort(F.concat(found["base"], F.transform(
        F.filter(found["tokens"], discovered), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
    )))
    stepped = F.aggregate(
        chosen, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
        lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))),
    )
    # a text that holds all signs is put together span by span
    cut = once(sign_for(text), lambda sign: F.when(
        sign.isNotNull(), F.regexp_replace(signed(sign), F.concat(sign, F.lit("+")), F.lit("[secret]"))
    ).otherwise(stepped))
    out = looked.withColumn("text", F.when(secret, cut).otherwise(text))
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(secret, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*columns)


def op7_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Base and battery spans of every document; texts are read once."""
    docs = table(spark, sf_dir, "documents")
    found = materialize(docs.select("doc_id", analysis(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("found")))
    secrets = _secrets(F.col("found"), discovery_bins(found.select("found.tokens")))
    found = found.select("doc_id", secrets.alias("secrets"))
    count = lambda k: F.size(F.filter("secrets", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_listed(F.filter("secrets", lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
        _listed(F.col("secrets")).alias("spans"),
    )
