"""Secret scan: fixed patterns, and a randomness test battery for the rest.

Patterns give the base spans.  Beside them, every run of encoding characters
of ``MIN_RUN`` or more whose alphabet can be inferred (hexadecimal, base 32,
base 36, base 64, and base 64 that happens to hold no digit) is tested for
being random over that alphabet:

* chi-squared uniformity of the symbols,
* runs test on the lower and upper half of the alphabet,
* serial correlation of neighbouring symbols,

combined by Fisher's method.  A run is reported when two controlled tests
agree, each with the Benjamini-Hochberg step within each stratum of encoding
and length, as short strings are told apart less easily than long ones:

* being random is not rejected (``rate`` bounds the share of random strings
  that are lost), and
* being made of words is rejected (``false_rate`` bounds the expected share
  of identifiers among what is reported): the likelihood of its letters under
  the letter frequencies of words, and how often it switches between letters
  and digits, again combined by Fisher's method.

What remains is reported as kind ``random`` unless a base span covers it.
Runs of letters of one case only (words) and of digits only (numbers) are not
tested.

The p-values are counted in a fixed number of bins per stratum, so the step
needs one small aggregate and no global sort; the cut-offs (one per stratum)
are broadcast.  Texts are scanned once; afterwards only matches move.  All
statistics are sums over the symbols, so a run takes time in proportion to
its length.

Defined cases: NULL and empty texts have no spans; every row is scanned on
its own, so repeated rows and NULL ids each get a row; a very long text has
its matches numbered by a running sum, not in memory; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridplace.llm.common import materialize, text_or_empty

#: The base patterns, in the order in which equal starts are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
MIN_ASSIGNED = 6
BASE = ("assign", "access", "hex")
RANDOM = "random"

MIN_RUN = 20
RUN = rf"[A-Za-z0-9+/_-]{{{MIN_RUN},}}"
#: encoding -> alphabet, in the order of inference
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "234567ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base64": "+/0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "letters": "+/ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
}
BINS, BINS_PER_E = 1000, 20
#: Letters of English words, a to z, in per cent.
WORD_LETTERS = (
    8.167, 1.492, 2.782, 4.253, 12.702, 2.228, 2.015, 6.094, 6.966, 0.153, 0.772, 4.025, 2.406,
    6.749, 7.507, 1.929, 0.095, 5.987, 6.327, 9.056, 2.758, 0.978, 2.360, 0.150, 1.974, 0.074,
)
#: Share of letters that follow no language; how much more than independent letters those of words vary;
#: characters between switches of letters and digits.
OTHER_LETTERS, SPREAD, SWITCH_EVERY = 0.1, 1.3, 12


def matches(text: Column, kind: int, pattern: str, value: Column | None = None) -> Column:
    """Matches of a pattern in order: kind, number, gap (characters between
    the match before and this one), size, value."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = whole if value is None else value
    return F.when(
        text.rlike(pattern),
        F.zip_with(
            F.arrays_zip(whole.alias("m"), value.alias("v")),
            F.slice(F.split(text, pattern, -1), 1, F.size(whole)),
            lambda m, gap: F.struct(F.lit(kind).alias("kind"), F.length(gap).alias("gap"), F.length(m["m"]).alias("size"), m["v"].alias("value")),
        ),
    )


def inferred(token: Column) -> Column:
    """Encoding of a run; NULL for words, numbers and anything else."""
    digit, lower, upper = (token.rlike(c) for c in ("[0-9]", "[a-z]", "[A-Z]"))
    return (
        F.when(token.rlike(r"^[0-9a-f]+$|^[0-9A-F]+$") & digit & (lower | upper), "hex")
        .when(token.rlike(r"^[A-Z2-7]+$") & digit & upper, "base32")
        .when(token.rlike(r"^[0-9a-z]+$|^[0-9A-Z]+$") & digit & (lower | upper), "base36")
        .when(digit & lower & upper, "base64")
        .when(lower & upper, "letters")
    )


def upper_tail(z: Column) -> Column:
    """P(Z > z) of the normal distribution, by a logistic fit."""
    z = F.greatest(F.least(z, F.lit(8.0)), F.lit(-8.0))
    return 1 / (1 + F.exp(z * 1.5976 + z * z * z * 0.070565992))


def far_tail(z: Column) -> Column:
    """P(Z > z), not too small far out, where the fit of ``upper_tail`` is."""
    z = F.least(z, F.lit(12.0))
    return F.when(z < 3, upper_tail(z)).otherwise(F.exp(-z * z / 2) / (F.greatest(z, F.lit(3.0)) * math.sqrt(2 * math.pi)))


def letter_model() -> tuple[list[float], float, float]:
    """Log-likelihood ratio of each letter (words against uniform), and its
    mean and standard deviation in words."""
    total = sum(WORD_LETTERS)
    share = [(1 - OTHER_LETTERS) * x / total + OTHER_LETTERS / 26 for x in WORD_LETTERS]
    ratio = [math.log(26 * x) for x in share]
    mean = sum(x * r for x, r in zip(share, ratio))
    return ratio, mean, math.sqrt(sum(x * (r - mean) ** 2 for x, r in zip(share, ratio)))


def as_words(df: DataFrame) -> DataFrame:
    """Adds p_words, the probability that a run of words looks as random as
    ``value`` does."""
    ratio, mean, deviation = letter_model()
    df = df.withColumn("low", F.lower("value"))
    counts = [F.length("low") - F.length(F.replace("low", F.lit(c), F.lit(""))) for c in "abcdefghijklmnopqrstuvwxyz"]
    df = df.withColumn("counts", F.array(*counts))
    letters = F.aggregate("counts", F.lit(0.0), lambda s, c: s + c)
    evidence = F.aggregate(F.zip_with("counts", F.array(*[F.lit(r) for r in ratio]), lambda c, r: c * r), F.lit(0.0), lambda s, x: s + x)
    # a letter or digit becomes a or 1; each switch is one place where they meet
    kinds = F.regexp_replace(F.regexp_replace(F.col("low"), "[a-z]+", "a"), "[0-9]+", "1")
    met = [(F.length("kinds") - F.length(F.replace("kinds", F.lit(x), F.lit("")))) / 2 for x in ("a1", "1a")]
    df = df.withColumns({"letters": letters, "evidence": evidence, "kinds": kinds}).withColumn("switches", met[0] + met[1])
    z = (F.col("letters") * mean - F.col("evidence")) / (deviation * SPREAD * F.sqrt(F.greatest("letters", F.lit(1.0))))
    df = df.withColumns({"z_letters": z, "z_switches": 2 * (F.sqrt("switches") - F.sqrt(F.length("low") / SWITCH_EVERY))})
    df = df.withColumns({"p_letters": far_tail(F.col("z_letters")), "p_switches": far_tail(F.col("z_switches"))})
    df = df.withColumn("against", -(F.log("p_letters") + F.log("p_switches")))
    # hexadecimal letters are too few to be told from those of words, and runs of letters never switch
    only = F.when((F.col("encoding") == "hex") | (F.col("letters") == 0), F.col("p_switches")).when(F.col("encoding") == "letters", F.col("p_letters"))
    return df.withColumn("p_words", F.coalesce(only, F.exp(-F.col("against")) * (1 + F.col("against")))).drop(
        "low", "counts", "letters", "evidence", "kinds", "switches", "z_letters", "z_switches", "p_letters", "p_switches", "against"
    )


def battery(df: DataFrame) -> DataFrame:
    """Adds p, the combined probability that a random string looks no more
    random than ``value`` does, for the runs with an inferred ``encoding``."""
    per = lambda make: F.coalesce(*[F.when(F.col("encoding") == e, make(e, a)) for e, a in ALPHABETS.items()])
    coded = F.when(F.col("encoding").isin("hex", "base36"), F.lower("value")).when(F.col("encoding").isin("base64", "letters"), F.translate("value", "-_", "+/")).otherwise(F.col("value"))
    df = df.withColumn("coded", coded).withColumn("n", F.length("value").cast("double")).withColumn("size_of_alphabet", per(lambda e, a: F.lit(float(len(a)))))

    def squares(e: str, a: str) -> Column:
        counts = [F.length("coded") - F.length(F.replace("coded", F.lit(c), F.lit(""))) for c in a]
        return F.aggregate(F.array(*counts), F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))

    df = df.withColumn("squares", per(squares))
    halves = per(lambda e, a: F.translate("coded", a, "0" * (len(a) // 2) + "1" * (len(a) - len(a) // 2)))
    df = df.withColumn("halves", halves)
    values = per(lambda e, a: F.transform(F.array_remove(F.split("coded", ""), ""), lambda c: F.instr(F.lit(a), c).cast("double")))
    df = df.withColumn("values", values)
    n, a = F.col("n"), F.col("size_of_alphabet")
    chi = (a / n * F.col("squares") - n - (a - 1)) / F.sqrt(2 * (a - 1) * (n - 1) / n)
    changes = sum(((F.length("halves") - F.length(F.replace("halves", F.lit(x), F.lit("")))) / 2 for x in ("01", "10")), F.lit(0.0))
    ones = (F.length(F.replace("halves", F.lit("0"), F.lit("")))).cast("double")
    expect = 2 * ones * (n - ones) / n + 1
    spread = (expect - 1) * (expect - 2) / (n - 1)
    runs = F.when(spread > 0, (changes + 1 - expect) / F.sqrt(F.greatest(spread, F.lit(1e-9)))).otherwise(F.lit(8.0))
    # one pass: sum, sum of squares, sum of products of neighbours, first and last symbol
    zero = F.lit(0.0)
    start = F.struct(zero.alias("s"), zero.alias("q"), zero.alias("lag"), zero.alias("first"), zero.alias("last"))
    step = lambda a, x: F.struct(
        (a["s"] + x).alias("s"), (a["q"] + x * x).alias("q"), (a["lag"] + a["last"] * x).alias("lag"),
        F.when(a["first"] == 0, x).otherwise(a["first"]).alias("first"), x.alias("last"),
    )
    df = df.withColumns({"chi": chi, "runs": runs, "sums": F.aggregate("values", start, step)})
    s = lambda name: F.col(f"sums.{name}")
    df = df.withColumns({"total": s("q") - s("s") * s("s") / n, "lagged": s("lag") - s("s") / n * (2 * s("s") - s("first") - s("last")) + (n - 1) * s("s") * s("s") / (n * n)})
    # a run of one symbol has no spread; what the sums leave of it is rounding
    spread_out = F.col("total") > F.lit(1e-9) * s("q")
    df = df.withColumn("serial", F.when(spread_out, (F.col("lagged") / F.nullif(F.col("total"), zero) + 1 / n) * F.sqrt(n)).otherwise(F.lit(8.0)))
    half = -(F.log(upper_tail(F.col("chi"))) + F.log(F.least(F.lit(1.0), 2 * upper_tail(F.abs("runs")))) + F.log(F.least(F.lit(1.0), 2 * upper_tail(F.abs("serial")))))
    df = df.withColumn("half", half)
    return df.withColumn("p", F.exp(-F.col("half")) * (1 + F.col("half") + F.col("half") * F.col("half") / 2)).drop(
        "coded", "size_of_alphabet", "squares", "halves", "values", "chi", "runs", "sums", "total", "lagged", "serial", "half"
    )


def p_bin(p: str) -> Column:
    return F.least(F.floor(-F.log(F.greatest(p, F.lit(1e-300))) * BINS_PER_E), F.lit(BINS - 1)).cast("int")


def cut_offs(tested: DataFrame, p_bins: str, rate: float) -> DataFrame:
    """Per stratum: the first bin of p-values that is rejected."""
    counts = tested.groupBy("encoding", "octave", F.col(p_bins).alias("bin")).agg(F.count(F.lit(1)).alias("k"))
    stratum = Window.partitionBy("encoding", "octave")
    so_far = F.sum("k").over(stratum.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.select("*", so_far.alias("rank"), F.sum("k").over(stratum).alias("m"))
    passed = F.exp(-F.col("bin") / BINS_PER_E) <= F.lit(rate) * F.col("rank") / F.col("m")
    return ranked.filter(passed).groupBy("encoding", "octave").agg(F.min("bin").alias(f"reject_{p_bins}"))


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = 0.01, false_rate: float = 0.05) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, n_random,
    base_sha256, spans (kind:start:end in code points, end exclusive, by
    start, then kind).

    ``rate``: share of random strings that may be lost; ``false_rate``: share
    of runs of words among the random spans.
    """
    text = text_or_empty(text_col)
    kinds = [
        matches(F.col("text"), 0, ASSIGN, F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2))),
        matches(F.col("text"), 1, ACCESS),
        matches(F.col("text"), 2, HEX),
        matches(F.col("text"), 3, RUN),
    ]
    none = F.array().cast("array<struct<kind:int,gap:int,size:int,value:string>>")
    found = F.concat(*[F.coalesce(k, none) for k in kinds])
    scanned = materialize(
        docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).select("doc_id", found.alias("found")).withColumn("uid", F.monotonically_increasing_id()),
        "matches",
    )
    ends = Window.partitionBy("uid", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        scanned.filter(F.size("found") > 0)
        .select("uid", F.posexplode("found").alias("i", "m")).select("uid", "i", "m.*")
        .withColumn("end", F.sum(F.col("gap").cast("long") + F.col("size")).over(ends))
        .withColumn("start", F.col("end") - F.col("size"))
        .filter((F.col("kind") != 0) | (F.length("value") >= MIN_ASSIGNED))
        .withColumn("encoding", F.when(F.col("kind") == 3, inferred(F.col("value"))))
        .filter((F.col("kind") != 3) | F.col("encoding").isNotNull())
    )
    base = placed.filter("kind < 3").select("uid", "kind", "start", "end", F.lit(None).cast("string").alias("encoding"), *[F.lit(None).cast("int").alias(c) for c in ("octave", "bin", "word_bin")])
    runs = placed.filter("kind = 3").select("uid", "kind", "start", "end", "encoding", "value")
    tested = as_words(battery(runs)).select(
        "uid", "kind", "start", "end", "encoding", F.floor(F.log2("n")).cast("int").alias("octave"), p_bin("p").alias("bin"), p_bin("p_words").alias("word_bin")
    )
    spans = materialize(base.unionByName(tested), "placed_matches")
    random_runs = spans.filter("kind = 3")
    # one row per encoding and power of two of the length
    not_random, not_words = F.broadcast(cut_offs(random_runs, "bin", rate)), F.broadcast(cut_offs(random_runs, "word_bin", false_rate))
    random_too = (F.col("reject_bin").isNull() | (F.col("bin") < F.col("reject_bin"))) & (F.col("word_bin") >= F.col("reject_word_bin"))
    by_start = Window.partitionBy("uid").orderBy("start", "kind").rangeBetween(Window.unboundedPreceding, 0)
    kept = (
        spans.join(not_random, ["encoding", "octave"], "left").join(not_words, ["encoding", "octave"], "left")
        .filter((F.col("kind") < 3) | random_too)
        .withColumn("covered", F.max(F.when(F.col("kind") < 3, F.col("end"))).over(by_start))
        .filter((F.col("kind") < 3) | F.col("covered").isNull() | (F.col("covered") < F.col("end")))
        .groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    )
    names = F.array(*[F.lit(k) for k in (*BASE, RANDOM)])
    shown = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    out = scanned.select("uid", "doc_id").join(kept, "uid", "left").withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return out.select(
        "doc_id",
        *[count(k).alias(f"n_{name}") for k, name in enumerate((*BASE, RANDOM))],
        F.sha2(F.array_join(F.transform(F.filter("spans", lambda s: s["kind"] < 3), shown), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", shown), ",").alias("spans"),
    )
