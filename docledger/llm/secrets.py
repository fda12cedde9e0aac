"""Find secrets by form, and by a battery of randomness tests.

Three forms are base kinds: assignments, access keys and hex runs. Besides
them every other long token of letters and digits is tested against uniform
random symbols of the encoding its characters point to: chi-squared of the
symbol counts, number of runs above and below the middle of the alphabet, and
serial correlation of neighbours. The smallest of the three p-values, times
three, says how well the token passes for random. Words and identifiers fail.
As the power of the tests grows with length, failures are decided per band of
lengths, by the Benjamini-Hochberg rule over the distinct tokens of the band;
its threshold comes from a histogram of the logarithms of the p-values, which
has a bounded number of rows at any size. Tokens that don't fail are spans of
kind ``random``; base spans stay, and a random span never overlaps one.

Everything is SQL functions. Positions are code points, end exclusive; they
are sums of the lengths of matches and of the text between them. Tokens need a
letter and a digit to be tested: without a digit nothing is called random.

Defined results: null and empty texts have no span; repeated rows and rows with
a null id are judged one by one; a table without candidates has no threshold
and no random span; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docledger.session import checkpoint

# The base forms and the least lengths of a match.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_LEAST = 12

TOKEN = r"[A-Za-z0-9+/=_-]{20,}"
DEFAULT_RATE = 0.1
MOST_LOG = 30.0
STEPS = 100

# Alphabets by encoding, in the order of their symbols.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}


_SPAN_LIST = "array<struct<start:int,end:int,match:string>>"
_BISECTION = [1 << i for i in range(27, -1, -1)]


def _spans(text: Column, pattern: str) -> Column:
    """Array of (start, end, match) of the leftmost non-overlapping matches.

    Places are running sums. An array that grows step by step is copied at every
    step, so they are summed within blocks of about the square root of the
    matches, and the blocks' sums are added after.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    none = F.expr(f"cast(array() as {_SPAN_LIST})")
    pairs = F.zip_with(
        matches, F.slice(pieces, F.lit(1), F.size(matches)), lambda m, p: F.struct(F.length(p).alias("piece"), m.alias("match"))
    )

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + pair["piece"]
        end = start + F.length(pair["match"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["match"].alias("match"))
        return F.struct(end.alias("at"), F.array_append(state["out"], span).alias("out"))

    def added(state: Column, block: Column) -> Column:
        return F.struct((state["at"] + block["at"]).alias("at"), F.array_append(state["out"], state["at"]).alias("out"))

    def blocks(pairs: Column) -> Column:
        of = F.ceil(F.sqrt(F.size(pairs).cast("double"))).cast("int")
        firsts = F.sequence(F.lit(1), F.size(pairs), of)
        zero = F.struct(F.lit(0).alias("at"), none.alias("out"))
        return F.transform(firsts, lambda first: F.aggregate(F.slice(pairs, first, of), zero, step))

    def moved(found: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("out"))
        before = F.aggregate(found, zero, added, lambda state: state["out"])

        def shift(block: Column, by: Column) -> Column:
            return F.transform(
                block["out"],
                lambda s: F.struct((s["start"] + by).alias("start"), (s["end"] + by).alias("end"), s["match"].alias("match")),
            )

        return F.flatten(F.zip_with(found, before, shift))

    # One lambda a step binds what is used more than once.
    found = F.flatten(F.transform(F.array(pairs), lambda p: F.flatten(F.transform(F.array(blocks(p)), moved))))
    return F.when(text.rlike(pattern), found).otherwise(none)


def _apart(span: Column, others: Column) -> Column:
    """Whether the span meets none of ``others``, which are in order and don't overlap: the last that begins before its end decides."""
    steps = F.array(*[F.lit(i) for i in _BISECTION])
    before = F.aggregate(
        steps, F.lit(0), lambda low, step: F.when(F.get(others, low + step - 1)["start"] < span["end"], low + step).otherwise(low)
    )
    return F.coalesce(F.get(others, before - 1)["end"] <= span["start"], F.lit(True))


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution, by a rational approximation (error below 1e-7)."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    # Coefficients of the approximation.
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = F.exp(-z * z / 2) / 2.5066282746310002 * poly
    return F.when(z >= 0, upper).otherwise(1 - upper)


def _candidates(spans: Column) -> Column:
    def likely(span: Column) -> Column:
        match = span["match"]
        return match.rlike("[0-9]") & match.rlike("[A-Za-z]")

    return F.filter(spans, likely)


def encoding(token: Column) -> Column:
    core = F.regexp_replace(token, "=+", "")
    return (
        F.when(core.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), "hex")
        .when(core.rlike("^[A-Z2-7]+$"), "base32")
        .when(core.rlike("[-_]"), "base64url")
        .otherwise("base64")
    )


def tested(tokens: DataFrame) -> DataFrame:
    """Columns encoding, n and log_p (minus the decimal logarithm of p) for each ``token``."""
    named = tokens.withColumn("encoding", encoding(F.col("token")))
    alphabet = F.element_at(F.create_map(*[F.lit(x) for pair in ALPHABETS.items() for x in pair]), F.col("encoding"))
    folded = F.when(F.col("encoding") == "hex", F.lower("token")).otherwise(F.col("token"))
    symbols = F.filter(
        F.transform(F.split(F.regexp_replace(folded, "=+", ""), ""), lambda c: F.instr(alphabet, c) - 1), lambda v: v >= 0
    )
    coded = named.withColumn("values", symbols).withColumn("n", F.size("values")).withColumn("m", F.length(alphabet))
    n, m, values = F.col("n"), F.col("m"), F.col("values")
    total = lambda array: F.aggregate(array, F.lit(0.0), lambda a, x: a + x)
    squares = total(
        F.transform(F.sequence(F.lit(0), m - 1), lambda s: F.pow(F.size(F.filter(values, lambda v: v == s)).cast("double"), 2.0))
    )
    mean = total(F.transform(values, lambda v: v.cast("double"))) / n
    neighbours = F.zip_with(F.slice(values, F.lit(1), n - 1), F.slice(values, F.lit(2), n - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    high = lambda v: (v * 2 >= m).cast("int")
    measured = (
        coded.where(n >= 2)
        .withColumn("mean", mean)
        .withColumn("ups", F.size(F.filter(values, lambda v: v * 2 >= m)).cast("double"))
        .withColumn("chi", squares * m / n - n)
        .withColumn("pairs", neighbours)
        .withColumn("runs", F.size(F.filter("pairs", lambda p: high(p["a"]) != high(p["b"]))) + 1.0)
        .withColumn("spread", total(F.transform(values, lambda v: (v - F.col("mean")) * (v - F.col("mean")))))
        .withColumn("moved", total(F.transform("pairs", lambda p: (p["a"] - F.col("mean")) * (p["b"] - F.col("mean")))))
    )
    chi_z = (F.col("chi") - (m - 1)) / F.sqrt(2.0 * (m - 1) * (n - 1) / n)
    both = 2.0 * F.col("ups") * (n - F.col("ups"))
    runs_var = both * (both - n) / (n * n * (n - 1.0))
    runs_z = F.when(runs_var > 0, (F.col("runs") - (both / n + 1)) / F.sqrt(runs_var)).otherwise(F.sqrt(n.cast("double")))
    serial_z = F.when(F.col("spread") > 0, F.col("moved") / F.col("spread") * F.sqrt(n.cast("double"))).otherwise(
        F.sqrt(n.cast("double"))
    )
    p = F.least(_tail(chi_z), 2 * _tail(F.abs(runs_z)), 2 * _tail(F.abs(serial_z))) * 3
    log_p = F.least(F.lit(MOST_LOG), F.greatest(F.lit(0.0), -F.log10(F.greatest(p, F.lit(1e-300)))))
    return measured.withColumn("log_p", log_p).drop(
        "values", "m", "mean", "ups", "chi", "pairs", "runs", "spread", "moved"
    )


def band(n: Column) -> Column:
    """Band of lengths: two to each doubling."""
    return F.floor(F.log2(n.cast("double")) * 2).cast("int")


def thresholds(tokens: DataFrame, rate: float = DEFAULT_RATE) -> DataFrame:
    """Per band the least log_p that counts as structured at this false-discovery rate.

    ``tokens``: distinct tokens with n and log_p. P-values are rounded to the grid
    of the histogram, towards 1, so the rule holds as it would on exact ones.
    """
    counts = tokens.groupBy(band(F.col("n")).alias("band"), F.floor(F.col("log_p") * STEPS).alias("step")).agg(
        F.count("*").alias("tokens")
    )
    most = W.partitionBy("band")
    so_far = most.orderBy(F.desc("step"))
    ruled = counts.withColumn("rank", F.sum("tokens").over(so_far)).withColumn("all", F.sum("tokens").over(most))
    held = F.pow(F.lit(10.0), -F.col("step") / STEPS) <= rate * F.col("rank") / F.col("all")
    return ruled.groupBy("band").agg(F.min(F.when(held, F.col("step"))).alias("from_step"))


def find_secrets(docs: DataFrame, rate: float = DEFAULT_RATE) -> DataFrame:
    """doc_id, base and spans: arrays of (start, place of the kind, kind, end) in order.

    The text is read once; what matches goes to the shared folder. Distinct
    tokens are counted after a combine on the map side, so a token that every
    document repeats is one row a partition.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    long_enough = lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= ASSIGN_LEAST
    found = docs.select(
        "doc_id",
        F.filter(_spans(text, ASSIGN), long_enough).alias("assign"),
        _spans(text, ACCESS).alias("access"),
        _spans(text, HEX).alias("hex"),
        _candidates(_spans(text, TOKEN)).alias("tokens"),
    )
    kind = lambda name, place: F.transform(
        name, lambda s: F.struct(s["start"], F.lit(place).alias("place"), F.lit(name).alias("kind"), s["end"])
    )
    base = F.array_sort(F.concat(kind("assign", 1), kind("access", 2), kind("hex", 3)))
    alone = lambda s: _apart(s, F.col("assign")) & _apart(s, F.col("access")) & _apart(s, F.col("hex"))
    found = checkpoint(
        found.select("doc_id", base.alias("base"), F.filter("tokens", alone).alias("tokens")).withColumn(
            "row", F.monotonically_increasing_id()
        )
    )
    each = found.select("row", F.explode("tokens").alias("span")).select("row", "span.start", "span.end", F.col("span.match").alias("token"))
    limits = checkpoint(thresholds(tested(each.select("token").distinct()), rate))
    judged = tested(each).join(F.broadcast(limits.withColumnRenamed("band", "of_band")), band(F.col("n")) == F.col("of_band"))
    passed = F.col("from_step").isNull() | (F.floor(F.col("log_p") * STEPS) < F.col("from_step"))
    random = judged.where(passed).groupBy("row").agg(
        F.collect_list(F.struct("start", F.lit(4).alias("place"), F.lit("random").alias("kind"), "end")).alias("random")
    )
    joined = found.join(random, "row", "left")
    spans = F.when(F.col("random").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "random")))
    return joined.select("doc_id", "base", spans.alias("spans"))


def joined_spans(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
