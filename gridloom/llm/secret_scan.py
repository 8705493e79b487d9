"""Secrets in texts. DataFrame functions only.

Base patterns give assigned secrets, access keys and hexadecimal strings. A randomness battery adds strings that no
pattern names: for each long run of token characters an encoding is inferred, then

* three tests ask whether it fits uniform symbols of that encoding: chi-squared uniformity of the alphabet, runs on
  either side of the middle symbol, and serial correlation of neighbours; their p-values are combined by Fisher's rule
  and the run has to pass;
* a collision test asks whether it fits ordinary text: among n symbols there are n(n-1)/2 pairs and text repeats
  symbols more often than uniform ones do. Its p-value falls with length, and the Benjamini-Hochberg rule over all runs
  of the corpus sets the threshold, so short runs need to look the less like text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: The base patterns in the order in which kinds are listed. A hexadecimal run or access key is as long as it can be,
#: so asking for its length in the pattern is the same as dropping short ones after.
KINDS = ["assign", "access", "hex", "random"]
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
SHORTEST_VALUE = 12

#: Runs that the battery looks at.
RUN = r"[A-Za-z0-9+/_-]{20,}"
#: Encodings in the order in which they are tried (base 16, 32, 36, 64): pattern of the whole run, symbols, chance that two symbols of
#: ordinary text or of plain numbers agree.
ENCODINGS = [
    (r"(?=.*[0-9])(?=.*[a-f])[0-9a-f]+", "0123456789abcdef", 0.1),
    (r"(?=.*[0-9])(?=.*[A-F])[0-9A-F]+", "0123456789ABCDEF", 0.1),
    (r"(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 0.055),
    (r"(?=.*[0-9])(?=.*[a-z])[a-z0-9]+", "abcdefghijklmnopqrstuvwxyz0123456789", 0.055),
    (r"(?=.*[0-9])(?=.*[A-Z])[A-Z0-9]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 0.055),
    (r".*", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 0.055),
]
#: A run fails the battery below this; share of false discoveries; steps of the p-value scale per power of ten, and steps.
UNIFORM, FALSE_SHARE, STEPS, DEPTH = 0.01, 0.01, 4, 400
REDACTED = "[SECRET]"
#: Matches whose places are summed up in one list.
STRETCH = 256


def let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.transform(F.array(value), body)[0]


def running(values: Column, combine=lambda a, b: a + b, first: int = 0) -> Column:
    """Sums of an array of int up to each place, or what ``combine`` makes of all values so far; ``first`` changes nothing.

    Each result is appended to a list, which copies it, so lists are those of short stretches, put together by the
    results before them.
    """
    start = F.struct(F.lit(first).alias("sum"), F.array().cast("array<int>").alias("sums"))

    def sums(part: Column) -> Column:
        def step(state: Column, x: Column) -> Column:
            return let(combine(state["sum"], x), lambda s: F.struct(s.alias("sum"), F.array_append(state["sums"], s).alias("sums")))

        return F.aggregate(part, start, step, lambda state: state["sums"])

    last = F.floor((F.size(values) - 1) / STRETCH).cast("int")
    stretches = F.transform(F.sequence(F.lit(0), last), lambda i: sums(F.slice(values, i * STRETCH + 1, F.lit(STRETCH))))

    def joined(parts: Column) -> Column:
        ends = F.transform(parts, lambda p: F.element_at(p, -1))
        before = sums(F.concat(F.array(F.lit(first)), F.slice(ends, F.lit(1), F.size(ends) - 1)))
        return F.flatten(F.zip_with(parts, before, lambda p, b: F.transform(p, lambda x: combine(x, b))))

    return F.when(F.size(values) > 0, let(stretches, joined)).otherwise(F.array().cast("array<int>"))


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as an array of (start, end, match), in code points, end exclusive.

    What lies between matches is as long as ``split`` says, so positions are running sums.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # The last gap has no match behind it.
    both = F.zip_with(F.split(text, pattern, -1), found, lambda gap, match: F.when(
        match.isNotNull(), F.char_length(gap) + F.char_length(match)))
    listed = let(found, lambda found: F.zip_with(running(F.filter(both, lambda x: x.isNotNull())), found, lambda end, match: F.struct(
        (end - F.char_length(match)).alias("start"), end.alias("end"), match.alias("match"))))
    return F.when(text.rlike(pattern), listed).otherwise(F.array().cast("array<struct<start:int,end:int,match:string>>"))


def normal_tail(z: Column) -> Column:
    """Chance of more than z, by a logistic approximation of the normal distribution."""
    return 1 / (1 + F.exp(F.lit(1.5976) * z + F.lit(0.07056) * F.pow(z, F.lit(3))))


def tests(run: Column) -> Column:
    """Struct (uniform, text) of p-values for a run: of uniform symbols, and of ordinary text."""
    symbols, agree = F.lit(None).cast("string"), F.lit(None).cast("double")
    for pattern, alphabet, chance in reversed(ENCODINGS):
        fits = run.rlike(f"^{pattern}$")
        symbols = F.when(fits, F.lit(alphabet)).otherwise(symbols)
        agree = F.when(fits, F.lit(chance)).otherwise(agree)
    # The two last symbols of base 64 are written in two ways.
    plain = F.filter(F.split(F.translate(run, "-_", "+/"), ""), lambda c: c != "")
    return let(symbols, lambda alphabet: let(
        F.transform(plain, lambda c: F.position(c, alphabet) - 1),
        lambda values: from_values(values, F.char_length(alphabet).cast("double"), agree)))


def from_values(values: Column, k: Column, agree: Column) -> Column:
    """The p-values of symbols numbered from 0, of an alphabet of k; ``agree`` is the chance that two symbols of text agree."""
    n = F.size(values).cast("double")
    zero = F.lit(0).cast("double")
    squares = F.aggregate(
        F.array_distinct(values), zero,
        lambda s, v: s + F.pow(F.size(F.filter(values, lambda x: x == v)).cast("double"), F.lit(2)),
    )
    pairs = F.zip_with(F.slice(values, 1, F.size(values) - 1), F.slice(values, 2, F.size(values)),
                       lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    middle, spread = (k - 1) / 2, (k * k - 1) / 12
    sums = F.aggregate(
        pairs, F.struct(zero.alias("changes"), zero.alias("products")),
        lambda s, x: F.struct(
            (s["changes"] + ((x["a"] > middle) != (x["b"] > middle)).cast("double")).alias("changes"),
            (s["products"] + (x["a"] - middle) * (x["b"] - middle)).alias("products")),
    )

    def scores(x: Column) -> Column:
        squares, changes, products = x["squares"], x["sums"]["changes"], x["sums"]["products"]
        chi = (k / n) * squares - n
        z_chi = (chi - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
        z_runs = (2 * changes - (n - 1)) / F.sqrt(n - 1)
        z_serial = products / (spread * F.sqrt(n - 1))
        collisions, expected = (squares - n) / 2, n * (n - 1) / 2 * agree
        return F.struct(z_chi.alias("chi"), F.abs(z_runs).alias("runs"), F.abs(z_serial).alias("serial"),
                        ((expected - collisions - 0.5) / F.sqrt(expected)).alias("text"))

    def half_statistic(z: Column) -> Column:
        ps = normal_tail(z["chi"]), 2 * normal_tail(z["runs"]), 2 * normal_tail(z["serial"])
        logs = [F.log(F.greatest(p, F.lit(1e-300))) for p in ps]
        return F.struct((-(logs[0] + logs[1] + logs[2])).alias("half"), normal_tail(z["text"]).alias("text"))

    def chances(x: Column) -> Column:
        half = x["half"]
        return F.struct((F.exp(-half) * (1 + half + half * half / 2)).alias("uniform"), x["text"].alias("text"))

    found = F.struct(squares.alias("squares"), sums.alias("sums"))
    return let(found, lambda x: let(scores(x), lambda z: let(half_statistic(z), chances)))


def looked_at(text: Column) -> Column:
    """Runs of token characters with their p-values."""
    return F.transform(matches(text, RUN), lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), tests(m["match"]).alias("p")))


def threshold(df: DataFrame, text: str = "text", share: float = FALSE_SHARE) -> float:
    """The largest p-value of text at which at most ``share`` of the runs below it are expected to be text.

    The Benjamini-Hochberg rule on a scale of ``DEPTH`` steps, so that any corpus is summed up in as many counts.
    Without a run that qualifies it is 0.
    """
    runs = df.select(F.explode(looked_at(F.coalesce(F.col(text), F.lit("")))).alias("run"))
    step = F.least(F.floor(-F.log10(F.greatest(F.col("run.p.text"), F.lit(1e-300))) * STEPS), F.lit(DEPTH))
    counts = {int(r[0]): r[1] for r in runs.groupBy(step.alias("step")).count().collect()}
    total, below, best = sum(counts.values()), 0, 0.0
    for s in range(DEPTH, -1, -1):
        below += counts.get(s, 0)
        highest = 10 ** (-s / STEPS)
        if below and highest * total / below <= share:
            best = highest
    return best


def with_secrets(df: DataFrame, text: str = "text", share: float = FALSE_SHARE) -> DataFrame:
    """``df`` with a column secrets: array of (start, kind, end), kind as its place in ``KINDS``, by start, then kind.

    Base spans stay as they are; runs found by the battery join them where they overlap no base span. A null text is
    empty and has none. Repeated rows give repeated rows; a column that is named secrets is replaced.
    """
    best = threshold(df, text, share)
    body = F.coalesce(F.col(text), F.lit(""))
    base = [
        F.filter(matches(body, ASSIGN), lambda m: F.char_length(F.regexp_extract(m["match"], ASSIGN, 2)) >= SHORTEST_VALUE),
        matches(body, ACCESS), matches(body, HEX),
    ]
    def of_kind(kind: int):
        return lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"))

    named = [F.transform(x, of_kind(i)) for i, x in enumerate(base)]
    random = F.filter(looked_at(body), lambda m: (m["p"]["text"] <= best) & (m["p"]["uniform"] >= UNIFORM))
    both = F.array_sort(F.concat(*named, F.transform(random, of_kind(len(base)))))
    return df.withColumn("secrets", let(both, without_overlaps))


def without_overlaps(spans: Column) -> Column:
    """Sorted spans without the runs of the battery that overlap a base span, in one pass each way: such a span ends
    behind the run's start or, if it starts later, begins before the run's end."""
    last, none = len(KINDS) - 1, 2**31 - 1
    base = lambda s, x, other: F.when(s["kind"] < last, x).otherwise(F.lit(other))
    ends = running(F.transform(spans, lambda s: base(s, s["end"], -1)), F.greatest, -1)
    starts = F.reverse(running(F.transform(F.reverse(spans), lambda s: base(s, s["start"], none)), F.least, none))
    free = let(ends, lambda ends: let(starts, lambda starts: F.filter(spans, lambda s, i: (s["kind"] < last) | (
        (F.get(ends, i) <= s["start"]) & (F.get(starts, i) >= s["end"])))))
    return F.when(F.exists(spans, lambda s: s["kind"] == last), free).otherwise(spans)


def written(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(df: DataFrame) -> DataFrame:
    """Counts of base spans, their digest and all spans, from rows with secrets."""
    count = lambda i: F.size(F.filter("secrets", lambda s: s["kind"] == i)).cast("long")
    return df.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(written(F.filter("secrets", lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
        written(F.col("secrets")).alias("spans"),
    )


def redacted(text: Column, spans: Column) -> Column:
    """Text with each stretch that spans cover replaced by a marker."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        kept = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        fresh = F.struct(s["end"].alias("at"), F.concat(state["out"], kept, F.lit(REDACTED)).alias("out"))
        wider = F.struct(F.greatest(s["end"], state["at"]).alias("at"), state["out"].alias("out"))
        return F.when((s["start"] >= state["at"]), fresh).otherwise(wider)

    end = lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.char_length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, end)).otherwise(text)
