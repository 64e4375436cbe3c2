"""Secret scan: fixed patterns plus a battery of randomness tests. SQL functions only.

Patterns find assignments, access keys and hexadecimal strings. Every other run of
TOKEN characters is tested for randomness. For its inferred encoding (decimal, hex,
base 32, lower or upper case with digits, base 62, base 64) three statistics measure how
far it lies from what is not random:

* chi-squared of the symbols against the uniform alphabet, under a null of twice the
  uniform concentration;
* runs of digits, lower and upper case (of the lower and the upper half of the digits, where
  there are only digits), under a null of a change of class at one boundary in four, which
  identifiers and words stay below;
* serial correlation of neighbouring symbols, under a null of one half.

Each becomes a normal score and their sum one p-value (Stouffer). Which tokens count as
random is decided by the Benjamini-Hochberg step-up rule within each stratum of token
lengths over the whole table: one pass makes the histogram of scores for each
stratum, a second applies the thresholds. Rows are never moved or joined.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.llm.registry import query, table

# Kinds in the order in which spans at one place are listed.
KINDS = ["assign", "access", "hex", "random"]
# Patterns of the base kinds.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 6, 20, 24

TOKEN_CHARS = 16
TOKEN = "[A-Za-z0-9+/_-]{%d,}" % TOKEN_CHARS
CHANGE, CONCENTRATION, CORRELATION = 0.25, 2.0, 0.5  # the three nulls
FALSE_DISCOVERIES = 0.01
STRATA = [16, 20, 24, 32, 40, 48, 64, 96, 128, 256]  # smallest lengths
BINS = 20  # of scores, for each unit

SPAN = "struct<start:int,end:int,rank:int>"


def matches(text: Column, pattern: str, likely: str) -> Column:
    """array<struct<start, end, found>>: leftmost matches of a pattern that don't overlap,
    in code points, end exclusive. `likely` is a cheap pattern that a text with a wanted
    match must match."""
    before = F.regexp_extract_all(text, F.lit(f"(?s)(.*?)(?:{pattern}|\\z)"), F.lit(1))
    found = F.regexp_extract_all(text, F.lit(f"(?s).*?((?:{pattern})|\\z)"), F.lit(1))

    pairs = F.arrays_zip(before.alias("before"), found.alias("found"))
    sized = F.transform(pairs, lambda p: F.struct(
        F.char_length(p["before"]).alias("gap"), (F.char_length(p["before"]) + F.char_length(p["found"])).alias("size"), p["found"].alias("found")))

    # Running ends in blocks of about the root of the number of matches: no array grows by one
    # element at a time, so many matches in one text cost little more than each alone. What is
    # used again is bound as the one element of an array.
    total = lambda part: F.aggregate(part, F.lit(0), lambda acc, m: acc + m["size"])
    held = F.transform(F.array(sized), lambda m: F.struct(
        m.alias("m"), F.greatest(F.ceil(F.sqrt(F.size(m))).cast("int"), F.lit(1)).alias("step")))
    summed = F.transform(held, lambda e: F.struct(
        e["m"].alias("m"), e["step"].alias("step"), F.transform(
            F.sequence(F.lit(0), F.floor(F.size(e["m"]) / e["step"]).cast("int")),
            lambda b: total(F.slice(e["m"], b * e["step"] + 1, e["step"]))).alias("sums")))
    bound = F.transform(summed, lambda e: F.struct(
        e["m"].alias("m"), e["step"].alias("step"), F.transform(
            e["sums"], lambda n, b: F.aggregate(F.slice(e["sums"], F.lit(1), b), F.lit(0), lambda acc, x: acc + x)).alias("firsts")))

    def span(e: Column, m: Column, i: Column) -> Column:
        block = F.floor(i / e["step"]).cast("int")
        at = F.get(e["firsts"], block) + total(F.slice(e["m"], block * e["step"] + 1, i - block * e["step"]))
        return F.transform(F.array(at), lambda a: F.struct(
            (a + m["gap"]).alias("start"), (a + m["size"]).alias("end"), m["found"].alias("found")))[0]

    walked = F.flatten(F.transform(bound, lambda e: F.transform(e["m"], lambda m, i: span(e, m, i))))
    none = F.lit([]).cast("array<struct<start:int,end:int,found:string>>")
    return F.when(text.rlike(likely), F.filter(walked, lambda s: s["found"] != "")).otherwise(none)


def ranked(spans: Column, kind: str) -> Column:
    rank = KINDS.index(kind)
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.lit(rank).alias("rank")))


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns by start, then kind."""
    value = lambda s: F.char_length(F.regexp_extract(s["found"], ASSIGN, 2))
    likely = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"
    assign = F.filter(matches(text, ASSIGN, likely), lambda s: value(s) >= ASSIGN_CHARS)
    access = F.filter(matches(text, ACCESS, "AKIA[A-Z0-9]{%d}" % (ACCESS_CHARS - 4)),
                      lambda s: s["end"] - s["start"] >= ACCESS_CHARS)
    hexes = matches(text, "[0-9a-f]{%d,}" % HEX_CHARS, "[0-9a-f]{%d}" % HEX_CHARS)
    return in_order(F.concat(ranked(assign, "assign"), ranked(access, "access"), ranked(hexes, "hex")))


def in_order(spans: Column) -> Column:
    key = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end")))
    return F.transform(F.array_sort(key), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["rank"].alias("rank")))


# -- randomness ---------------------------------------------------------------


def alphabet(token: Column) -> Column:
    """Number of symbols of the inferred encoding."""
    return (
        F.when(token.rlike("^[0-9]+$"), 10)
        .when(token.rlike("^([0-9a-f]+|[0-9A-F]+)$"), 16)
        .when(token.rlike("^[A-Z2-7]+$"), 32)
        .when(token.rlike("^([0-9a-z]+|[0-9A-Z]+)$"), 36)
        .when(token.rlike("^[0-9A-Za-z]+$"), 62)
        .otherwise(64).cast("double")
    )


def score(token: Column) -> Column:
    """Normal score of a token's randomness: the larger, the less it is like a word, an
    identifier, a counter or a repetition. Needs four characters or more."""
    symbols = F.filter(F.split(token, ""), lambda c: c != "")
    codes = F.transform(symbols, lambda c: F.ascii(c).cast("double"))
    n, k = F.char_length(token).cast("double"), alphabet(token)

    squares = F.aggregate(
        F.transform(F.array_distinct(codes), lambda d: F.pow(F.size(F.filter(codes, lambda x: x == d)), F.lit(2.0))),
        F.lit(0.0), lambda a, x: a + x)
    chi = squares * k / n - n
    shift = n * (CONCENTRATION - 1)
    uniform = (k - 1 + shift - chi) / F.sqrt(2 * (k - 1 + 2 * shift))

    letters = F.filter(F.split(F.regexp_replace(token, "[^A-Za-z0-9]", ""), ""), lambda c: c != "")
    # digits alone have one class: the halves of their alphabet stand for classes
    kind = F.transform(letters, lambda c: F.when((k == 10) & (c < "5"), 3).when(c <= "9", 0).when(c <= "Z", 1).otherwise(2))
    m = F.greatest(F.size(kind) - 1, F.lit(1)).cast("double")
    pairs = F.arrays_zip(F.slice(kind, 1, F.greatest(F.size(kind) - 1, F.lit(0))).alias("a"),
                         F.slice(kind, 2, F.greatest(F.size(kind) - 1, F.lit(0))).alias("b"))
    changes = F.size(F.filter(pairs, lambda p: p["a"] != p["b"])).cast("double")
    runs = (changes - m * CHANGE) / F.sqrt(m * CHANGE * (1 - CHANGE))

    total = lambda values: F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    mean = total(codes) / n
    off = F.transform(codes, lambda x: x - mean)
    variance = total(F.transform(off, lambda x: x * x))
    neighbours = F.zip_with(F.slice(off, 1, F.size(off) - 1), F.slice(off, 2, F.size(off) - 1), lambda a, b: a * b)
    r = F.least(F.abs(F.coalesce(F.try_divide(total(neighbours), variance), F.lit(1.0))), F.lit(0.999))
    serial = (F.lit(math.atanh(CORRELATION)) - F.atanh(r)) * F.sqrt(n - 3)
    return (uniform + runs + serial) / math.sqrt(3)


def stratum(token: Column) -> Column:
    n = F.char_length(token)
    out = F.lit(0)
    for i, least in enumerate(STRATA):
        out = F.when(n >= least, i).otherwise(out)
    return out


def thresholds(texts: DataFrame, text_col: str, rate: float = FALSE_DISCOVERIES) -> list[float]:
    """Smallest score that counts as random, for each stratum, by the step-up rule over all
    tokens of all texts (infinite where none does). Scores are binned downwards, so the rate
    is kept. The histogram has one row for each stratum and bin: a bounded size."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    tokens = texts.select(F.explode(matches(text, TOKEN, TOKEN)).alias("m")).select(F.col("m.found").alias("token"))
    bin_ = F.greatest(F.least(F.floor(score(F.col("token")) * BINS), F.lit(40 * BINS)), F.lit(-40 * BINS))
    rows = tokens.groupBy(stratum(F.col("token")).alias("stratum"), bin_.alias("bin")).count().collect()
    out = []
    for i in range(len(STRATA)):
        bins = sorted(((r["bin"], r["count"]) for r in rows if r["stratum"] == i), reverse=True)
        tests, found, least = sum(c for _, c in bins), 0, math.inf
        for b, count in bins:
            found += count
            p = 0.5 * math.erfc(b / BINS / math.sqrt(2))
            if p * tests <= rate * found:
                least = b / BINS
        out.append(least)
    return out


def random_spans(text: Column, base: Column, least: list[float]) -> Column:
    """Spans of random tokens that no base span covers."""
    limit = F.array(*[F.lit(float(x)) for x in least])
    found = F.filter(matches(text, TOKEN, TOKEN), lambda s: ~F.exists(
        base, lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"])))
    return ranked(F.filter(found, lambda s: score(s["found"]) >= F.get(limit, stratum(s["found"]))), "random")


def scan(
    df: DataFrame, text_col: str, rate: float = FALSE_DISCOVERIES, base_as: str = "base", spans_as: str = "spans"
) -> DataFrame:
    """df with `base` and `spans`: array<struct<start, end, rank>> of the fixed patterns and
    of all secrets, by start, then kind (KINDS[rank]); code points, end exclusive.

    Null and empty texts have no spans; texts are scanned whole; repeated rows get equal
    spans; an empty table stays empty. Columns of df with the names of the two are replaced.
    """
    least = thresholds(df, text_col, rate)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    out = df.withColumn(base_as, base_spans(text))
    return out.withColumn(spans_as, in_order(F.concat(base_as, random_spans(text, F.col(base_as), least))))


def listed(spans: Column | str) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """text with each span, or run of overlapping spans, replaced by a mark."""
    def add(acc: Column, s: Column) -> Column:
        apart = s["start"] >= acc["at"]
        kept = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(apart, F.concat(acc["out"], kept, F.lit(mark))).otherwise(acc["out"]).alias("out"),
        )

    done = F.aggregate(
        spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), add,
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text))),
    )
    return F.when(F.size(spans) > 0, done).otherwise(text)


@query("op8_secret_scan")
def op8(spark, sf_dir):
    """Secrets of all documents."""
    out = scan(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    count = lambda kind: F.size(F.filter("base", lambda s: s["rank"] == KINDS.index(kind))).cast("long")
    return out.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"),
    )
