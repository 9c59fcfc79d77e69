"""Secret scans in DataFrame functions only: fixed patterns and a battery of randomness tests.

Random-looking tokens are found by testing each token of the alphabet of its inferred encoding for
randomness: character frequencies against the uniform distribution (chi-squared), runs above and
below the middle of the alphabet, runs of capitals, small letters, digits and signs, and serial
correlation of neighbours. Tokens that fail are text.
Which p-values count as failures is settled by false-discovery control within each encoding and
length class, so that of the tokens cleared as text a share of `rate` at most is random. From which length
on tokens without digits are tested is a parameter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.bind import let
from .common import unused

#: The patterns of the contract; fixed values. Lengths are folded into a pattern where that leaves its matches the same.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
KINDS = ["assign", "access", "hex", "random"]

#: Alphabets of the encodings, in the order in which they are tried; fixed values.
ENCODINGS = [
    ("hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef"),
    ("letters of one case", r"^(?:[a-z]+|[A-Z]+)$", "abcdefghijklmnopqrstuvwxyz"),
    ("base32", r"^[A-Z2-7]+$", "abcdefghijklmnopqrstuvwxyz234567"),
    ("base36", r"^(?:[a-z0-9]+|[A-Z0-9]+)$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("letters", r"^[A-Za-z]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base62", r"^[A-Za-z0-9]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", r"", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"),
]
#: Where the classes of characters begin in each alphabet, four classes at most; 99 for none.
CLASS_STARTS = [(10, 99, 99), (99, 99, 99), (26, 99, 99), (10, 99, 99), (26, 99, 99), (26, 52, 99), (26, 52, 62)]
ONE_CASE = 4  # encodings before this one do not tell capitals from small letters


def class_changes(encoding: int) -> tuple[float, float]:
    """How often neighbours of a random token differ in class, and the covariance of that with the next pair."""
    size = len(ENCODINGS[encoding][2])
    edges = [0, *(min(x, size) for x in CLASS_STARTS[encoding]), size]
    shares = [(b - a) / size for a, b in zip(edges, edges[1:])]
    q = 1 - sum(x * x for x in shares)
    return q, sum(x * (1 - x) ** 2 for x in shares) - q * q


BIN = 0.05  # width of a p-value class, in powers of ten
LEAST_WITHOUT_DIGITS = 40  # default of the parameter; see with_secrets


def blocks_of(items: Column) -> Column:
    """An array cut into about as many slices as each of them is long, so that work that copies what it has so far stays far from the square of the length."""
    wide = lambda a: F.greatest(F.ceil(F.sqrt(F.size(a))).cast("int"), F.lit(1))
    return let(items, lambda a: let(wide(a), lambda w: F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / w).cast("int")), lambda i: F.slice(a, i * w + 1, w))))


def spans_of(text: Column, pattern: str, kind: int, least_value: int = 0, with_token: bool = False) -> Column:
    """array<struct<start, kind, end>> of a pattern's leftmost, non-overlapping matches, with_token with the match itself.

    Positions come from the lengths of the matches and of the text between them, added up within
    blocks of matches and then over the blocks. With least_value, matches whose second group is
    shorter are left out.
    """
    lengths = lambda a: F.transform(a, lambda x: F.length(x))
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if least_value else found
    items = F.arrays_zip(lengths(F.split(text, pattern, -1)).alias("gap"), lengths(found).alias("size"), lengths(values).alias("value"), *([found.alias("token")] if with_token else []))
    nothing = F.array().cast("array<struct<start:int,kind:int,end:int" + (",token:string>>" if with_token else ">>"))
    token = lambda x: [x["token"].alias("token")] if with_token else []

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        end = begin + F.coalesce(x["size"], F.lit(0))
        keep = x["value"] >= least_value  # null behind the last match
        span = F.array(F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), *token(x)))
        return F.struct(end.alias("at"), F.when(keep, F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    def join(acc: Column, block: Column) -> Column:
        moved = F.transform(block["out"], lambda s: F.struct((s["start"] + acc["at"]).alias("start"), s["kind"].alias("kind"), (s["end"] + acc["at"]).alias("end"), *token(s)))
        return F.struct((acc["at"] + block["at"]).alias("at"), F.concat(acc["out"], F.array(moved)).alias("out"))

    added = F.transform(blocks_of(items), lambda b: F.aggregate(b, F.struct(F.lit(0).alias("at"), nothing.alias("out")), step))
    start = F.struct(F.lit(0).alias("at"), F.slice(F.array(nothing), 1, 0).alias("out"))
    return F.when(text.rlike(pattern), F.flatten(F.aggregate(added, start, join)["out"])).otherwise(nothing)


def upper_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal variable, by a rational approximation good to 1e-7."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-x * x / 2) * 0.3989422804014327 * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def encoding_of(token: Column) -> Column:
    """Index of the first encoding whose alphabet holds all of a token."""
    out = F.when(token.rlike(ENCODINGS[0][1]), 0)
    for i, (_, pattern, _) in enumerate(ENCODINGS[1:-1], 1):
        out = out.when(token.rlike(pattern), i)
    return out.otherwise(len(ENCODINGS) - 1)


def candidates(text: Column, least_without_digits: int = LEAST_WITHOUT_DIGITS) -> Column:
    """array<struct<start, kind, end, encoding, length_class, bin>> of the tokens that the battery tests.

    bin is -log10 of the battery's p-value in classes of BIN. The work goes in stages, an array of
    structs each, so that what a later stage uses often is computed once for a token.
    """
    alphabets = F.array(*[F.lit(a) for *_, a in ENCODINGS])
    keep = lambda s: [s["start"].alias("start"), s["end"].alias("end")]
    named = lambda **columns: [c.alias(k) for k, c in columns.items()]

    def testable(s: Column) -> Column:
        return (s["token"].rlike("[0-9]") & s["token"].rlike("[A-Za-z]")) | (F.length(s["token"]) >= least_without_digits)

    def infer(s: Column) -> Column:
        return F.struct(*keep(s), *named(token=s["token"], encoding=encoding_of(s["token"])))

    def number(s: Column) -> Column:
        alphabet = F.element_at(alphabets, s["encoding"] + 1)
        plain = F.when(s["encoding"] < ONE_CASE, F.lower(s["token"])).otherwise(s["token"])
        codes = F.transform(F.split(plain, ""), lambda c: F.instr(alphabet, c).cast("double") - 1)
        starts = F.element_at(F.array(*[F.array(*map(F.lit, x)) for x in CLASS_STARTS]), s["encoding"] + 1)
        return F.struct(*keep(s), *named(encoding=s["encoding"], k=F.length(alphabet).cast("double"), codes=codes, starts=starts))

    def count(s: Column) -> Column:
        codes, k = s["codes"], s["k"]
        pairs = F.arrays_zip(F.slice(codes, 1, F.size(codes) - 1).alias("a"), F.slice(codes, 2, F.size(codes) - 1).alias("b"))
        group = lambda c: F.size(F.filter(s["starts"], lambda x: c >= x))
        often = lambda c: F.size(F.filter(codes, lambda d: d == c)).cast("double")
        return F.struct(*keep(s), *named(
            encoding=s["encoding"], k=k, n=F.size(codes).cast("double"),
            squares=F.aggregate(F.array_distinct(codes), F.lit(0.0), lambda a, c: a + often(c) * often(c)),
            high=F.size(F.filter(codes, lambda c: c >= k / 2)).cast("double"),
            runs=F.size(F.filter(pairs, lambda p: (p["a"] >= k / 2) != (p["b"] >= k / 2))).cast("double") + 1,
            changes=F.size(F.filter(pairs, lambda p: group(p["a"]) != group(p["b"]))).cast("double"),
            serial=F.aggregate(pairs, F.lit(0.0), lambda a, p: a + (p["a"] - (k - 1) / 2) * (p["b"] - (k - 1) / 2)),
        ))

    def standardise(s: Column) -> Column:
        n, k, df = s["n"], s["k"], s["k"] - 1
        spread = 2 / (9 * df)
        chi = F.greatest((s["squares"] * k / n - n) / df, F.lit(1e-9))
        product = 2 * s["high"] * (n - s["high"])
        variance = product * (product - n) / (n * n * (n - 1))
        share, tie = (F.element_at(F.array(*[F.lit(class_changes(e)[i]) for e in range(len(ENCODINGS))]), s["encoding"] + 1) for i in range(2))
        return F.struct(*keep(s), *named(
            encoding=s["encoding"], n=n,
            chi=(F.pow(chi, F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread),
            runs=F.when(variance > 0, F.abs(s["runs"] - product / n - 1) / F.sqrt(variance)).otherwise(F.lit(9.0)),
            changes=F.when(share == 0, 0.0).otherwise(F.abs(s["changes"] - (n - 1) * share) / F.sqrt((n - 1) * share * (1 - share) + 2 * (n - 2) * tie)),
            serial=F.abs(s["serial"] / ((k * k - 1) / 12) / F.sqrt(n - 1)),
        ))

    def weigh(s: Column) -> Column:
        p = 4 * F.least(upper_tail(s["chi"]), *(2 * upper_tail(s[test]) for test in ("runs", "changes", "serial")))
        return F.struct(*keep(s), *named(encoding=s["encoding"], length_class=F.least(F.floor(F.log2(s["n"] / 20) * 2), F.lit(12)).cast("int"), p=p))

    def classify(s: Column) -> Column:
        bin_ = F.floor(-F.log10(F.greatest(F.least(s["p"], F.lit(1.0)), F.lit(1e-20))) / BIN).cast("int")
        return F.struct(s["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), *named(end=s["end"], encoding=s["encoding"], length_class=s["length_class"], bin=bin_))

    found = F.filter(spans_of(text, TOKEN, KINDS.index("random"), with_token=True), testable)
    for stage in (infer, number, count, standardise, weigh, classify):
        found = F.transform(found, stage)
    return found


def cutoffs_of(counts: DataFrame, rate: float) -> dict[tuple[int, int], int]:
    """(encoding, length class) -> first p-value class that step-up control at the rate rejects.

    counts: encoding, length_class, bin, n - as many rows as there are classes, however many tokens.
    """
    group = W.partitionBy("encoding", "length_class")
    ranked = counts.withColumn("below", F.sum("n").over(group.orderBy(F.desc("bin")))).withColumn("all", F.sum("n").over(group))
    rejected = ranked.filter(F.pow(F.lit(10.0), -F.col("bin") * BIN) <= rate * F.col("below") / F.col("all"))
    return {(r.encoding, r.length_class): r.bin for r in rejected.groupBy("encoding", "length_class").agg(F.min("bin").alias("bin")).collect()}


def cutoffs(docs: DataFrame, rate: float = 0.05, text_col: str = "text", least_without_digits: int = LEAST_WITHOUT_DIGITS) -> dict[tuple[int, int], int]:
    """cutoffs_of all tested tokens of all documents; at most one row per encoding and length class reaches the driver."""
    found = docs.select(F.explode(candidates(F.coalesce(F.col(text_col), F.lit("")), least_without_digits)).alias("c"))
    return cutoffs_of(found.groupBy("c.encoding", "c.length_class", "c.bin").agg(F.count("*").alias("n")), rate)


def secret_spans(text: Column, rejected: dict[tuple[int, int], int], least_without_digits: int = LEAST_WITHOUT_DIGITS) -> tuple[Column, Column]:
    """(base spans, added spans), each array<struct<start, kind, end>> in order."""
    base = F.array_sort(F.concat(spans_of(text, ASSIGN, 0, 6), spans_of(text, ACCESS, 1), spans_of(text, HEX, 2)))
    never, group = F.lit(1 << 30), lambda c: c["encoding"] * 100 + c["length_class"]
    first = F.create_map(*[F.lit(x) for (e, n), bin_ in sorted(rejected.items()) for x in (e * 100 + n, bin_)]) if rejected else None
    random = F.filter(candidates(text, least_without_digits), lambda c: c["bin"] < (F.coalesce(F.element_at(first, group(c)), never) if rejected else never))
    return base, F.transform(random, lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))


def with_secrets(docs: DataFrame, rate: float = 0.05, text_col: str = "text", base_name: str = "_base", spans_name: str = "_spans", least_without_digits: int = LEAST_WITHOUT_DIGITS) -> DataFrame:
    """docs with _base (spans of the fixed patterns) and _spans (those and the random tokens outside them).

    Spans are struct<start, kind, end> in code points, end exclusive, by start, then kind. Null and
    empty texts have none. Rows are neither dropped nor merged; nothing is shuffled but the counts
    of p-value classes. Columns of docs with the two names are replaced. Tokens without a digit are
    tested from least_without_digits characters on, in an alphabet of letters alone: in shorter ones the tests cannot tell
    all words from keys, so a lower value finds shorter keys of letters at the price of long words.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base, random = secret_spans(text, cutoffs(docs, rate, text_col, least_without_digits), least_without_digits)
    added = unused(docs, "random")
    both = docs.withColumn(base_name, base).withColumn(added, random)
    ranges = F.transform(blocks_of(F.col(base_name)), lambda b: F.struct(F.array_min(F.transform(b, lambda s: s["start"])).alias("lo"), F.array_max(F.transform(b, lambda s: s["end"])).alias("hi"), b.alias("spans")))
    meets = lambda r, lo, hi: (lo < r["end"]) & (r["start"] < hi)
    apart = let(ranges, lambda blocks: F.filter(added, lambda r: ~F.exists(blocks, lambda b: meets(r, b["lo"], b["hi"]) & F.exists(b["spans"], lambda s: meets(r, s["start"], s["end"])))))
    spans = F.when((F.size(base_name) > 0) & (F.size(added) > 0), F.array_sort(F.concat(base_name, apart))).otherwise(F.concat(base_name, added))
    return both.withColumn(spans_name, spans).drop(added)


def written(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def redact_secrets(docs: DataFrame, rate: float = 0.05, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """docs with every secret span replaced by a mark; overlapping spans get one mark. All rows and columns stay."""
    base, spans = unused(docs, "base"), unused(docs, "spans")
    marked = with_secrets(docs, rate, text_col, base, spans)
    text = F.col(text_col)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def block(acc: Column, own: Column) -> Column:
        """The text from where the last block ended to where these spans end, cut out once."""
        low = acc["at"]
        high = F.greatest(low, F.array_max(F.transform(own, lambda s: s["end"])))

        def step(inner: Column, s: Column) -> Column:
            gap = F.substring(inner["own"], inner["at"] - low + 1, s["start"] - inner["at"])
            fresh = s["start"] >= inner["at"]
            return F.struct(F.greatest(inner["at"], s["end"]).alias("at"), F.when(fresh, F.concat(inner["out"], gap, F.lit(mark))).otherwise(inner["out"]).alias("out"), inner["own"].alias("own"))

        first = F.struct(low.alias("at"), F.lit("").alias("out"), F.substring(text, low + 1, high - low).alias("own"))
        return F.aggregate(own, first, step, lambda inner: F.struct(inner["at"].alias("at"), F.concat(acc["out"], F.array(inner["out"])).alias("out")))

    rest = lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text)))
    clean = F.when(F.size(spans) > 0, F.aggregate(blocks_of(F.col(spans)), start, block, rest)).otherwise(text)
    return marked.withColumn(text_col, clean).select(*docs.columns)
