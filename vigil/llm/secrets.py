"""Secret scan: three fixed patterns, and a battery of randomness tests that
adds further strings. DataFrame functions only.

Candidates are long runs of key characters. Each is read in the
encoding that its characters suggest and tested for randomness: chi-squared
uniformity over the alphabet, the number of runs above and below its middle,
and serial correlation. The least of the three p-values, corrected for three
tests, is the candidate's score; a random string's score is spread over 0 to 1
and that of ordinary text lies near 0, the nearer the longer it is.

Which score is enough is decided for each class of length and alphabet. A text
model (``text_null``: ordinary words and numbers, joined as identifiers and
paths are) shows how often text of that length and alphabet scores so high,
whatever the table holds; the least score is taken at which that share, applied
to all candidates of the class, makes up at most ``FALSE_SHARE`` of what is
found. Where short strings cannot be told from text, none is added.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.llm.common import others, written

#: kind, pattern, group that counts, its least length (fixed values)
BASE = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
]
#: runs of key characters; also what the battery tests
RANDOM = ("random", r"[A-Za-z0-9+/_-]{20,}={0,2}", 0, 20)
KINDS = [*BASE, RANDOM]
FALSE_SHARE = 0.05
#: alphabets in the order in which they are tried
ENCODINGS = [
    ("decimal", "0123456789"),
    ("hex", "0123456789abcdef"),
    ("hex", "0123456789ABCDEF"),
    ("lower", "abcdefghijklmnopqrstuvwxyz"),
    ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("letters", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base62", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
    ("base64any", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"),
]
#: scores are compared in so many steps
STEPS = 50
#: the text model: ordinary words of several languages, words of hex digits, numbers
WORDS = """the and for that with this from have not are was will would there their which about other time people
new first data value name list file path user order number system service report status version update request
response handler manager factory config default length index buffer string object event account payment transaction
international information development management government available different important university community
der die und nicht mit sich auch werden haben ihre wurde zwischen verarbeitung entwicklung gesellschaft möglich
les des une dans pour pas sur plus avec sont cette leurs entre toujours gouvernement aujourd exemple question
los las que por con para una como pero sus este desde sobre también trabajo gobierno ejemplo desarrollo
quick jump zero exact key box query view work back check group light know give show value python spark""".split()
WORDS = [w for w in WORDS if w.isascii()]
HEX_WORDS = "face cafe dead beef feed decade facade bead deed fade added ace bed cab dad fed accede deface efface".split()
NUMBERS = "1 2 3 7 10 12 20 24 31 50 64 99 100 128 200 256 365 404 500 1000 1024 1999 2000 2019 2020 2024 2026 3000 5432 8080".split()
#: strings of the model in a class of length and form
MODELLED = 150
#: first and last class of length that the model holds: 20 to 362 characters;
#: longer text is told from random strings better still
FIRST_CLASS, LAST_CLASS = 8, 16
REDACTED = "[SECRET]"


def _pieces(text: Column, k: int) -> Column:
    """Matches of one kind in text order: what stands between it and the match
    before (code points), its own length, whether it counts, and the string
    where the battery needs it."""
    kind, pattern, group, least = KINDS[k]
    pat = F.lit(pattern)
    found = F.regexp_extract_all(text, pat, F.lit(0))
    parts = [F.split(text, pattern, -1).alias("gaps"), found.alias("found")]
    if group:
        parts.append(F.regexp_extract_all(text, pat, F.lit(group)).alias("graded"))

    def rows(s: Column) -> Column:
        return F.transform(s["found"], lambda m, i: F.struct(
            F.lit(k).alias("kind"), i.alias("i"), F.length(F.get(s["gaps"], i)).alias("gap"), F.length(m).alias("n"),
            (F.length(F.get(s["graded"], i) if group else m) >= least).alias("counts"),
            (m if kind == "random" else F.lit(None).cast("string")).alias("m")))

    # the parts are computed once for a text, not once for a match
    return F.when(F.regexp_like(text, pat), F.transform(F.array(F.struct(*parts)), rows)[0])


def matches(df: DataFrame, text_col: str) -> DataFrame:
    """The other columns of ``df``, a row number ``_row``, and one row per
    match (one with null kind for a row without any): kind, start, end, m, and
    whether it is long enough."""
    kept = others(df, text_col, "_row")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = F.array_compact(F.array(*[_pieces(text, k) for k in range(len(KINDS))]))
    # numbered before the matches are laid out, so that a row keeps one number
    rows = written(df.withColumn("_row", F.monotonically_increasing_id())
                   .select(*kept, "_row", F.explode_outer(F.flatten(found)).alias("p"))
                   .select(*kept, "_row", "p.*"), "secret-matches")
    before = Window.partitionBy("_row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("n")).over(before)
    return (rows.withColumn("end", end).withColumn("start", F.col("end") - F.col("n"))
            .select(*kept, "_row", "kind", "start", "end", "counts", "m"))


def _upper_tail(z: Column) -> Column:
    """P(Z >= z) of a standard normal by the logistic approximation
    1 / (1 + exp(1.5976 z + 0.07056 z^3)), within 0.0002."""
    z = F.greatest(F.least(z, F.lit(8.0)), F.lit(-8.0))
    return 1 / (1 + F.exp(1.5976 * z + 0.07056 * z * z * z))


def _two_sided(z: Column) -> Column:
    return F.least(F.lit(1.0), 2 * _upper_tail(F.abs(z)))


def battery(df: DataFrame) -> DataFrame:
    """Adds to candidates ``m`` (strings of one to the alphabets' characters)
    ``score``: three times the least p-value of the three tests, 1 at most; and
    ``_a``, the alphabet, and ``_chi_z``, the first test's normal deviate."""
    body = F.rtrim(F.col("m"), F.lit("="))
    alphabet = reduce(lambda rest, e: F.when(body.rlike(f"^[{_class(e[1])}]+$"), F.lit(e[1])).otherwise(rest),
                      reversed(ENCODINGS), F.lit(ENCODINGS[-1][1]))
    df = df.withColumn("_s", body).withColumn("_a", alphabet)
    # each alphabet symbol's count: what its removal takes away
    square = F.aggregate(F.split("_a", ""), F.lit(0.0), lambda acc, c: acc + F.pow(
        F.length("_s") - F.length(F.replace(F.col("_s"), c)), F.lit(2)))
    values = F.transform(F.split("_s", ""), lambda c: F.instr(F.col("_a"), c).cast("double"))
    df = (df.withColumn("_n", F.length("_s").cast("double")).withColumn("_k", F.length("_a").cast("double"))
          .withColumn("_chi", square * F.col("_k") / F.col("_n") - F.col("_n")).withColumn("_v", values))
    # Wilson and Hilferty: the cube root of chi-squared over its freedom is near normal
    free = F.col("_k") - 1
    chi_z = (F.cbrt(F.greatest(F.col("_chi"), F.lit(0.0)) / free) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
    middle = (F.col("_k") + 1) / 2
    df = df.withColumn("_up", F.transform("_v", lambda v: F.when(v > F.col("_k") / 2 + 0.5, 1.0).otherwise(0.0)))
    pairs = F.sequence(F.lit(0), F.size("_v") - 2)
    df = (df.withColumn("_runs", 1 + F.aggregate(pairs, F.lit(0.0), lambda acc, i: acc + F.abs(
                F.get("_up", i + 1) - F.get("_up", i))))
          .withColumn("_n1", F.aggregate("_up", F.lit(0.0), lambda acc, u: acc + u))
          .withColumn("_cov", F.aggregate(pairs, F.lit(0.0), lambda acc, i: acc + (
                F.get("_v", i + 1) - middle) * (F.get("_v", i) - middle)))
          .withColumn("_var", F.aggregate("_v", F.lit(0.0), lambda acc, v: acc + F.pow(v - middle, F.lit(2)))))
    n, n1 = F.col("_n"), F.col("_n1")
    both = 2 * n1 * (n - n1)
    spread = both * (both - n) / (n * n * (n - 1))
    runs_z = F.when(spread > 0, (F.col("_runs") - (1 + both / n)) / F.sqrt(spread)).otherwise(8.0)
    corr_z = F.when(F.col("_var") > 0, F.col("_cov") / F.col("_var") * F.sqrt(n)).otherwise(8.0)
    score = F.least(F.lit(1.0), 3 * F.least(_upper_tail(chi_z), _two_sided(runs_z), _two_sided(corr_z)))
    return df.withColumn("score", score).withColumn("_chi_z", chi_z).drop("_s", "_n", "_k", "_chi", "_v", "_up", "_runs", "_n1", "_cov", "_var")


def _class(alphabet: str) -> str:
    return alphabet.replace("-", r"\-")


def _length_class(n: Column) -> Column:
    """20-23, 24-31, 32-47, 48-63, 64-95, ...: two classes to an octave."""
    return F.floor(2 * F.log2(n.cast("double"))).cast("int")


def _deviate(tail: float) -> float:
    """The z at which ``_upper_tail`` is ``tail``."""
    low, high = -8.0, 8.0
    for _ in range(60):
        z = (low + high) / 2
        low, high = (z, high) if 1 / (1 + math.exp(1.5976 * z + 0.07056 * z ** 3)) > tail else (low, z)
    return low


_SHARES: list[tuple] = []


def modelled_text(spark: SparkSession) -> DataFrame:
    """Strings ``m`` of the text model: for each class of length the same
    number in every form, with lengths spread over the class."""
    #: letters, share of numbers among the words (in eighths), what stands between
    forms = [("lower", 0, ""), ("upper", 0, ""), ("title", 0, ""), ("lower", 2, ""), ("upper", 2, ""), ("title", 2, ""),
             ("lower", 1, "/"), ("title", 0, "/"), ("lower", 1, "-"), ("lower", 1, "_"), ("upper", 1, "_"),
             ("title", 1, "-/"), ("lower", 1, "_/"), ("number", 8, ""), ("hex", 4, ""), ("HEX", 4, ""), ("base32", 2, "")]
    table = F.array(*[F.struct(F.lit(k).alias("case"), F.lit(n).alias("numbers"), F.lit(s).alias("between"))
                      for k, n, s in forms])
    words, hexes, numbers = (F.array(*map(F.lit, w)) for w in (WORDS, HEX_WORDS, NUMBERS))
    few = F.array(*[F.lit(n) for n in NUMBERS if set(n) <= set("234567")])
    classes = LAST_CLASS - FIRST_CLASS + 1

    def draw(of: Column, salt: int, j: Column) -> Column:
        return F.get(of, F.pmod(F.xxhash64("id", j, F.lit(salt)), F.size(of)).cast("int"))

    def token(j: Column) -> Column:
        case = F.col("f.case")
        word = (F.when(case == "lower", draw(words, 1, j)).when(case.isin("upper", "base32"), F.upper(draw(words, 1, j)))
                .when(case == "title", F.initcap(draw(words, 1, j))).when(case == "hex", draw(hexes, 1, j))
                .otherwise(F.upper(draw(hexes, 1, j))))
        number = F.when(case == "base32", draw(few, 2, j)).otherwise(draw(numbers, 2, j))
        between = F.substring(F.col("f.between"), F.pmod(j, F.greatest(F.length("f.between"), F.lit(1))) + 1, F.lit(1))
        return F.concat(F.when(F.pmod(F.xxhash64("id", j, F.lit(3)), F.lit(8)) < F.col("f.numbers"), number).otherwise(word),
                        between)

    low = F.greatest(F.ceil(F.pow(F.lit(2.0), F.col("c") / 2)), F.lit(RANDOM[3]))
    high = F.ceil(F.pow(F.lit(2.0), (F.col("c") + 1) / 2))
    rows = (spark.range(len(forms) * classes * MODELLED)
            .withColumn("f", F.get(table, F.pmod("id", F.lit(len(forms))).cast("int")))
            .withColumn("c", FIRST_CLASS + F.pmod(F.floor(F.col("id") / len(forms)), F.lit(classes)))
            .withColumn("n", (low + F.pmod(F.xxhash64("id"), high - low)).cast("int")))
    # a string may begin inside a word
    whole = F.array_join(F.transform(F.sequence(F.lit(1), F.ceil(F.col("n") / 2).cast("int") + 3), token), "")
    return rows.select(F.substring(whole, F.pmod(F.xxhash64("id", F.lit(4)), F.lit(4)).cast("int") + 1, F.col("n")).alias("m"),
                       "n").where(F.length("m") == F.col("n")).select("m")


def text_null(spark: SparkSession) -> DataFrame:
    """_null (class of length), _a (alphabet) and ``share``: for the steps from
    1 on the share of text whose score reaches the step.

    It is counted on the modelled strings. Where they give out, it is the tail
    of the normal law of their chi-squared deviates (a score needs all three
    tests), so that a few keys among many strings of text can pass too.
    """
    tried = written(battery(written(modelled_text(spark), "modelled-text")).select(
        "_a", "_chi_z", _length_class(F.length("m")).alias("_null"),
        F.floor(F.col("score") * STEPS).cast("int").alias("_step")), "modelled-scores")
    null = tried.groupBy("_null", "_a").agg(F.count(F.lit(1)).alias("n"), F.avg("_chi_z").alias("mean"),
                                            F.stddev("_chi_z").alias("sd"), F.collect_list("_step").alias("steps"))
    needed = F.array(*[F.lit(_deviate(k / STEPS / 3)) for k in range(1, STEPS + 1)])

    def share(z: Column, i: Column) -> Column:
        seen = F.size(F.filter("steps", lambda s: s > i))
        tail = F.when(F.col("sd") > 0, _upper_tail((F.col("mean") - z) / F.col("sd"))).otherwise(1.0)
        return F.least((seen + 1) / (F.col("n") + 1), F.greatest(seen / F.col("n"), tail))

    return null.select("_null", "_a", F.transform(needed, share).alias("share"))


def _text_shares(spark: SparkSession) -> DataFrame:
    """``text_null``, which depends on no table: a hundred rows, computed once in a driver."""
    if not _SHARES:
        _SHARES.extend(tuple(r) for r in text_null(spark).collect())
    return spark.createDataFrame(_SHARES, "_null int, _a string, share array<double>")


def random_strings(found: DataFrame, false_share: float = FALSE_SHARE) -> DataFrame:
    """Of candidates (``m`` and other columns) those that the battery and the
    false-discovery control accept, without ``m``."""
    # tested once, for the counts and for the choice
    tried = written(battery(found).select(
        *others(found, "m"), "_a", _length_class(F.length("m")).alias("_len"),
        F.floor(F.col("score") * STEPS).cast("int").alias("_step")), "secret-scores")
    # counts by class and score step: some ten thousand rows at most
    steps = tried.groupBy("_len", "_a", "_step").agg(F.count(F.lit(1)).alias("t"))
    per_class = (steps.groupBy("_len", "_a").agg(F.collect_list(F.struct("_step", "t")).alias("s"), F.sum("t").alias("tt"))
                 .withColumn("_null", F.least("_len", F.lit(LAST_CLASS))))
    null = _text_shares(found.sparkSession)
    above = F.transform("share", lambda share, i: F.struct((i + 1).alias("k"), share.alias("share"), F.aggregate(
        "s", F.lit(0).cast("long"), lambda acc, x: acc + F.when(x["_step"] > i, x["t"]).otherwise(0)).alias("t")))
    fine = F.filter(above, lambda a: (a["t"] > 0) & (a["share"] * F.col("tt") <= false_share * a["t"]))
    least = (per_class.join(F.broadcast(null), ["_null", "_a"])
             .select("_len", "_a", F.array_min(F.transform(fine, lambda a: a["k"])).alias("_least")).where("_least is not null"))
    return (tried.join(F.broadcast(least), ["_len", "_a"]).where("_step >= _least")
            .drop("_len", "_a", "_step", "_least"))


def scan(df: DataFrame, text_col: str = "text", out_col: str = "spans", false_share: float = FALSE_SHARE) -> DataFrame:
    """The other columns of ``df`` with ``spans``: an array of (start, kind,
    end) in code points, by start, then kind as in ``KINDS``.

    Null and empty texts have no spans, an empty table gives an empty one, long
    texts are read whole. Repeated rows stay, each with its own spans. A column
    that bears the output's name is replaced; others may have any name.
    """
    rest = others(df, text_col, out_col)
    # the other columns travel in one, so that none meets an inner name
    packed = F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.lit(True)
    found = matches(df.select(F.col(f"`{text_col}`").alias("_text"), packed.alias("_rest")), "_text")
    last = len(KINDS) - 1
    added = random_strings(found.where(f"counts and kind = {last}").select("_row", "kind", "start", "end", "m"), false_share)
    spans = (found.where(f"counts and kind <> {last}").select("_row", "kind", "start", "end")
             .unionByName(added.select("_row", "kind", "start", "end"))
             .groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("_spans")))
    rows = found.select("_rest", "_row").dropDuplicates(["_row"])
    none = F.array().cast("array<struct<start:long,kind:int,end:long>>")
    return rows.join(spans, "_row", "left").select(
        *[F.col("_rest")[c].alias(c) for c in rest], F.coalesce("_spans", none).alias(out_col))


def labels(spans: Column) -> Column:
    """kind:start:end of each span, joined with commas."""
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with every span, or run of spans that touch, replaced once."""
    folded = F.aggregate(
        spans, F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at")),
        lambda acc, s: F.when(s["end"] <= acc["at"], acc).otherwise(F.struct(
            F.when((s["start"] <= acc["at"]) & (acc["done"] != ""), acc["done"])
            .otherwise(F.concat(acc["done"], F.substring(text, (acc["at"] + 1).cast("int"),
                                                         F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int")),
                                F.lit(REDACTED))).alias("done"), s["end"].alias("at"))))
    return F.concat(folded["done"], F.substring(text, (folded["at"] + 1).cast("int"), F.length(text)))
