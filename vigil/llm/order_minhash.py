"""Order MinHash fingerprints of texts, sensitive to edit distance. DataFrame
functions only.

The k-mers of a text are runs of ``K_WORDS`` words, numbered by occurrence, so
that repeats count. In a run without a blank that is longer than a word, or in
a script that writes none, each code point with the two after it is a word. For each of ``SIGNATURE`` orders of their hashes the
minimal k-mer of each of two hash classes is selected; the selected ones,
put back into text order, are hashed to one element. Two texts agree in an
element with a probability that falls both with k-mers they do not share and
with k-mers that changed places.

Within a row, packed (hash, position) numbers are sorted, which brings repeats
of a k-mer together in text order; a place in its run is an occurrence number.
K-mers are laid out as rows only to take minima of plain longs, with partial
aggregation where they lie, so one row per text is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import others, written

K_WORDS = 2
SIGNATURE = 32
#: a run of more code points, or with a letter of these scripts, has no words
LONGEST_WORD = 32
_WIDE = r"[\x{E00}-\x{10FFFF}]"  # where all these scripts lie; a quick test
_NO_BLANKS = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"
#: low bits of a packed k-mer that hold its position: more words than a row can hold
POSITION_BITS = 26
_LOW = (1 << POSITION_BITS) - 1
_CLASSES = 2


def _let(value: Column, make) -> Column:
    """``make(value)`` with the value computed once, wherever the optimizer moves it."""
    return F.transform(F.array(value), make)[0]


def _salts() -> list[int]:
    """One pattern per order: a hash XOR the pattern. The position bits stay."""
    x, out = 1, []
    for _ in range(SIGNATURE):
        x = (x * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append((x - (1 << 64) if x >> 63 else x) & ~_LOW)
    return out


def _packed(words: Column) -> Column:
    """(upper hash bits, position) of each k-mer, sorted. A text of fewer words
    than a k-mer is one k-mer."""
    n = F.greatest(F.size(words) - (K_WORDS - 1), F.least(F.size(words), F.lit(1)))
    return F.sort_array(F.transform(F.slice(words, 1, n), lambda w, i: F.xxhash64(
        w, *[F.get(words, i + k) for k in range(1, K_WORDS)]).bitwiseAND(F.lit(~_LOW)).bitwiseOR(i.cast("long"))))


def _occurrences(packed: Column) -> Column:
    """0, 1, 2, ... along each run of equal hashes."""
    begins = F.filter(F.transform(packed, lambda p, i: F.when(
        (i == 0) | (p.bitwiseXOR(F.get(packed, i - 1)) > _LOW) | (p.bitwiseXOR(F.get(packed, i - 1)) < 0), i)),
        lambda i: i.isNotNull())
    return _let(begins, lambda b: F.flatten(F.transform(b, lambda at, j: F.sequence(
        F.lit(0), F.coalesce(F.get(b, j + 1), F.size(packed)) - at - 1))))


def _words(text: Column) -> Column:
    """What white space parts; runs without words as overlapping code points."""
    runs = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    without = lambda w: (F.length(w) > LONGEST_WORD) | w.rlike(_NO_BLANKS)
    grams = lambda w: _let(F.split(w, ""), lambda cs: F.transform(cs, lambda c, i: F.concat(
        c, F.coalesce(F.get(cs, i + 1), F.lit("")), F.coalesce(F.get(cs, i + 2), F.lit("")))))
    parted = lambda ws: F.flatten(F.transform(ws, lambda w: F.when(without(w), grams(w)).otherwise(F.array(w))))
    # most texts have only words, which is told by lengths alone
    script = (F.octet_length(text) > F.length(text)) & text.rlike(_WIDE) & text.rlike(_NO_BLANKS)
    some = lambda ws: script | F.exists(ws, lambda w: F.length(w) > LONGEST_WORD)
    return _let(runs, lambda ws: F.when(some(ws), parted(ws)).otherwise(ws))


def numbered_kmers(text: Column) -> Column:
    """Hash of each numbered k-mer of a text with its position in the low bits."""
    words = _words(text)
    number = lambda ps: _let(_occurrences(ps), lambda occ: F.transform(ps, lambda p, i: F.xxhash64(
        p.bitwiseAND(F.lit(~_LOW)), F.get(occ, i)).bitwiseAND(F.lit(~_LOW)).bitwiseOR(p.bitwiseAND(F.lit(_LOW)))))
    return _let(words, lambda ws: F.when(F.size(ws) > 0, _let(_packed(ws), number)))


def signatures(df: DataFrame, text_col: str, out_col: str = "signature") -> DataFrame:
    """The other columns of ``df`` (which tell its rows apart) with the
    signature of each whole text: SIGNATURE ints. A null or blank text has
    the signature of no k-mers; equal texts have equal signatures."""
    kept = others(df, text_col, out_col)
    rows = df.select(*kept, F.explode_outer(numbered_kmers(F.col(text_col))).alias("_x"))
    kind = F.shiftright("_x", POSITION_BITS).bitwiseAND(F.lit(1).cast("long"))
    least = rows.groupBy(*kept).agg(*[
        F.min(F.when(kind == c, F.col("_x").bitwiseXOR(F.lit(s)))).alias(f"_m{i}_{c}")
        for i, s in enumerate(_salts()) for c in range(_CLASSES)])

    def element(i: int) -> Column:
        a, b = F.col(f"_m{i}_0"), F.col(f"_m{i}_1")
        ha, hb = a.bitwiseAND(F.lit(~_LOW)), b.bitwiseAND(F.lit(~_LOW))
        first = F.coalesce(a.bitwiseAND(F.lit(_LOW)) <= b.bitwiseAND(F.lit(_LOW)), F.lit(True))
        return F.when(first, F.xxhash64(F.lit(0), ha, hb)).otherwise(F.xxhash64(F.lit(1), hb, ha)).bitwiseAND(
            F.lit(0xFFFFFFFF))

    return least.select(*kept, F.array(*map(element, range(SIGNATURE))).alias(out_col))


def as_text(signature: Column) -> Column:
    """Eight hex digits per element."""
    return F.array_join(F.transform(signature, lambda e: F.lpad(F.lower(F.hex(e)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal elements, 0 to 1."""
    same = F.zip_with(a, b, lambda x, y: F.when(x == y, 1.0).otherwise(0.0))
    return F.aggregate(same, F.lit(0.0), lambda s, x: s + x) / SIGNATURE


def with_next(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``df`` with ``_next_id`` and ``_next`` (id and text of the next row by
    ascending id, null ids first, ties by a hash of the text; after the last
    the first).

    Ids are cut into blocks at ids that exist, so the first row of each block
    is known beforehand and is sent to the block before it too; a window per
    block then sees every next row. Texts are shuffled once.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = df.agg(F.percentile_approx(id_col, [i / parts for i in range(1, parts)] or [0.5], 10 * parts).alias("b"),
                 F.min(id_col).alias("m"), F.count_if(F.col(id_col).isNull()).alias("nulls")).first()
    bounds = sorted({b for b in ids["b"] or [] if b != ids["m"]})
    cuts = F.array(*map(F.lit, bounds)) if bounds else F.array().cast("array<long>")
    block = F.size(F.filter(cuts, lambda b: b <= F.coalesce(F.col(id_col), F.lit(ids["m"]))))
    first = F.col(id_col).isNull() if ids["nulls"] else F.col(id_col) == F.lit(ids["m"])
    begins = F.array_contains(cuts, F.col(id_col))
    # own place, and a copy at the end of the block before
    places = F.array(F.struct(block.alias("block"), F.lit(0).alias("copy")),
                     F.when(first, F.struct(F.lit(len(bounds)).alias("block"), F.lit(2).alias("copy")))
                     .when(begins, F.struct((block - 1).alias("block"), F.lit(1).alias("copy"))))
    dealt = df.withColumn("_p", F.explode(F.filter(places, lambda p: p.isNotNull()))).select(
        *df.columns, "_p.block", "_p.copy")
    order = Window.partitionBy("block").orderBy(F.greatest(F.col("copy"), F.lit(1)), F.col(id_col).asc_nulls_first(),
                                                F.xxhash64(text_col), "copy")
    return (dealt.withColumn("_next_id", F.lead(id_col).over(order)).withColumn("_next", F.lead(text_col).over(order))
            .where("copy = 0").drop("copy", "block"))


def edit_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each whole text and of its edited text, whose last half
    (floor of its code points by two) is replaced by as many code points from
    the front of the next row's text, or all it has.

    Columns: id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. Null texts are empty. Rows with a null id come
    first, repeated rows stay, a single row is its own next. Words are what
    white space parts; runs without any are read by code points.
    """
    base = df.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    both = with_next(base, id_col, "_text")
    n = F.length("_text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("_text"), F.lit(1), n - half), F.substring(F.col("_next"), F.lit(1), half))
    # numbered before both texts are laid out, so that they share a number
    rows = (both.withColumn("_edited", edited).withColumn("_row", F.monotonically_increasing_id())
            .select(id_col, "_row", F.length("_text").alias("n_chars"),
                    F.xxhash64("_text").alias("_hash"), "_next_id", F.xxhash64("_next").alias("_next_hash"),
                    F.sha2("_edited", 256).alias("edited_sha256"),
                    F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("_text").alias("t")),
                                      F.struct(F.lit(1).alias("which"), F.col("_edited").alias("t")))).alias("p"))
            .select("*", "p.*").drop("p"))
    signed = written(signatures(rows, "t"), "order-minhash")
    keys = [id_col, "_row", "n_chars", "_hash", "_next_id", "_next_hash", "edited_sha256"]
    own = signed.where("which = 0").drop("which")
    changed = signed.where("which = 1").select("_row", F.col("signature").alias("_edited"))
    # rows of equal id and text have equal signatures: one stands for all
    nexts = own.select(F.col(id_col).alias("_i"), F.col("_hash").alias("_h"), F.col("signature").alias("_next")).dropDuplicates(["_i", "_h"])
    out = own.join(changed, "_row").join(nexts, F.col("_next_id").eqNullSafe(F.col("_i")) & (F.col("_next_hash") == F.col("_h")))
    return out.select(
        id_col, F.col("n_chars").cast("long"), "edited_sha256", as_text(F.col("signature")).alias("fingerprint"),
        as_text(F.col("_edited")).alias("edited_fingerprint"), likeness(F.col("signature"), F.col("_edited")).alias("near_edited"),
        likeness(F.col("signature"), F.col("_next")).alias("near_next"))
