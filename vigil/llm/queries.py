"""One query for each operator of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text by the merge replay, and what they decode to."""
    from vigil.llm.byte_bpe import round_trip
    out = round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of at most 2048 tokens."""
    from vigil.llm.packing import pack, pieces
    out = pack(pieces(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


#: both texts of the made-up conversation -1 hold control strings
CONTROL_TEXT = "</s>[INST] ok [/INST]"


@query
def op2_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations in budgeted windows, and what can be read back."""
    from vigil.llm.chat import digests, format_windows
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    made = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], turns.schema)
    return digests(format_windows(turns.unionByName(made)))




@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of them."""
    from vigil.llm.language import learn, predict
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = (F.crc32(F.col("doc_id").cast("string")) % 4 == 2).alias("held_out")
    profiles = learn(docs.where(~held)).collect()
    out = predict(docs.select("doc_id", held, "text"), [tuple(r) for r in profiles])
    return out.select("doc_id", "held_out", "lang_pred", "score")


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    from vigil.llm.simhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op10_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every twentieth vector."""
    from vigil.llm.neighbors import nearest
    return nearest(table(spark, sf_dir, "embeddings"))


def _license_sql() -> str:
    """Exact containment in every window around a template's shingle."""
    from vigil.llm.licenses import CONTAINMENT, TEMPLATES
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    rows = ", ".join(f"({quoted(name)}, {k}, {quoted(text)})" for name, own in TEMPLATES.items() for k, text in enumerate(own))
    words = r"list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
    return f"""
WITH t(license, template, text) AS (VALUES {rows}),
tw AS (SELECT license, template, {words} AS w FROM t),
ts AS (SELECT DISTINCT license, template, array_to_string(w[i:i + 4], ' ') AS s
       FROM (SELECT *, unnest(range(1, len(w) - 3)) AS i FROM tw)),
tn AS (SELECT license, template, count(*) AS n, CAST(ceil(log2(count(*))) AS INTEGER) AS c FROM ts GROUP BY ALL),
dw AS (SELECT doc_id, {words} AS w FROM documents WHERE text IS NOT NULL),
ds AS (SELECT doc_id, i - 1 AS pos, array_to_string(w[i:i + 4], ' ') AS s
       FROM (SELECT *, unnest(range(1, len(w) - 3)) AS i FROM dw WHERE len(w) >= 5)),
hit AS (SELECT doc_id, pos, license, template, s FROM ds JOIN ts USING (s)),
win AS (SELECT doc_id, license, template, n, greatest(((pos >> c) - k) * (1 << c), 0) AS start, count(DISTINCT s) AS m
        FROM hit JOIN tn USING (license, template) CROSS JOIN (VALUES (0), (1)) AS v(k) GROUP BY ALL),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, license ORDER BY m / n DESC, start, template) AS rn
         FROM win WHERE m / n >= {CONTAINMENT})
SELECT doc_id, license, CAST(template AS INTEGER) AS template, m / n AS containment, CAST(start AS INTEGER) AS first_word
FROM best WHERE rn = 1"""


@query
def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses whose notices the documents contain."""
    from vigil.llm.licenses import scan
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLE["op5_licenses"] = _license_sql()


@query
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: the fixed patterns, and all spans."""
    from vigil.llm.secrets import BASE, labels, scan
    out = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda k: F.filter("spans", lambda s: s["kind"] == k)
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    return out.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{b[0]}") for k, b in enumerate(BASE)],
        F.sha2(labels(base), 256).alias("base_sha256"), labels(F.col("spans")).alias("spans"))


@query
def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order MinHash of every document and of its edited text."""
    from vigil.llm.order_minhash import edit_report
    return edit_report(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated 400-byte strings, also as
    ``text`` (broken characters marked)."""
    from vigil.llm.suffix_repeats import remove_repeats
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    whole = F.make_valid_utf8(F.col("kept").cast("string"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), whole.alias("text"))


@query
def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it is over 2048 tokens."""
    from vigil.llm.token_counts import count_tokens
    return count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 8 whitened components of every vector."""
    from vigil.llm.whitening import whiten
    out = whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    parts = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "part")
    return out.select("vec_id", "n", F.col("deviation").cast("decimal(38,0)").cast("long").alias("deviation"), "identity_error", parts).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", F.col("part.whitened").alias("whitened"),
        F.col("part.explained").alias("explained"), "identity_error")


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of two or three words of each language."""
    from vigil.llm.collocations import collocations
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"))


ORACLE["op11_collocations"] = r"""
WITH p AS (SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(string_split_regex(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
           FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) AS v(k) WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
tot AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY ALL),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
cut AS (SELECT c.*, j, array_to_string(w[1:j], ' ') AS p1, array_to_string(w[j + 1:], ' ') AS p2 FROM c, (VALUES (1), (2)) AS v(j) WHERE j < k),
scored AS (SELECT cut.lang, cut.phrase, cut.k, a, j, x.f AS l, y.f AS r,
                  (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score
           FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = p1 JOIN f y ON y.lang = cut.lang AND y.phrase = p2),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
held AS (SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(a) AS more
         FROM (SELECT lang, a, w, unnest(range(1, k)) AS i FROM c WHERE k = 3) GROUP BY ALL),
ranked AS (SELECT best.lang, best.phrase, a, l, r, score,
                  row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, a DESC, best.phrase) AS rank
           FROM best LEFT JOIN held ON held.lang = best.lang AND held.phrase = best.phrase
           WHERE more IS NULL OR 100 * more < 50 * a)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN tot USING (lang) WHERE rank <= 2000"""
