"""Token counts against the tokenizers library."""

import random

import public_tokenizers
from tokenizers import Tokenizer

from tests.llm.helpers import no_rows, odd_rows
from vigil.llm import token_counts

HARD = ["ΑΣ ΣΑΣ Σ", "e\u0301te\u0301 Å A\u030a ﬁ", "İstanbul DON'T we'LL 'Ss 'd", "a<|endoftext|>b <|startoftext|><|endoftext|>", "<|ENDOFTEXT|> <|endoftext",
        "日本語テキスト 12３٣½", "\u200b \u00a0\u2028x\u0085y\x1c\x1dz", "🙂🙂👩‍👩‍👧 — “quote”", "x" * 5000, "ab" * 4000 + "é" * 3000, "\x00\x01"]


def _want(texts):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [len(tok.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_counts_as_the_library(spark):
    rng = random.Random(1)
    alphabet = "aAbBzZéÉßµ0129'’.,!? \t\n\x1cΣςİ日‿\u0301"
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts = HARD + made + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    out = {r.id: r for r in token_counts.count_tokens(rows, limit=40).collect()}
    want = _want(texts)
    assert [out[i].n_tokens for i in range(len(texts))] == want
    assert all(out[i].n_bytes == len(t.encode()) and out[i].over_limit == (n > 40) for i, (t, n) in enumerate(zip(texts, want)))


def test_merges_of_one_word():
    """By the definition: always join the leftmost pair of least rank."""
    vocab = token_counts.Vocabulary.load(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(2)
    for _ in range(400):
        word = bytes(rng.choice(b"aabcdeinrst") for _ in range(rng.randint(1, 40)))
        sym = [vocab.first[b] for b in word[:-1]] + [vocab.last[word[-1]]]
        done = 0
        while True:
            found = [(vocab.pairs[p][0], i) for i, p in enumerate(zip(sym, sym[1:])) if p in vocab.pairs]
            if not found:
                break
            i = min(found)[1]
            sym[i:i + 2] = [vocab.pairs[sym[i], sym[i + 1]][1]]
            done += 1
        assert token_counts.merges(word, vocab) == done


def test_odd_rows(spark):
    rows = odd_rows(spark).selectExpr("*", "'mine' as n_tokens", "'mine' as c0", "'mine' as _text")
    out = token_counts.count_tokens(rows).collect()
    assert sorted((r.n_tokens for r in out)) == sorted(_want([r.text for r in rows.collect()]))
    assert all(r.c0 == r._text == "mine" for r in out) and {r.n_tokens for r in out if r.doc_id in (2, 3, 4)} == {0}
    assert token_counts.count_tokens(no_rows(spark)).count() == 0


def test_few_words_kept():
    vocab = token_counts.Vocabulary.load(public_tokenizers.path("word_bpe_49k.json"))
    words = [f"word{i}".encode() for i in range(50)] * 2
    small, large = token_counts.Counts(vocab, most=3), token_counts.Counts(vocab)
    assert small(words).tolist() == large(words).tolist() and len(small.known) == 3
