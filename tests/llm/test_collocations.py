"""Collocations against brute force and SQL; automata against dictionaries."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.helpers import no_rows, odd_rows
from vigil.llm import automata, collocations


def _pieces(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall("[^\x20\x09]+", p) for p in re.split("[.,;:!?\x0A-\x0D]", lower)]


def brute(rows, least, first, share=50):
    """rows: (text, lang). A plain statement of the contract."""
    out = []
    for lang in sorted({l or "und" for _, l in rows}):
        f, n = Counter(), 0
        for text, own in rows:
            if (own or "und") != lang:
                continue
            for w in _pieces(text):
                n += len(w)
                f.update(tuple(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        best = []
        for p, a in cand.items():
            if any(100 * b >= share * a for q, b in cand.items() if len(q) > len(p)
                   and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))):
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(best)[:first], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -score))
    return out


def _made(seed, n):
    rng = random.Random(seed)
    words = ["a", "b", "É", "日本", "x-y", "Ab", "aB", "it's", "0"]
    gaps = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", " ! "]
    return [("".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 80))), rng.choice(["en", "fr", None, "und"]))
            for _ in range(n)]


@pytest.mark.parametrize("least,first,shard,span", [(3, 2000, 3_000_000, 24 << 20), (5, 20, 40, 300)])
def test_by_brute_force(spark, monkeypatch, least, first, shard, span):
    monkeypatch.setattr(collocations, "SHARD_PHRASES", shard)
    monkeypatch.setattr(collocations, "WAIT_PHRASES", shard)
    monkeypatch.setattr(collocations, "RANGE_BYTES", span)
    rows = _made(1, 300) + [("the same words again and again. " * 200, "en")]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(6)
    got = [tuple(r) for r in collocations.collocations(df, least=least, first=first).collect()]
    assert sorted(got) == brute(rows, least, first)


def test_odd_rows(spark):
    rows = odd_rows(spark).selectExpr("*", "cast(null as string) as lang", "'mine' as phrase", "'mine' as f")
    got = [tuple(r) for r in collocations.collocations(rows).collect()]
    assert got == brute([(r.text, None) for r in rows.collect()], 10, 2000) and len(got) > 0
    assert collocations.collocations(no_rows(spark).selectExpr("*", "'x' as lang")).count() == 0


def _random_grams(rng, n, alphabet):
    out = Counter()
    for _ in range(n):
        out[" ".join(rng.choice(alphabet) for _ in range(rng.randint(1, 3)))] += rng.randint(1, 3)
    return out


def _grams(counts):
    return automata.of_phrases(pa.array(list(counts)), np.array(list(counts.values()), np.int64))


def _counts(grams):
    words = ["", *(w.decode() for w in grams.words.to_pylist())]
    return {" ".join(filter(None, (words[k] for k in row))): w for row, w in zip(grams.labels.tolist(), grams.weights.tolist())}


@pytest.mark.parametrize("seed", range(5))
def test_automata(seed):
    rng = random.Random(seed)
    parts = [_random_grams(rng, rng.choice([0, 1, 400]), [f"w{i}" for i in range(rng.choice([2, 30]))]) for _ in range(4)]
    total = sum(parts, Counter())
    packed = [automata.Transducer.from_bytes(automata.Transducer.build(_grams(p)).to_bytes()).grams() for p in parts if p]
    joined = automata.union(packed)
    assert _counts(joined) == total
    made = automata.Transducer.build(joined)
    assert _counts(made.grams()) == total
    asked = [*total, "w0 w0 w0", "none", "w1 none", "none none w1"]
    assert automata.compose(pa.array(asked), made).tolist() == [total.get(p, 0) for p in asked]
    some = np.flatnonzero(joined.labels[:, 0] % 2 == 0)
    assert sum(_counts(automata.part(joined, some)).values()) == joined.weights[some].sum()


def test_equal_last_states_are_one():
    counts = {f"w{i} v": 1 for i in range(100)} | {f"w{i} u z": 1 for i in range(100)}
    made = automata.Transducer.build(_grams(counts))
    assert len(made.fan2) == 2 and len(made.label1) == 200
