"""Merge replay against the libraries, and packing."""

import struct
import zlib

import pytest
import public_tokenizers as P

from tests.llm.helpers import TEXTS, no_rows, odd_rows
from vigil.llm import byte_bpe, packing
from vigil.llm.bpe import MergeTable, _word, replay


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    return rows.unionByName(odd_rows(spark).select("doc_id", "text")).cache()


def _tiktoken():
    import tiktoken
    ranks = {t: i for i, t in enumerate(MergeTable.from_ranks(P.path(byte_bpe.RANKS)).tokens)}
    return tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_are_tiktokens_and_decode_to_the_text(spark, texts):
    enc = _tiktoken()
    want = sorted((str(r.doc_id), r.text or "", enc.encode_ordinary(r.text or "")) for r in texts.collect())
    out = byte_bpe.round_trip(texts).collect()
    assert sorted((str(r.doc_id), bytes(r.decoded).decode(), list(r.ids)) for r in out) == want


def test_spaces_and_contractions():
    import pyarrow as pa
    enc = _tiktoken()
    cases = ["it's 'sure  we'll ''s \n's\t x 've 're're don't'd", "  a  b \n\n c   d   ", "'", "'s", "l'll\r\n\r\n 12 3'4",
             " 's", " 'll x", "a're", "\x1c \x1cq ", "½²x", "'l", "\n", "x" * 5000, "=-" * 900]
    words = byte_bpe.pt.WordIds(MergeTable.from_ranks(P.path(byte_bpe.RANKS)), most=3)
    got = [ids[o:e].tolist() for _, _, ids, offs in byte_bpe.encode_texts(pa.array(cases), words)
           for o, e in zip(offs, offs[1:])]
    assert got == [enc.encode_ordinary(c) for c in cases]


def test_replay_is_the_definition():
    table = MergeTable.from_word_end_json(P.path(packing.VOCABULARY))
    words = [w.encode() for w in "a aa aaaa abababab tiontiontion éééé 日本 zzzzzzzzz".split()]
    ids, offs = replay(table, words)
    for w, o, e in zip(words, offs, offs[1:]):
        start = [int(table.first[b]) for b in w[:-1]] + [int(table.last[w[-1]])]
        assert ids[o:e].tolist() == _word(table, start)


def test_empty_table(spark):
    assert byte_bpe.round_trip(no_rows(spark)).count() == 0
    assert packing.pack(packing.pieces(no_rows(spark))).count() == 0


def test_pieces_hold_the_librarys_ids(spark, texts):
    lib = packing._library(P.path(packing.VOCABULARY))
    want = {}
    for r in texts.collect():
        ids = lib.encode(r.text or "", add_special_tokens=False).ids + [1]
        for s in range(0, len(ids), 2048):
            part = ids[s:s + 2048]
            key = (r.doc_id, s, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part)), len(ids))
            want[key] = want.get(key, 0) + 1
    got = {}
    for r in packing.pieces(texts).collect():
        key = (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)
        got[key] = got.get(key, 0) + 1
    assert got == want


def test_packing_is_gapless_and_full(spark, texts):
    out = packing.pack(packing.pieces(texts, with_ids=True), shard_pieces=100).collect()
    by_seq = {}
    for r in out:
        assert len(r.ids) == r.length
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_seq.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in out)
    assert total / (2048 * len(by_seq)) > 0.85  # a few hundred pieces; thousands leave about one percent


def test_assignment_takes_the_cheapest_sequence_with_room():
    import numpy as np
    seq, off = packing.assign(np.array([2048, 1500, 1400, 600, 500, 40]))
    assert seq.tolist() == [0, 1, 2, 2, 1, 2] and off.tolist() == [0, 0, 0, 1400, 1500, 2000]


def test_clashing_columns(spark):
    out = packing.pack(packing.pieces(odd_rows(spark)))
    assert out.columns.count("length") == 1 and out.where("length > 0").count() == out.count() >= len(TEXTS)
