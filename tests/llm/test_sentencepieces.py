"""Pieces, spans and decoded texts against the library."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from linkledger.llm import sentencepieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
SIGNS = [*"aeioun stTHE ▁▁\n\t.,é中文\U0001f600\x00　​<>0x1/|", "<unk>", "<s>", "</s>", "<0xE3>", "  ", " the", "ing", "\r\n", "é"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_ids_spans_and_text_are_the_library_s(library):
    rng, pieces = random.Random(2), sentencepieces.Pieces(PATH)
    texts = ["", *("".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 20))) for _ in range(4000))]
    for text, (ids, stops) in zip(texts, pieces.encode(texts), strict=True):
        assert ids == library.encode(text)
        ends = [p.end for p in library.encode(text, return_type="proto").pieces]
        assert not ids or stops.tolist() == ends
        assert pieces.decode(ids) == library.decode(ids)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nmt_nfkc_cf", "nfkc", "nfkc_cf", "identity"])
@pytest.mark.parametrize("squeeze", [True, False])
def test_normalising_by_the_character_map_is_the_library_s(rule, squeeze):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=squeeze)
    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(library.serialized_model_proto())
    own, rng = sentencepieces.Normaliser(model.normalizer_spec), random.Random(3)
    signs = [*"ab  eﬁ①ｱﾞ　\xc5\xbd가\tＡ\xdf​﻿\nΩ中", "é", "Å"]
    for _ in range(1500):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 9)))
        want, offsets = library.normalize(text, with_offsets=True)
        normal, places = own(text.encode())
        assert normal.decode() == want
        assert own.places(text.encode()).tolist() == places
        starts = [len(c.encode()) for c in want]
        at = [places[sum(starts[:i])] for i in range(len(starts) + 1)]
        assert not want or [len(text.encode()[:a].decode()) for a in at] == offsets


def test_encoded_and_decoded(docs, rows, library):
    got = sentencepieces.encoded(docs)
    assert got.columns == ["doc_id", "ids", "starts", "stops"]
    found = {(r.doc_id, tuple(r.ids)): r for r in got.collect()}
    for row in rows:
        text = row[1] or ""
        r = found[row[0], tuple(library.encode(text))]
        assert r.starts == [0, *r.stops[:-1]][: len(r.ids)] and (not r.ids or r.stops[-1] == len(text.encode()))
    texts = sorted((r.doc_id or 0, r.text) for r in sentencepieces.decoded(got).collect())
    assert texts == sorted((row[0] or 0, library.decode(library.encode(row[1] or ""))) for row in rows)


def test_digests(docs, rows, empty, library):
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = []
    for row in rows:
        ids = library.encode(row[1] or "")
        want.append((row[0], len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)), len((row[1] or "").encode())))
    got = [tuple(r) for r in sentencepieces.digests(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sentencepieces.digests(empty).collect() == [] and sentencepieces.encoded(empty).collect() == []
