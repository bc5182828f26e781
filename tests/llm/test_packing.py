import random
from collections import defaultdict

import numpy as np
import pytest
from llm_edges import edge_docs, no_docs

from mirrorkit.llm import packing
from mirrorkit.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def encode():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    tok.encode_special_tokens = True
    return lambda text: tok.encode(text or "", add_special_tokens=False).ids + [1]


def check_pieces(rows, docs, encode):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length > 0
        by_doc[r.doc_id].append((r.start, ids, r.doc_tokens))
        by_seq[r.sequence_id].append((r.offset, r.length))
    want = defaultdict(list)
    for doc_id, text in docs:
        want[doc_id] += encode(text)
    assert by_doc.keys() == want.keys()
    for doc_id, pieces in by_doc.items():
        assert sorted(i for p in pieces for i in p[1]) == sorted(want[doc_id])
        if sum(len(p[1]) for p in pieces) == pieces[0][2]:  # one document of this id
            assert [i for p in sorted(pieces) for i in p[1]] == want[doc_id]
    for pieces in by_seq.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    return by_seq


def test_cut_covers_every_token_once():
    for tokens in [1, 2, 46, 63, 64, 65, 700, 1023, 1024, 1025, 1500, 2047, 2048, 2049, 5000, 100_001]:
        at = 0
        for start, length, cls in packing.cut(tokens):
            assert start == at and length <= packing.CAPACITY // cls
            at += length
        assert at == tokens


def test_edge_documents(small_shuffles, encode):
    docs = edge_docs(small_shuffles)
    rows = packing.pack(docs, tokenizer_path()).collect()
    check_pieces(rows, [(r.doc_id, r.text) for r in docs.collect()], encode)
    assert packing.pack(no_docs(small_shuffles), tokenizer_path()).count() == 0


def test_padding_and_sequences(small_shuffles, encode):
    rng = random.Random(1)
    data = [(i, " ".join(rng.choice(["the", "and", "house", "of."]) for _ in range(rng.randint(0, 3000)))) for i in range(300)]
    docs = small_shuffles.createDataFrame(data, "doc_id bigint, text string").repartition(3)
    pieces = packing.pack(docs, tokenizer_path())
    by_seq = check_pieces(pieces.collect(), data, encode)
    tokens = sum(length for p in by_seq.values() for _, length in p)
    assert len(by_seq) * packing.CAPACITY < 1.05 * tokens + packing.CAPACITY
    seqs = packing.sequences(pieces).collect()
    assert sum(r.tokens for r in seqs) == tokens and all(len(r.ids) == 4 * r.tokens for r in seqs)


def test_words_are_encoded_as_the_library_does(encode):
    tok = packing.WordTokenizer(tokenizer_path())
    for text in ["İstanbul don't <|endoftext|> x\x1cy á ÀÉ ǅ 12ab ñ. ...! \xa0 z Σας ſt ﬁ ª º 日本語.", "", " \x0b\x0c ",
                 "é É. a­b", "l'été, qu’il (dit): «non»!?", "A" * 5000 + " b."]:
        assert np.frombuffer(tok.encode(text.encode()), "<u4").tolist() == encode(text)[:-1]
